"""Frames for tests."""

from pyspark.sql import DataFrame

from relstream.plans.scratch import scratch_path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Writes `df` out and reads it back, so that plans start from files."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
