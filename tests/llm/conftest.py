import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Builds a table of documents from {doc_id: text} or a list of (doc_id, text)."""
    def build(rows, partitions=3, extra=()):
        pairs = rows.items() if isinstance(rows, dict) else rows
        data = [(d, t, "en", f"src{(d or 0) % 3}", len(t or "")) for d, t in pairs]
        df = spark.createDataFrame(data, SCHEMA).repartition(partitions)
        for name in extra:
            df = df.withColumn(name, F.lit(name))
        return df
    return build


@pytest.fixture
def sf(spark):
    return "/root/testdata/sf0.001"
