"""Topics: named places that records are read from and written to."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# JSON carries times to the microsecond, Spark's default only to the millisecond.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class TopicSpec:
    """Where a topic is and what its records look like.

    `location` is a folder for file formats and the topic name for `format="kafka"`, whose connector
    has to be on the class path. `options` go to the reader and the writer. `partition_by` names columns
    that part files into folders; `partition` computes the Kafka partition of a record from its columns.
    """

    location: str
    schema: T.StructType
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    partition: Column | None = field(default=None, compare=False)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._reader(spark.read)

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return self._reader(spark.readStream)

    def _reader(self, reader) -> DataFrame:
        reader = reader.format(self.format).options(**self.options)
        if self.format == "kafka":
            return reader.option("subscribe", self.location).load()
        return reader.schema(self.schema).load(self.location)


def decode_json(raw: Column, schema: T.StructType | str) -> Column:
    """Parses JSON text to a struct with an extra `_corrupt_record` field; unknown fields are ignored.

    JSON null and SQL NULL stay null and are not corrupt; text that holds no JSON at all, as the empty one, is.
    """
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(raw, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **JSON_TIMES})
    bare = F.regexp_replace(raw, r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    blank = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields], raw.alias(CORRUPT))
    return F.when(bare == "", blank).when(bare != "null", parsed)


def encode_json(columns: Iterable[str]) -> Column:
    """The columns as one JSON object; a record without a value stays null."""
    columns = tuple(columns)
    present = F.lit(False)
    for name in columns:
        present = present | F.col(name).isNotNull()
    return F.when(present, F.to_json(F.struct(*columns), JSON_TIMES))


def _once(column: Column) -> Column:
    """`column` computed once per row.

    A filter on a projected column is moved below the projection and computes it again; it is not
    moved below a generator.
    """
    return F.explode(F.array(column))


def read_json_records(df: DataFrame, key: Iterable[str], raw: str, schema: T.StructType | str,
                      ts: str | None = "ts", seq: Iterable[str] = ("seq",)):
    """A record stream whose value is the JSON text column `raw`, decoded once per record.

    Undecodable records are dropped from the stream and appear in its `quarantine()`.
    """
    from relstream.model import RecordStream
    names = T._parse_datatype_string(schema).names if isinstance(schema, str) else schema.names
    key, seq = ((given,) if isinstance(given, str) else tuple(given) for given in (key, seq))
    order = seq if ts is None else (ts, *seq)
    parsed = df.select(*key, raw, _once(decode_json(F.col(raw), schema)).alias("__p"), *order)
    corrupt = F.col(f"__p.{CORRUPT}").isNotNull()
    source = RecordStream(parsed, key, (raw,), ts, seq)
    rejects = (source.reject("deserialize", parsed.where(corrupt), "malformed value"),)
    good = parsed.where(~corrupt).select(*key, *[F.col(f"__p.{n}").alias(n) for n in names], *order)
    return RecordStream(good, key, tuple(names), ts, seq, rejects)


def read_kafka_records(df: DataFrame, key_schema: T.StructType | str, value_schema: T.StructType | str):
    """A record stream from the Kafka source's columns: JSON key and value, `timestamp`, `offset`.

    A key lives in one partition, so offsets order its records. Records whose key or value cannot be
    decoded are quarantined; a null value stays a delete.
    """
    from relstream.model import RecordStream
    kinds = [s if isinstance(s, T.StructType) else T._parse_datatype_string(s) for s in (key_schema, value_schema)]
    text = df.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"), F.col("offset").alias("seq"),
    )
    both = F.struct(decode_json(F.col("key"), kinds[0]).alias("k"), decode_json(F.col("value"), kinds[1]).alias("v"))
    parsed = text.select("*", _once(both).alias("__p"))
    corrupt = F.col(f"__p.k.{CORRUPT}").isNotNull() | F.col(f"__p.v.{CORRUPT}").isNotNull()
    raw = RecordStream(text, "key", "value", "ts", "seq")
    good = parsed.where(~corrupt).select(
        *[F.col(f"__p.k.{n}").alias(n) for n in kinds[0].names],
        *[F.col(f"__p.v.{n}").alias(n) for n in kinds[1].names], "ts", "seq",
    )
    rejects = (raw.reject("deserialize", parsed.where(corrupt), "malformed key or value"),)
    return RecordStream(good, kinds[0].names, kinds[1].names, "ts", "seq", rejects)
