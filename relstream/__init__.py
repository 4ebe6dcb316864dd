"""relstream: keyed event streams and upsert tables on Spark DataFrames."""

from relstream.functions.predicates import strict
from relstream.functions.safe import safe_udf
from relstream.model import LookupTable, RecordStream, UpsertTable
from relstream.operators.joiners import Joiner
from relstream.operators.windows import hopping, sessions, tumbling, unlimited
from relstream.sources.topics import TopicSpec, decode_json, encode_json, read_json_records

__all__ = [
    "Joiner", "LookupTable", "RecordStream", "TopicSpec", "UpsertTable", "decode_json", "encode_json",
    "hopping", "read_json_records", "safe_udf", "sessions", "strict", "tumbling", "unlimited",
]
