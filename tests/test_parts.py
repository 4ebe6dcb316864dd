"""One-pass branches, splits and maps: equal to the lazy ones, one scan, one call per record, one part per record."""

import random

import pytest
from pyspark.sql import functions as F

from relstream import RecordStream
from relstream.catalog.replay import appended, replay
from relstream.functions.safe import safe_udf
from test_streaming import rows, stream

CONDITIONS = (F.col("value") > 20, ((F.col("value") % 3 == 0), ("value",)), F.col("key") < 4)


def told(flow):
    return sorted(map(tuple, flow.quarantine().collect()), key=repr)


def test_branches_equal_the_lazy_ones(spark):
    given = stream(spark, 1)
    lazy, written = given.branch(*CONDITIONS), given.branch_through(*CONDITIONS)
    assert [rows(p.rows()) for p in written] == [rows(p.rows()) for p in lazy]
    assert told(written[0]) == told(lazy[2]) != []
    plan = written[1].df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "part" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_splits_equal_the_lazy_ones(spark):
    given = stream(spark, 1)
    lazy, written = given.split(F.col("value") > 12), given.split_through(F.col("value") > 12)
    assert [rows(p.rows()) for p in written] == [rows(p.rows()) for p in lazy]
    assert [t[1:3] for t in told(written[0])] == [t[1:3] for t in told(lazy[0])] != []
    assert sum(len(rows(p.rows())) for p in written) + len(told(written[1])) == 240


def test_maps_equal_the_lazy_ones(spark):
    given = stream(spark, 1)
    key, value = {"k": F.nullif(F.col("key"), F.lit(3))}, {"double": F.col("value") * 2, "key": F.col("key")}
    for maps, lazy in (({"key": key, "value": value}, given.map(key, value)), ({"key": key}, given.map_keys(key)),
                       ({"value": value | {"v": F.col("value")}, "valid": F.col("value") > 4}, None)):
        if lazy is None:
            maps["value"] = {"double": F.col("value") * 2}
            lazy = given.map_values(maps["value"], maps["valid"])
        written = given.map_through(**maps)
        assert (written.key, written.value, rows(written.rows())) == (lazy.key, lazy.value, rows(lazy.rows()))
        assert told(written) == told(lazy) != []


def test_a_flaky_function_is_called_once_and_puts_each_record_in_one_part(spark):
    calls = spark.sparkContext.accumulator(0)

    def flaky(value):
        calls.add(1)
        if random.random() < 0.3:
            raise ValueError("now and then")
        return random.random() < 0.5

    given = stream(spark, 1)
    compute = {"told": safe_udf(flaky, "boolean")("value")}
    for divide in (lambda: given.split_through(F.col("told.value"), compute=compute),
                   lambda: [given.map_through(value={"v": F.col("told.value")}, valid=F.col("told.error").isNull(), compute=compute)]):
        before = calls.value
        parts = divide()
        places = [[r["seq"] for r in p.df.collect()] for p in parts]
        places.append([int(t[5].split(":")[1].rstrip("}")) for t in told(parts[0])])
        assert all(places) and sorted(sum(places, [])) == sorted(r["seq"] for r in given.df.collect())
        assert calls.value - before == 240


def test_streams_go_on_from_the_parts(spark):
    given = stream(spark, 1)
    parts, writing = replay(given, flush=False).branch_through(*CONDITIONS)
    writing.processAllAvailable()
    writing.stop()
    lazy = given.branch(*CONDITIONS)
    assert [rows(appended(p.rows(), spark)) for p in parts] == [rows(p.rows()) for p in lazy]
    assert len(appended(parts[0].quarantine(), spark).collect()) == len(told(lazy[0]))


def test_empty_streams_and_names_that_clash(spark):
    none = stream(spark, 1).filter(F.col("seq") < 0)
    none = none.with_(rejects=())
    assert [p.df.count() for p in none.branch_through(*CONDITIONS)] == [0, 0, 0]
    assert none.map_through(value={"v": F.col("value")}).quarantine().count() == 0
    with pytest.raises(ValueError, match="names of their own"):
        none.split_through(F.col("value") > 1, compute={"value": F.lit(1)})
    with pytest.raises(ValueError, match="names of their own"):
        RecordStream(none.df.withColumnRenamed("value", "part"), "key", "part").split_through(F.col("part") > 1)
    with pytest.raises(ValueError, match="nothing to map"):
        none.map_through()
