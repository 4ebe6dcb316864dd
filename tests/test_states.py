"""The state of running tables: in files that are compacted, and in the query's own store."""

from pyspark.sql import functions as F

from relstream import TopicSpec, UpsertTable
from relstream.catalog.replay import replay
from relstream.plans.scratch import scratch_path
from relstream.sources.states import TableFiles
from test_streaming import rows, stream

SCHEMA = "key string, value long"
LIVE = F.col("value").isNotNull()


def files_of(spark):
    topic = TopicSpec(scratch_path(spark, "state"), spark.createDataFrame([], SCHEMA).schema)
    return TableFiles(spark, topic, topic.schema, ("key",))


def batch(spark, epoch):
    """Each micro-batch changes two of five keys; every seventh deletes one."""
    changed = [(f"k{epoch % 5}", epoch), (f"k{(epoch + 2) % 5}", None if epoch % 7 == 0 else 100 + epoch)]
    return spark.createDataFrame(changed, SCHEMA), dict(changed)


def live(files):
    return {r["key"]: r["value"] for r in files.versions().where(LIVE).collect()}


def test_a_read_touches_the_base_and_the_latest_changes(spark):
    files, expected = files_of(spark), {}
    for epoch in range(50):
        rows_, changed = batch(spark, epoch)
        files.add(rows_.coalesce(1), epoch)
        expected |= changed
        if epoch % 10 == 9:
            files.compact(epoch, LIVE)
        if epoch in (3, 9, 13, 29, 33, 49):
            assert live(files) == {k: v for k, v in expected.items() if v is not None}
    for epoch in (50, 51):
        files.add(batch(spark, epoch)[0].coalesce(1), epoch)
        expected |= batch(spark, epoch)[1]
    assert live(files) == {k: v for k, v in expected.items() if v is not None}
    touched = {name.split("/")[-2].split("-")[0] for name in files.versions().inputFiles()}
    # Besides these, only what the compaction before may still need is there: epochs 40 to 49, left out by their number.
    assert {"000000000049", "epoch=50", "epoch=51"} <= touched <= {"000000000049", *(f"epoch={e}" for e in range(40, 52))}
    assert len(files._names("_base")) == len(files._names("_manifest")) == 2


def test_interrupted_compactions_leave_the_state_as_it_was(spark, monkeypatch):
    files = files_of(spark)
    for epoch in range(4):
        files.add(batch(spark, epoch)[0], epoch)
    files.compact(3, LIVE)
    files.add(batch(spark, 4)[0], 4)
    before = live(files)

    def interrupted(*_):
        raise OSError("lost")

    for place in ("_write", "_announce"):  # before the base is whole, and before it is announced
        with monkeypatch.context() as patch:
            patch.setattr(TableFiles, place, interrupted)
            try:
                files.compact(4, LIVE)
            except OSError:
                pass
        assert live(files) == before
    files.compact(4, LIVE)
    assert live(files) == before and len(files._names("_base")) == 2
    files.add(batch(spark, 4)[0], 4)  # the micro-batch is repeated
    files.compact(4, LIVE)
    assert live(files) == before and len(files._names("_manifest")) == 2


def test_running_table_in_compacted_files(spark):
    given = stream(spark, 4)
    table = UpsertTable.of(replay(given, slices=5, flush=False))
    topic = TopicSpec(scratch_path(spark, "state"), table.rows().schema)
    keeping = table.save_snapshot(topic, compact_every=2)
    keeping.processAllAvailable()
    keeping.stop()
    want = rows(UpsertTable.of(given).latest())
    assert rows(table.read_state(topic, spark).rows()) == want
    assert rows(table.read_state(topic).latest()) == want


def test_state_by_key_and_by_batch(spark):
    given = stream(spark, 4)
    replayed, checkpoint = replay(given, slices=3, flush=False), scratch_path(spark, "checkpoint")
    table = UpsertTable.of(replayed, deleted=F.col("value") == 7)
    holding = table.keep_state(checkpoint)
    holding.processAllAvailable()
    try:
        assert rows(table.state_view(checkpoint, spark=spark).rows()) == rows(UpsertTable.of(given, deleted=F.col("value") == 7).latest())
    finally:
        holding.stop()
    view = lambda n: table.state_view(checkpoint, n, spark).df
    counts = [p["numInputRows"] for p in holding.recentProgress if p["numInputRows"]]
    assert sum(counts) == 240 and len(counts) == 3
    first = given.with_(df=given.df.orderBy("seq").limit(counts[0]))
    want = rows(UpsertTable.of(first, deleted=F.col("value") == 7).latest())
    assert rows(view(0)) == want != rows(view(2))
    assert view(0).where("key = 0").collect() == UpsertTable.of(first, deleted=F.col("value") == 7).latest().where("key = 0").collect()
