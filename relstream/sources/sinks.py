"""Writing streams and tables to topics, and reading on from there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relstream.plans.scratch import scratch_path
from relstream.sources.states import EPOCH, TableFiles, held
from relstream.sources.topics import JSON_TIMES, TopicSpec, encode_json, read_kafka_records


def _write(df: DataFrame, topic: TopicSpec, mode: str) -> None:
    writer = df.write.format(topic.format).options(**topic.options).mode(mode)
    if topic.format == "kafka":
        writer.option("topic", topic.location).save()
        return
    if topic.partition_by:
        writer = writer.partitionBy(*topic.partition_by)
    writer.save(topic.location)


def encoded(records, topic: TopicSpec) -> DataFrame:
    """Rows as the topic's format wants them; a connector for bytes gets JSON key and value."""
    if topic.format != "kafka":
        return records.rows()
    partition = [topic.partition.cast("int").alias("partition")] if topic.partition is not None else []
    return records.rows().select(
        F.to_json(F.struct(*records.key), JSON_TIMES).alias("key"), encode_json(records.value).alias("value"), *partition)


def reread(records, topic: TopicSpec):
    """The records as the topic has them, as a stream if `records` is one."""
    reader = records.spark.readStream if records.df.isStreaming else records.spark.read
    if topic.format != "kafka":
        schema = records.rows().schema
        return records.with_(df=reader.format(topic.format).options(**topic.options).schema(schema).load(topic.location))
    schema = records.rows().schema
    kinds = [T.StructType([schema[c] for c in names]) for names in (records.key, records.value)]
    found = read_kafka_records(reader.format("kafka").options(**topic.options).option("subscribe", topic.location).load(), *kinds)
    return found.with_(rejects=(*records.rejects, *found.rejects))


class StreamSinkOps:

    def to(self, topic: TopicSpec, checkpoint: str | None = None, mode: str = "append"):
        """Writes the records to a topic. On a stream, returns the started query."""
        rows = encoded(self, topic)
        if not self.df.isStreaming:
            return _write(rows, topic, mode)
        writer = rows.writeStream.format(topic.format).options(**topic.options)
        writer = writer.option("checkpointLocation", checkpoint or scratch_path(self.spark, "checkpoint"))
        writer = writer.outputMode("append")
        if topic.format == "kafka":
            return writer.option("topic", topic.location).start()
        if topic.partition_by:
            writer = writer.partitionBy(*topic.partition_by)
        return writer.start(topic.location)

    def through(self, topic: TopicSpec, mode: str = "append", checkpoint: str | None = None):
        """Writes to a topic and continues from what was written.

        On a stream the writing query is started and the result reads the topic as a stream of its own, for a second
        query: `(records, writing)`. What passes through Kafka has its time and offset as order columns.
        """
        writing = self.to(topic, checkpoint, mode)
        found = reread(self, topic)
        return (found, writing) if self.df.isStreaming else found


class TableSinkOps:

    def to(self, topic: TopicSpec, checkpoint: str | None = None, mode: str = "append"):
        """Writes the log, deletes included."""
        return self.to_stream().to(topic, checkpoint, mode)

    def save_snapshot(self, topic: TopicSpec, checkpoint: str | None = None, compact_every: int = 20):
        """Replaces the topic's content with the live rows.

        On a stream, returns the started query that keeps the state of the running table below `topic.location` (files
        only): every micro-batch adds the last versions of the keys that it changed, under its number, so a repeated one
        replaces itself. Each `compact_every` micro-batches a new base is made of them (`states.TableFiles`). `read_state`
        gives the live rows.
        """
        if not self.df.isStreaming:
            current = self.with_(df=self.latest())
            return _write(encoded(current, topic), topic, "overwrite")
        if topic.format == "kafka":
            raise ValueError("the state of a running table is kept in files")

        def keep(batch: DataFrame, epoch: int) -> None:
            files = self._files(batch.sparkSession, topic)
            files.add(batch, epoch)
            if (epoch + 1) % compact_every == 0:
                files.compact(epoch, self.has_value)

        return (
            self.latest_versions().writeStream.foreachBatch(keep).outputMode("update")
            .option("checkpointLocation", checkpoint or scratch_path(self.spark, "checkpoint")).start()
        )

    def _files(self, spark, topic: TopicSpec) -> TableFiles:
        return TableFiles(spark, topic, self.rows().schema, self.key)

    def read_state(self, topic: TopicSpec, spark=None):
        """The live rows that `save_snapshot` of this running table has kept so far, as a batch table."""
        last = self._files(spark or self.spark, topic).versions().drop(EPOCH)
        return self.with_(df=last.where(self.has_value), is_snapshot=True, rejects=())

    def keep_state(self, checkpoint: str):
        """Starts a query that holds the last version of every key of this running table in its state, and writes nothing.

        `state_view` reads it.
        """
        return self.latest_versions().writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).start()

    def state_view(self, checkpoint: str, batch_id: int | None = None, spark=None):
        """The live rows in the state of the query of `latest_versions` (as `keep_state` starts it) with that checkpoint, as a batch table.

        The state is that of the last micro-batch, or of the one with `batch_id`, while the query runs or after it. A key is looked
        up with `filter` or `where` on the key columns.
        """
        last = held(spark or self.spark, checkpoint, self.rows().columns, self.key, batch_id)
        return self.with_(df=last.where(self.has_value), is_snapshot=True, rejects=())
