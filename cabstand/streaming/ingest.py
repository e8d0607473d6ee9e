"""Topic -> decoded rows -> month table.

One query, one sink: every micro-batch is decoded once and written to a table partitioned by route
(``clean``, ``triage``, ``dead``). The file sink with its checkpoint is exactly-once, so a restart
neither loses nor repeats messages; nothing here keeps state, so no watermark is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cabstand.functions import clock
from cabstand.functions.messages import decode_messages, to_message
from cabstand.operators import routing
from cabstand.sources import snapshots
from cabstand.sources.tables import NO_MONTH, PART
from cabstand.specs import DatasetSpec

DEAD = "dead"


#: Where a message lies in its topic, as the connector's columns name it.
POSITION = ("topic", "partition", "offset")


def topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a Kafka topic as ``value`` text with their positions. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for key, value in options.items():
        reader = reader.option(key.replace("__", "."), value)
    return positioned(reader.load())


def positioned(records: DataFrame) -> DataFrame:
    """``value`` as text and the position, from records in the connector's columns, wherever they come from."""
    kinds = dict(zip(POSITION, ("string", "int", "long")))
    return records.select(F.col("value").cast("string").alias("value"), *[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])


def file_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages from text files, one JSON object per line."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Send every row of a frame as a JSON message, from all executors at once."""
    to_message(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


#: Messages in one file. A compressed text can't be split, so this bounds what a task has to read.
MESSAGES_PER_FILE = 100_000


def write_messages(messages: DataFrame, folder: str) -> None:
    """One column of texts as lines of compressed files: names repeat in every message and take up most of it."""
    messages.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", MESSAGES_PER_FILE).text(folder)


def publish_files(df: DataFrame, folder: str) -> None:
    """The same messages as text files, for a file stream."""
    write_messages(to_message(df), folder)


def decoded(messages: DataFrame, columns: Mapping[str, str], unknown_fields: str = "reject") -> DataFrame:
    """Typed rows with ``raw`` and ``error``; streaming or batch."""
    return decode_messages(messages, columns, unknown_fields=unknown_fields)


def routed(
    messages: DataFrame, spec: DatasetSpec, as_of: clock.Moment | None = None, unknown_fields: str = "reject"
) -> DataFrame:
    """Decode, cleanse and route; streaming or batch.

    ``raw`` is kept for dead messages only. Without ``as_of`` the "in the past" rules compare with
    the time of each micro-batch.
    """
    rows = routing.with_route(decoded(messages, spec.columns, unknown_fields), spec.rules(as_of))
    good = F.col("error").isNull()
    return rows.withColumns(
        {
            routing.ROUTE: F.when(good, F.col(routing.ROUTE)).otherwise(F.lit(DEAD)),
            routing.REASONS: F.when(good, F.col(routing.REASONS)).otherwise(F.array(F.col("error"))),
            "raw": F.when(~good, F.col("raw")),
            PART: F.coalesce(clock.month_id(F.col(spec.start)), F.lit(NO_MONTH)),
        }
    ).drop("error")


BATCH = "batch"


def start_ingest(
    messages: DataFrame,
    spec: DatasetSpec,
    table: str,
    checkpoint: str,
    as_of: clock.Moment | None = None,
    unknown_fields: str = "reject",
    once: bool = False,
    every: str = "1 minute",
    name: str | None = None,
) -> StreamingQuery:
    """Start the ingest; with ``once`` it takes what is there and stops.

    ``every`` sets the micro-batch interval and with it the size of the files. The rows of a batch
    are gathered by folder before the write; AQE splits a folder that holds most of the batch over several tasks.

    The folders are those of the batch load (month, then route), so retention drops a month here as there. Below
    them each batch writes a folder of its own and replaces it when it runs again; no log lists the files, so a
    folder that retention has dropped is not missed.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def append(batch: DataFrame, number: int) -> None:
        rows = batch.hint("rebalance", F.col(PART), F.col(routing.ROUTE)).withColumn(BATCH, F.lit(f"{stream}-{number}"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, routing.ROUTE, BATCH).parquet(table)

    rows = routed(messages, spec, as_of, unknown_fields)
    writer = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def position_key(topic: str, partition: int) -> str:
    return f"position:{topic}:{partition}"


def unseen(batch: DataFrame, marks: Mapping[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """Messages from the marked positions on, and the positions after this batch: one per topic partition."""
    ends = batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next")).collect()
    known = [(row["topic"], row["partition"], marks.get(position_key(row["topic"], row["partition"]), 0)) for row in ends]
    after = {position_key(t, p): max(at, row["next"]) for (t, p, at), row in zip(known, ends)}
    if not any(at for _, _, at in known):
        return batch, after
    ledger = batch.sparkSession.createDataFrame(known, "topic string, partition int, first long")
    # One row per partition of a topic, whatever the batch holds.
    return batch.join(F.broadcast(ledger), ["topic", "partition"]).where(F.col("offset") >= F.col("first")).drop("first"), after


def start_snapshot_ingest(
    messages: DataFrame,
    spec: DatasetSpec,
    table: str,
    checkpoint: str,
    as_of: clock.Moment | None = None,
    unknown_fields: str = "reject",
    once: bool = False,
    every: str = "1 minute",
    name: str | None = None,
    merge_at: int | None = None,
) -> StreamingQuery:
    """The ingest into a table of :mod:`cabstand.sources.snapshots`.

    A batch becomes visible in one step, together with what keeps it from being taken twice. For messages with
    a position (topic, partition, offset) that is the next position of each partition: rows below it are left out,
    so even a stream that has lost its checkpoint and reads the topic from the start repeats nothing.
    For others it is the number of the batch under the id of the stream, which a lost checkpoint loses too.

    ``merge_at`` bounds the small files: a month that lies in so many folders is merged after the batch. Any other job may
    call :func:`merge_table` while the stream runs.
    """
    placed = set(POSITION) <= set(messages.columns)

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = f"batch:{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
        for _ in range(snapshots.ATTEMPTS):
            state = snapshots.present(spark, table)
            fresh, marks = unseen(batch, state.marks) if placed else (batch, {stream: number})
            if all(state.marks.get(key, -1) >= at for key, at in marks.items()):
                return
            rows = routed(fresh.select("value"), spec, as_of, unknown_fields).drop(PART)
            _, months, schema = snapshots.stage(rows, table, spec.start, (), f"stream-{spec.name}", (routing.ROUTE,))

            def change(now: snapshots.Snapshot) -> snapshots.Snapshot | None:
                if any(now.marks.get(key) != state.marks.get(key) for key in marks):
                    return None
                return replace(now.appended(months), schema=schema, marks={**now.marks, **marks})

            done = snapshots.switch(spark, table, change)
            if all(done.marks.get(key) == at for key, at in marks.items()):
                break
        else:
            raise snapshots.Conflict(f"{table}: other streams kept moving the same positions")
        if merge_at:
            merge_table(spark, spec, table, merge_at)

    writer = messages.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def merge_table(spark: SparkSession, spec: DatasetSpec, table: str, least: int = 2) -> dict[str, int]:
    """Merge the folders of crowded months, clustered like those of the batch load; the stream may go on meanwhile."""
    return snapshots.merge(spark, table, spec.start, spec.cluster_rows, (routing.ROUTE,), least)


def positions(spark: SparkSession, table: str) -> DataFrame:
    """The next position of every topic partition: ``topic, partition, next``."""
    marks = {key: at for key, at in snapshots.present(spark, table).marks.items() if key.startswith("position:")}
    rows = [(*key.removeprefix("position:").rsplit(":", 1), at) for key, at in marks.items()]
    return spark.createDataFrame([(topic, int(part), at) for topic, part, at in rows], "topic string, partition int, next long")


def read_route(spark: SparkSession, table: str, route: str) -> DataFrame:
    """Rows of one route; the other routes' folders are not opened."""
    rows = spark.read.parquet(table).where(F.col(routing.ROUTE) == route).drop(BATCH)
    return rows.withColumn(PART, F.col(PART).cast("string"))


def error_counts(spark: SparkSession, table: str) -> DataFrame:
    """Dead messages per reason."""
    reason = F.explode(routing.REASONS).alias("reason")
    return read_route(spark, table, DEAD).select(reason).groupBy("reason").agg(F.count("*").alias("messages"))
