"""Message stream sources (S6, S7), sinks (K3-K5), progress, and the two-topic demultiplexer.

A stream row is ``(seq, partition, offset, value)``.

``seq`` is the total order of the messages, which every consumer compares and none computes with: a bigint in files, from
Kafka ``(timestamp, partition, offset)`` as one decimal(38,0) (a decimal stays in the mutable buffers of hash aggregates, unlike a struct
or text). Offsets only order one partition, so a later message of another partition is later by its time. Messages are written with
the edge as key, so all changes of one edge share a partition and keep their order even where clocks disagree.

``partition, offset`` is the message's place, and what has been taken in is a *progress* table ``(partition, offset)``: the last offset
per partition. Progress is never judged by ``seq``: a message of a slow partition may be older than others that were taken in before it.
Files without these columns count as one partition with ``seq`` as offset; tests use files because no Kafka connector is on this
class path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.schemas import MESSAGE


def message_stream(spark: SparkSession, fmt: str, path: str | None = None, topic: str | None = None,
                   options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming ``(seq, partition, offset, value)`` table from Kafka (``fmt='kafka'``) or from files."""
    opts = dict(options or {})
    if fmt == "kafka":
        r = spark.readStream.format("kafka").option("subscribe", topic)
        for k, v in opts.items():
            r = r.option(k, v)
        df = r.load()
        return kafka_messages(df)
    r = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in opts.items():
        r = r.option(k, v)
    return with_place(r.format(fmt).load(path)).select("seq", "partition", "offset", "value")


def kafka_messages(rows: DataFrame) -> DataFrame:
    """Rows in Kafka's columns as messages."""
    return rows.select(message_order().alias("seq"), "partition", "offset", F.col("value").cast("string").alias("value"))


def with_place(messages: DataFrame) -> DataFrame:
    """``partition`` and ``offset`` filled in where a message does not carry them."""
    have = set(messages.columns)
    partition = F.coalesce("partition", F.lit(0)) if "partition" in have else F.lit(0)
    offset = F.expr("try_cast(seq AS bigint)")
    offset = F.coalesce("offset", offset) if "offset" in have else offset
    return messages.withColumn("partition", partition).withColumn("offset", offset)


def progress_of(messages: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``(partition, offset)``: the last offset per partition of ``messages`` and of the progress ``before``."""
    rows = messages.select("partition", "offset")
    if before is not None:
        rows = rows.unionByName(before.select("partition", "offset"))
    return rows.groupBy("partition").agg(F.max("offset").alias("offset"))


def not_covered(messages: DataFrame, progress: DataFrame) -> DataFrame:
    """The messages that a progress does not hold yet. A progress has one row per partition of the topic."""
    done = progress.select("partition", F.col("offset").alias("_done"))
    return messages.join(done, "partition", "left").filter(F.col("_done").isNull() | (F.col("offset") > F.col("_done"))) \
        .select(*messages.columns)


def message_order() -> Column:
    """``(timestamp, partition, offset)`` of a Kafka row as one number: 15 + 5 + 18 digits."""
    digits = ((F.unix_millis("timestamp"), 15), (F.col("partition"), 5), (F.col("offset"), 18))
    return F.concat(*(F.lpad(c.cast("string"), n, "0") for c, n in digits)).cast("decimal(38,0)")


def write_messages(messages: DataFrame, fmt: str, checkpoint: str, topic: str | None = None, path: str | None = None,
                   options: dict | None = None, processing_time: str | None = None):
    """K3-K5: a stream of ``(key, value)`` rows to Kafka (``fmt='kafka'``) or to files; returns the started query."""
    w = messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")) \
        .writeStream.format(fmt).option("checkpointLocation", checkpoint)
    for k, v in {**({"topic": topic} if topic else {}), **({"path": path} if path else {}), **(options or {})}.items():
        w = w.option(k, v)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()


def message_sink(fmt: str, topic: str | None = None, path: str | None = None,
                 options: dict | None = None) -> Callable[[DataFrame, int], None]:
    """K3: a function ``(rows, batch_id)`` that sends rows ``(query_id, rank, total, key, value)`` to Kafka (``fmt='kafka'``) or files.

    A sink may deliver a batch again after a failure; the key sent is ``<batch>/<query>/<rank>``, the same in each try, so
    ``first_delivery`` (or a compacted topic) leaves one. Files are one folder per batch, which a second try replaces."""
    def send(rows: DataFrame, batch_id: int) -> None:
        key = F.concat_ws("/", F.lit(str(batch_id)), F.col("query_id").cast("string"), F.col("rank").cast("string"))
        w = rows.select(key.alias("key"), F.col("value").cast("string").alias("value")).write.format(fmt)
        for k, v in {**({"topic": topic} if topic else {}), **(options or {})}.items():
            w = w.option(k, v)
        if path is None:
            w.mode("append").save()
        else:
            w.mode("overwrite").save(f"{path.rstrip('/')}/batch={batch_id}")
    return send


def first_delivery(messages: DataFrame) -> DataFrame:
    """Messages without repeated deliveries of one key."""
    return messages.dropDuplicates(["key"])


def demux(messages: DataFrame, edges_topic: str = "new_edges", result_topic: str = "result") -> tuple[DataFrame, DataFrame]:
    """One consumer over two topics → (all edge messages, the last result message).

    The last message is the one with the highest time, then partition and offset. On a streaming table the edge side is
    an append stream and the result side a running aggregate (update or complete mode)."""
    edges = messages.filter(F.col("topic") == edges_topic).select("partition", "offset", "value")
    last = (messages.filter(F.col("topic") == result_topic)
            .agg(F.max_by("value", message_order()).alias("value"))
            .filter(F.col("value").isNotNull()))
    return edges, last
