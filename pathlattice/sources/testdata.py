"""Graphs derived from the driver's test tables (see FIXTURES.md §2).

* part graph: consecutive line items of one order form a trip ``l_partkey -> next l_partkey`` with
  weight ``l_quantity``; parallel trips collapse to the minimum weight.
* event graph: consecutive events of one (day, event_type) form a trip ``user_id -> next user_id`` with
  weight ``floor(value) + 1`` and ``seq = event_id``; parallel trips keep the last weight.
* coordinates: node ``lat = p_size``, ``lon = p_retailprice`` of ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.operators.sequence import next_in_group


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trip rows ``(ok, ln, src, dst, weight)`` from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("src"),
        F.col("l_suppkey").alias("sk"),
        F.col("l_quantity").alias("qty"),
    )
    t = next_in_group(li, ["ok"], ["ln", "src", "sk", "qty"], "src", "dst")
    return t.filter(F.col("dst").isNotNull()).select(
        "ok", "ln", "src", "dst", F.col("qty").cast("bigint").alias("weight"), "sk", "qty")


def part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst, weight)``: one edge per ordered pair, minimum weight (policy ``min``)."""
    return (part_trips(spark, sf_dir).groupBy("src", "dst")
            .agg(F.min("weight").alias("weight")))


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trip rows ``(seq, src, dst, weight, ts)`` from ``events``; ``seq`` is a unique total order."""
    return event_trips_full(spark, sf_dir).select("seq", "src", "dst", "weight", "ts")


def part_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, lat, lon)`` stand-in positions for part ids."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").cast("double").alias("lat"),
        F.col("p_retailprice").alias("lon"),
    )


# ---------------------------------------------------------------- trip rows, cut, messages, queries

def trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event trips with coordinates of both ends:
    ``(trip_id, seq, src, dst, weight, src_lat, src_lon, dst_lat, dst_lon, kind, day)``."""
    t = event_trips_full(spark, sf_dir)
    c = part_coordinates(spark, sf_dir)
    a = c.select(F.col("id").alias("src"), F.col("lat").alias("src_lat"), F.col("lon").alias("src_lon"))
    b = c.select(F.col("id").alias("dst"), F.col("lat").alias("dst_lat"), F.col("lon").alias("dst_lon"))
    return (t.join(a, "src", "left").join(b, "dst", "left")
            .select(F.col("seq").alias("trip_id"), "seq", "src", "dst", "weight", "src_lat", "src_lon",
                    "dst_lat", "dst_lon", "kind", "day"))


def event_trips_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.col("ts"), F.col("ts").cast("date").alias("day"),
        F.col("event_type").alias("kind"), F.col("user_id").alias("src"),
        (F.floor("value").cast("bigint") + 1).alias("weight"))
    t = next_in_group(ev, ["day", "kind"], ["ts", "seq"], "src", "dst")
    return t.filter(F.col("dst").isNotNull())


def snapshot_cut(spark: SparkSession, sf_dir: str, num: int = 4, den: int = 5) -> int:
    """Change-order split: trips with ``seq <= cut`` form the published snapshot, later ones are updates."""
    m = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return int(m) * num // den


def write_trips_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The trip rows as a trip CSV (header, the seven trip columns, the row order and one unused column)."""
    t = trip_rows(spark, sf_dir)
    t.select("trip_id", F.col("weight").alias("duration_sec"), F.col("src").alias("start_station_id"),
             F.col("src_lat").alias("start_station_latitude"), F.col("src_lon").alias("start_station_longitude"),
             F.col("dst").alias("end_station_id"), F.col("dst_lat").alias("end_station_latitude"),
             F.col("dst_lon").alias("end_station_longitude"), F.col("kind").alias("user_type")) \
        .write.mode("overwrite").option("header", True).csv(path)
    return path


def edge_messages(spark: SparkSession, sf_dir: str, malformed_kind: str | None = "error") -> DataFrame:
    """``(seq, value)`` edge messages of the trip rows; messages of ``malformed_kind`` trips lose their last field."""
    from pathlattice.functions.messages import format_edge
    t = trip_rows(spark, sf_dir)
    v = format_edge()
    if malformed_kind is not None:
        v = F.when(F.col("kind") == malformed_kind, F.regexp_replace(v, r" [^ ]*$", "")).otherwise(v)
    return t.select("seq", v.alias("value"), "kind")


def query_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path queries derived per (day, event type): ``(seq, user, query_id, starts, ends, value)``.

    starts = first and smallest source of the group, ends = last and largest target (one id when equal)."""
    from pathlattice.functions.messages import format_query
    t = event_trips_full(spark, sf_dir)
    g = t.groupBy("day", "kind").agg(
        F.min("seq").alias("seq"), F.min_by("src", "seq").alias("s1"), F.min("src").alias("s2"),
        F.max_by("dst", "seq").alias("e1"), F.max("dst").alias("e2"))
    pair = lambda a, b: F.when(F.col(a) == F.col(b), F.array(a)).otherwise(F.array(a, b))
    q = g.select("seq", F.col("kind").alias("user"),
                 F.col("seq").alias("query_id"),
                 pair("s1", "s2").alias("starts"), pair("e1", "e2").alias("ends"))
    return q.withColumn("value", format_query("starts", "ends"))
