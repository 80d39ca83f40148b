"""Speed-layer operators: re-weight already computed candidate walks with edge updates and re-rank them.

Candidate walks are result rows ``(query_id, total, line)``. They are exploded to hops
``(query_id, line, pos, src, weight, dst)``, hops are left-joined with the last update per edge, and the
walk is re-assembled per ``(query_id, line)`` — a group of at most ``2 * steps`` hops. Updates are absolute
weights, so applying them is idempotent and the last update per edge equals a sequential replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathlattice.functions.messages import decode_hops, encode_line, is_zero_hop
from pathlattice.sources.streams import not_covered, with_place


def hops(candidates: DataFrame) -> DataFrame:
    """P6 on a table: one row per hop, ``pos`` 0-based."""
    return candidates.select("query_id", "line", F.posexplode(decode_hops("line")).alias("pos", "h")).select(
        "query_id", "line", F.col("pos").cast("bigint").alias("pos"), "h.src", "h.weight", "h.dst")


def last_update_per_edge(updates: DataFrame, since_seq=None) -> DataFrame:
    """Updates ``(seq, src, dst, weight)`` → the newest weight per edge, optionally only ``seq > since_seq``."""
    u = updates if since_seq is None else updates.filter(F.col("seq") > F.lit(since_seq))
    return u.groupBy("src", "dst").agg(F.max_by("weight", "seq").alias("new_weight"))


def reweight(candidates: DataFrame, latest: DataFrame) -> DataFrame:
    """J10 + A8: ``(query_id, old_line, total, line)`` with every occurrence of an updated edge re-weighted.

    ``latest(src, dst, new_weight)``: one row per edge. The join is left to AQE, which broadcasts the update
    side when its measured size is small (the usual micro-batch) and shuffles otherwise."""
    h = hops(candidates).join(latest, ["src", "dst"], "left").withColumn(
        "w", F.coalesce("new_weight", "weight"))
    walks = h.groupBy("query_id", "line").agg(
        F.sum("w").alias("total"),
        F.array_sort(F.collect_list(F.struct("pos", "src", F.col("w").alias("weight"), "dst"))).alias("hs"))
    walks = walks.select("query_id", F.col("line").alias("old_line"), "total", "hs")
    out = walks.select("query_id", "old_line", "total",
                       encode_line("total", F.col("hs")[0]["src"], "hs").alias("line"))
    # zero-hop walks have no hop rows: they keep their line and total 0
    zero = candidates.filter(is_zero_hop("line")).select(
        "query_id", F.col("line").alias("old_line"), F.lit(0).cast("bigint").alias("total"), "line")
    return out.unionByName(zero)


def best_k(paths: DataFrame, k: int = 3, keys=("query_id",)) -> DataFrame:
    """Best ``k`` walks per query by ``(total, line)`` with their rank.

    ``row_number <= k`` is planned as a partial limit before the shuffle, so a query with many candidate
    walks sends at most ``k`` rows per map task."""
    w = Window.partitionBy(*keys).orderBy("total", "line")
    return paths.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .withColumn("rank", F.col("rank").cast("bigint"))


def last_places(updates: DataFrame) -> DataFrame:
    """The newest update per edge with its place: ``(src, dst, new_weight, seq, partition, offset)``."""
    return updates.groupBy("src", "dst").agg(
        F.max_by("weight", "seq").alias("new_weight"), F.max("seq").alias("seq"),
        F.max_by("partition", "seq").alias("partition"), F.max_by("offset", "seq").alias("offset"))


def replay(candidates: DataFrame, update_log: DataFrame, progress: DataFrame) -> DataFrame:
    """ST5 / ST10: candidates computed on a snapshot that holds the messages of ``progress (partition, offset)``, overlaid by the others.

    Of each edge the newest update of the log counts; where the snapshot holds that one, its weight is in the candidates already.
    An update that came late, older in time than the snapshot's newest but not in it, is replayed."""
    return reweight(candidates, not_covered(last_places(with_place(update_log)), progress).select("src", "dst", "new_weight"))
