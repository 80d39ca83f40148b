"""Order-dependent row operators that stay safe when one group holds a large share of the rows.

``lead(v) OVER (PARTITION BY g ORDER BY o)`` sends every row of a group to one task. Here the rows are first
counted per hash bucket of the group (one small row per bucket and task; nothing else is shuffled), and the groups of
buckets with more than ``hot_rows`` rows one by one (an aggregate with a map-side step). Groups up to ``hot_rows`` rows use the plain
window. Rows of larger ("hot") groups are range-partitioned on ``(g, o)`` instead, so a hot group is spread
over several blocks; the window runs per ``(g, block)`` and block boundaries are stitched from a block table
of at most ``hot groups + blocks`` rows. The hot-group list has at most ``rows / hot_rows`` keys, which is
the bound that lets it be broadcast.

The block path reads the partitioned rows twice (block summary and rows), so they are materialised once
in the checkpoint folder: a second range exchange would sample its own bounds and disagree on blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows per group above which a group is split over several tasks.
HOT_ROWS = 2_000_000
# Hash buckets counted before the groups themselves: a bucket of at most ``hot_rows`` rows holds no hot group.
COUNT_BUCKETS = 4096


def _split_hot(df: DataFrame, group_cols: list[str], hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups or None when there is no hot group)."""
    bucket = F.pmod(F.xxhash64(*group_cols), F.lit(COUNT_BUCKETS))
    full = [r[0] for r in df.groupBy(bucket.alias("_b")).count().filter(F.col("count") > hot_rows).collect()]  # at most COUNT_BUCKETS
    if not full:
        return df, None
    hot = df.filter(bucket.isin(full)).groupBy(*group_cols).count().filter(F.col("count") > hot_rows).select(*group_cols)
    keys = hot.collect()  # bounded: at most rows / hot_rows keys
    if not keys:
        return df, None
    names = [f"_hot_{c}" for c in group_cols]
    hot_df = F.broadcast(df.sparkSession.createDataFrame(keys, hot.schema).toDF(*names))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in zip(group_cols, names)))  # null is a group
    return df.join(hot_df, same, "left_anti"), df.join(hot_df, same, "left_semi")


def _blocks(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Range-partition on ``keys`` and record the block id of each row (materialised, see module doc)."""
    return df.repartitionByRange(n, *keys).withColumn("_blk", F.spark_partition_id()).checkpoint(eager=True)


def next_in_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], value_col: str,
                  out_col: str, num_blocks: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """Adds ``out_col`` = ``value_col`` of the next row of the same group in ``order_cols`` order (null for the last)."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    plain, hot = _split_hot(df, group_cols, HOT_ROWS if hot_rows is None else hot_rows)
    out = plain.withColumn(out_col, F.lead(value_col).over(Window.partitionBy(*group_cols).orderBy(*order_cols)))
    if hot is None:
        return out
    n = num_blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _blocks(hot, group_cols + order_cols, n)
    blocks = ranged.groupBy(*group_cols, "_blk").agg(
        F.min_by(value_col, F.struct(*order_cols)).alias("_head"))
    carry = blocks.select(
        *group_cols, "_blk",
        F.lead("_head").over(Window.partitionBy(*group_cols).orderBy("_blk")).alias("_carry"))
    in_block = Window.partitionBy(*group_cols, "_blk").orderBy(*order_cols)
    split = (ranged
             .withColumn("_is_last", F.lead(F.lit(True)).over(in_block).isNull())
             .withColumn(out_col, F.lead(value_col).over(in_block))
             .join(carry, group_cols + ["_blk"], "left"))
    split = split.withColumn(out_col, F.when(F.col("_is_last"), F.col("_carry")).otherwise(F.col(out_col)))
    return out.unionByName(split.drop("_blk", "_carry", "_is_last"))


def rank_in_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], out_col: str,
                  num_blocks: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """Adds ``out_col`` = ``row_number() OVER (PARTITION BY group ORDER BY order)`` (1-based, bigint).

    In hot groups rows are numbered per ``(group, block)`` and each block adds the row count of the earlier
    blocks of its group (a running sum over the small block table). ``order_cols`` should be a total order
    within a group; ties are numbered in an unspecified order."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    plain, hot = _split_hot(df, group_cols, HOT_ROWS if hot_rows is None else hot_rows)
    out = plain.withColumn(out_col, F.row_number().over(
        Window.partitionBy(*group_cols).orderBy(*order_cols)).cast("bigint"))
    if hot is None:
        return out
    n = num_blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _blocks(hot, group_cols + order_cols, n)
    earlier = Window.partitionBy(*group_cols).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*group_cols, "_blk").count()
               .select(*group_cols, "_blk", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_off")))
    in_block = Window.partitionBy(*group_cols, "_blk").orderBy(*order_cols)
    split = ranged.withColumn("__blk_rn", F.row_number().over(in_block)).join(offsets, group_cols + ["_blk"])
    split = split.withColumn(out_col, (F.col("_off") + F.col("__blk_rn")).cast("bigint")) \
        .drop("_blk", "_off", "__blk_rn")
    return out.unionByName(split)
