"""Connected groups under an exact link test, without making all pairs of a large group.

Given postings ``(key, node)`` such that every linked pair shares a key, the groups are found in two steps. First, in each
key's list the node that shares most list entries over all keys leads (in a group of copies that is the text they were
made from), and each node is tested with the highest leader of its lists. Connected components of these links settle most of a large group with as many
tests as it has members. Second, whatever the first step left apart is tested in full: in each list, every node of a
component is paired with the nodes of larger components (size, then id, breaks ties), so each pair in one list but in two
components is tested exactly once, and no pair inside a component is. The result is that of testing all pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm.common import components, drop, small, stage


ROUNDS = 6


def refuted(spark: SparkSession, facing: DataFrame, more: list[str], refute: Callable[[DataFrame], DataFrame], name: str,
            tested: DataFrame | None = None) -> DataFrame:
    """The pairs ``node, leader`` of ``facing`` that are not refuted and not among ``tested (a, b)``, each once, with the columns ``more``."""
    facing = stage(spark, facing.distinct(), f"{name}-facing")
    pairs = facing.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    out = facing.join(refute(pairs), (F.least("node", "leader") == F.col("a")) & (F.greatest("node", "leader") == F.col("b"))) \
        .select("node", "leader", *more)
    out.spent = facing
    return out


def linked_groups(spark: SparkSession, index: DataFrame, probe: DataFrame | None,
                  verify: Callable[[DataFrame], DataFrame], name: str, wider: DataFrame | None = None,
                  close: Callable[[Column, Column], Column] | None = None, spent: DataFrame | None = None,
                  told: DataFrame | None = None, may_link: Callable[[Column, Column], Column] | None = None,
                  refute: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``node, component`` of all nodes with a link; ``component`` is the smallest node of the group.

    ``index (key, node)``: the postings. ``probe``: the ``(key, node)`` requests of all nodes; whichever end of a link
    asks, it must have a request for a key under which the other end stands. Without it, the postings are the requests.
    ``wider``: more postings that only answer requests. ``close``: a cheap necessary condition on the ``mark`` column that the
    postings then carry; pairs that fail it are never sent on. ``verify``: the linked pairs among ``(a, b)``.
    ``spent``: the staged table behind the postings, if it may be deleted when they have been read for the last time.
    ``told (node, told)`` and ``may_link``: a stronger necessary condition, on a wider column that only joins the rows of lists that the
    first step left apart; refuted pairs make no rows.
    ``refute`` (only without ``probe``): a stronger necessary condition on ``(a, b)``. With it a node is tested with the highest leader that it may
    be linked with, and the first step is repeated, each list led by its largest component, while that finds many more links."""
    if close is None:
        index = index.withColumn("mark", F.lit(None).cast("bigint"))
    near = close or (lambda x, y: F.lit(True))
    sizes = stage(spark, index.groupBy("key").agg(F.count(F.lit(1)).alias("len")).filter("len > 1"), f"{name}-lists")
    runs = stage(spark, index.join(small(sizes, sizes.count(), 32), "key").select("key", "node", "mark", "len"),
                 f"{name}-runs")
    drop(sizes)
    if spent is not None and probe is None:
        drop(spent)
    degree = runs.groupBy("node").agg(F.sum(F.col("len") - 1).alias("degree"))
    # degree first, then the smaller node, as one sortable pair of numbers
    ranked = runs.join(degree, "node").select("key", F.struct(
        F.col("degree"), (-F.col("node")).alias("low"), "mark").alias("rank"))
    leaders = ranked.groupBy("key").agg(F.max("rank").alias("rank")).select(
        "key", "rank.degree", (-F.col("rank.low")).alias("leader"), F.col("rank.mark").alias("leader_mark"))
    # of the leaders of its lists a node is tested with the highest only; what that leaves apart is the second step's
    facing = runs.join(leaders, "key").filter((F.col("node") != F.col("leader")) & near(F.col("mark"), F.col("leader_mark")))
    if refute is not None:
        facing = refuted(spark, facing.select("node", "leader", "degree"), ["degree"], refute, name)
    star = facing.groupBy("node").agg(F.max(F.struct("degree", (-F.col("leader")).alias("low"))).alias("best")) \
        .select("node", (-F.col("best.low")).alias("leader")) \
        .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    star = stage(spark, star, f"{name}-star")
    if refute is not None:
        drop(facing.spent)
    edges = stage(spark, verify(star).select("a", "b"), f"{name}-edges")

    if probe is not None:
        drop(runs)

    def sized(links):
        links = components(spark, links)
        return stage(spark, links.join(links.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component"),
                     f"{name}-found")

    found = sized(edges)

    def place(postings):
        return postings.join(found, "node", "left").select(
            "key", "node", "mark", F.struct(F.coalesce("size", F.lit(1)).alias("size"),
                                            F.coalesce("component", "node").alias("component")).alias("place"))

    # without requests of their own, nodes alone in their lists cannot meet anyone
    def marked(postings):
        return postings if "mark" in postings.columns else postings.withColumn("mark", F.lit(None).cast("bigint"))

    answering = runs.select("key", "node", "mark") if probe is None else \
        index if wider is None else index.unionByName(marked(wider))
    placed = stage(spark, place(answering), f"{name}-placed")
    for _ in range(ROUNDS if refute is not None else 0):
        tops = placed.groupBy("key").agg(F.max(F.struct("place", "node", "mark")).alias("top"))
        facing = placed.join(tops, "key").filter((F.col("place") < F.col("top.place")) & near(F.col("mark"), F.col("top.mark"))) \
            .select("node", F.col("top.node").alias("leader"), F.col("place.component").alias("own"),
                    F.col("top.place.component").alias("other"))
        facing = refuted(spark, facing, ["own", "other"], refute, name, star)
        # of the pairs between two components one for each node
        tests = facing.groupBy("node", "own", "other").agg(F.max("leader").alias("leader")) \
            .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
        tests = stage(spark, tests, f"{name}-star")
        drop(facing.spent)
        more = stage(spark, verify(tests).select("a", "b"), f"{name}-edges")
        known, linked = edges.count(), more.count()
        before = star, edges, found, placed
        star = stage(spark, star.unionByName(tests), f"{name}-star")
        edges = stage(spark, edges.unionByName(more), f"{name}-edges")
        drop(tests, more, *before[:2])
        if linked <= known // 10:  # the old places only keep a few pairs more
            break
        found = sized(edges)
        placed = stage(spark, place(answering), f"{name}-placed")
        drop(*before[2:])
    tops = placed.groupBy("key").agg(F.max("place").alias("top"))
    asked = placed if probe is None else place(marked(probe))
    asking = asked.join(tops, "key").filter("place < top").select("key", F.col("node").alias("x"), F.col("place").alias("own"),
                                                                  F.col("mark").alias("own_mark"))
    facing, passes = placed, near(F.col("own_mark"), F.col("mark"))
    if told is not None:
        asking = stage(spark, asking, f"{name}-asking")
        facing = placed.join(asking.select("key").distinct(), "key", "left_semi").join(told, "node")
        passes = passes & may_link(F.col("own_told"), F.col("told"))
        asked_with = asking.join(told.select(F.col("node").alias("x"), F.col("told").alias("own_told")), "x")
    else:
        asked_with = asking
    pairs = asked_with.join(facing, "key").filter((F.col("own") < F.col("place")) & passes).select(
        F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    if refute is not None:
        facing = stage(spark, pairs, f"{name}-pairs")
        pairs = refute(facing)
    rest = stage(spark, pairs.join(star, ["a", "b"], "left_anti"), f"{name}-rest")
    drop(star, placed, found, *([runs] if probe is None else []), *([asking] if told is not None else []))
    if refute is not None:
        drop(facing)
    if spent is not None and probe is not None:
        drop(spent)
    more = stage(spark, verify(rest).select("a", "b"), f"{name}-edges")
    drop(rest)
    return components(spark, edges.unionByName(more))
