"""Bounded, bidirectional k-best walk search (the path query), for many queries at once.

Semantics (one query = a start set, an end set, ``steps`` and ``k``):
* state rows ``(query_id, side, node, cost, path)``; a start node seeds ``(0, "")`` on side ``start``, an
  end node seeds ``(0, "")`` on side ``end`` (only ids that are nodes of the graph);
* each round ``state = top_k(state ∪ extend(state))`` per ``(query_id, side, node)`` ordered by
  ``(cost, path)``; the start side follows out-edges and appends ``"u w "``, the end side follows
  in-edges and prepends ``" w v"``; walks may repeat nodes and edges;
* after ``steps`` rounds every node reached from both sides joins its start rows with its end rows:
  ``total = cost_s + cost_e``, ``line = "total " + path_s + node + path_e``; distinct lines are the result.

Execution:
* semi-naive: only rows that are new since the last round are extended (a row that was dropped can never
  come back, so older rows' extensions were already kept or beaten); the loop stops early when a round
  adds nothing;
* both sides run in one frame over one doubled adjacency table ``(side, frm, to, weight)``, so a round is
  one join and one ``row_number`` window; Spark splits the window limit into a partial limit before the
  shuffle and a final one after it, so a node with many in-edges sends at most ``k`` rows per map task;
* the frontier is broadcast only when its observed rows and bytes are below ``broadcast_rows`` and
  ``broadcast_bytes`` (both counted in the previous round's job); larger
  frontiers use a shuffle join in which the adjacency of hub nodes is salted over several tasks;
* each round is materialised once with a reliable ``checkpoint`` (the session's ``spark.checkpoint.dir``),
  which cuts the lineage, survives executor loss, and collects the new-row count through ``observe``
  in the same job.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathlattice.session import checkpoint_base, scratch_path

START, END = "start", "end"
STATE_COLS = ["query_id", "side", "node", "cost", "path"]

_obs_ids = itertools.count()
# Bytes per frontier row besides the path text (ids, cost, side, row header), for the broadcast estimate.
_ROW_OVERHEAD = 48
# Bytes per row of the cost-bound table (query_id, side, node, bound).
_BOUND_ROW_BYTES = 48


@dataclass
class SearchConfig:
    steps: int = 5
    k: int = 3
    # Frontier rows and estimated bytes up to which the frontier is broadcast; above either the join shuffles.
    broadcast_rows: int = 2_000_000
    broadcast_bytes: int = 64 * 1024 * 1024
    # Adjacency rows per (side, node) above which a node's edges are salted over several tasks.
    hub_rows: int = 200_000
    # Hub-table rows up to which the hub table itself may be broadcast.
    hub_table_rows: int = 1_000_000
    # Drop candidates that cannot enter a full node's top k before building their path (exact).
    prune: bool = True
    # Where the adjacency lives between rounds: "table" = Parquet in the checkpoint folder, in folders by
    # hash bucket of ``frm`` (a round whose frontier touches few buckets reads only those folders);
    # "cache" = executor cache; "auto" = "table" when the optimizer's size estimate of the edges is at least
    # ``table_min_bytes``. ``adjacency_buckets`` 0 = 4 x default parallelism.
    adjacency_store: str = "auto"
    adjacency_buckets: int = 0
    table_min_bytes: int = 256 * 1024 * 1024


@dataclass
class SearchRun:
    """Outcome of the loop: final state plus per-round counters (rows new in that round, state size)."""

    state: DataFrame
    rounds: list[dict] = field(default_factory=list)


# --------------------------------------------------------------------------------------------------
# queries and seeds


def query_table(spark: SparkSession, queries: Iterable[tuple[int, Sequence, Sequence]],
                id_type: T.DataType = T.LongType()) -> DataFrame:
    """``(query_id, starts, ends)`` from driver-side lists (user input: a handful of ids per query)."""
    schema = T.StructType([
        T.StructField("query_id", T.LongType()),
        T.StructField("starts", T.ArrayType(id_type)),
        T.StructField("ends", T.ArrayType(id_type)),
    ])
    return spark.createDataFrame([(int(q), list(s), list(e)) for q, s, e in queries], schema)


def seed_rows(queries: DataFrame) -> DataFrame:
    """F1 before validation: one row per (query_id, side, node) requested."""
    s = queries.select("query_id", F.lit(START).alias("side"), F.explode(F.array_distinct("starts")).alias("node"))
    e = queries.select("query_id", F.lit(END).alias("side"), F.explode(F.array_distinct("ends")).alias("node"))
    return s.unionByName(e)


def node_ids(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Node ids of the graph: the node table when given, else both ends of every edge (not deduplicated)."""
    if nodes is not None:
        return nodes.select(F.col("id").alias("node"))
    return edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node")))


def valid_seeds(queries: DataFrame, edges: DataFrame, nodes: DataFrame | None = None,
                adj: DataFrame | None = None) -> DataFrame:
    """requested ids that are nodes of the graph.

    The requested ids are few; the node side is scanned once and probed against them, and the distinct
    runs on the matches only (never on the node table). With ``adj`` (cached, both directions) and no
    explicit node table, the node side is the adjacency's ``frm`` column, so the edges are not derived again."""
    seeds = seed_rows(queries)
    wanted = seeds.select("node").distinct()
    side = adj.select(F.col("frm").alias("node")) if (adj is not None and nodes is None) else node_ids(edges, nodes)
    # No hint: a query table from the driver is small and its size estimate exact; a large one shuffles.
    present = side.join(wanted, "node").distinct()
    return seeds.join(present, "node", "left_semi")


def unknown_ids(queries: DataFrame, edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """requested ids that are not nodes, per query and side."""
    seeds = seed_rows(queries)
    wanted = seeds.select("node").distinct()
    present = node_ids(edges, nodes).join(wanted, "node").distinct()
    return seeds.join(present, "node", "left_anti")


# --------------------------------------------------------------------------------------------------
# one round


def adjacency(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Edges stored once per direction: ``start`` rows follow out-edges, ``end`` rows follow in-edges.

    Expects one edge per ordered pair (collapse parallel edges first). A target that is not a node is
    dropped (only possible when an explicit node table is given)."""
    fwd = edges.select(F.lit(START).alias("side"), F.col("src").alias("frm"), F.col("dst").alias("to"), "weight")
    bwd = edges.select(F.lit(END).alias("side"), F.col("dst").alias("frm"), F.col("src").alias("to"), "weight")
    adj = fwd.unionByName(bwd)
    if nodes is not None:
        adj = adj.join(nodes.select(F.col("id").alias("to")), "to", "left_semi")
    return adj.select("side", "frm", "to", "weight")


def extended_path(side: Column, frm: Column, weight: Column, path: Column) -> Column:
    """P5: start side appends ``"u w "``, end side prepends ``" w v"``."""
    u, w = frm.cast("string"), weight.cast("string")
    return F.when(side == F.lit(START), F.concat(path, u, F.lit(" "), w, F.lit(" "))) \
            .otherwise(F.concat(F.lit(" "), w, F.lit(" "), u, path))


def _extension_columns(cost: str = "cost", path: str = "path") -> list[Column]:
    return [
        F.col("query_id"), F.col("side"), F.col("to").alias("node"),
        (F.col(cost) + F.col("weight")).alias("cost"),
        extended_path(F.col("side"), F.col("frm"), F.col("weight"), F.col(path)).alias("path"),
    ]


def expand(frontier: DataFrame, adj: DataFrame, broadcast: bool = True,
           hubs: DataFrame | None = None, bound: DataFrame | None = None) -> DataFrame:
    """J1 + J2: every frontier row extended along every edge of its node on its side.

    ``broadcast=True``: the frontier's size was checked by the caller; the adjacency is not shuffled.
    Otherwise ``adj`` must be the output of ``salted_adjacency`` (column ``salt``, partitioned on the join
    keys) and ``hubs`` its hub table (or None): each frontier row is copied to every salt of its node, so
    only the frontier is shuffled and a hub's edges are joined by ``n_salt`` tasks.

    ``bound(query_id, side, node, bound)``: the k-th best cost of nodes whose state is full (size-checked by
    the caller). A candidate costing more cannot enter that node's top k (k old rows are strictly better),
    so it is dropped before its path text is built and before the shuffle."""
    f = frontier.select("query_id", "side", F.col("node").alias("frm"), "cost", "path")
    if broadcast:
        j = adj.join(F.broadcast(f), ["side", "frm"])
    elif hubs is None:
        j = adj.join(f.withColumn("salt", F.lit(0)), ["side", "frm", "salt"])
    else:
        f_s = f.join(hubs, ["side", "frm"], "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_salt"), F.lit(1)) - 1))).drop("n_salt")
        j = adj.join(f_s, ["side", "frm", "salt"])
    if bound is not None:
        b = F.broadcast(bound.select("query_id", "side", F.col("node").alias("to"), "bound"))
        j = j.join(b, ["query_id", "side", "to"], "left").filter(
            F.col("bound").isNull() | (F.col("cost") + F.col("weight") <= F.col("bound")))
    return j.select(*_extension_columns())


def first_state(seeds: DataFrame) -> DataFrame:
    """The state before the first round: every seed at cost 0 with an empty path, all of it new."""
    return seeds.select("query_id", "side", "node", F.lit(0).cast("bigint").alias("cost"), F.lit("").alias("path"),
                        F.lit(True).alias("is_new"), F.lit(1).alias("rank"))


def hub_table(adj: DataFrame, hub_rows: int) -> DataFrame:
    """Nodes whose adjacency on one side exceeds ``hub_rows``; at most ``|adj| / hub_rows`` rows."""
    return (adj.groupBy("side", "frm").count()
            .filter(F.col("count") > hub_rows)
            .select("side", "frm", F.ceil(F.col("count") / F.lit(hub_rows)).cast("int").alias("n_salt")))


def salted_adjacency(adj: DataFrame, hubs: DataFrame | None, num_partitions: int) -> DataFrame:
    """The adjacency for shuffle joins: a hub's edges get ``salt = hash(to) mod n_salt``, others salt 0; the
    table is hash-partitioned on ``(side, frm, salt)`` once, so later rounds shuffle only the frontier."""
    if hubs is None:
        salted = adj.withColumn("salt", F.lit(0))
    else:
        salted = adj.join(hubs, ["side", "frm"], "left").withColumn(
            "salt", F.when(F.col("n_salt").isNull(), F.lit(0))
                     .otherwise(F.pmod(F.xxhash64("to"), F.col("n_salt")).cast("int"))).drop("n_salt")
    return salted.repartition(num_partitions, "side", "frm", "salt")


def top_k(rows: DataFrame, k: int, keys: Sequence[str] = ("query_id", "side", "node")) -> DataFrame:
    """Best ``k`` rows per key by ``(cost, path)``."""
    w = Window.partitionBy(*keys).orderBy("cost", "path")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def cost_bounds(state: DataFrame, k: int) -> DataFrame:
    """``(query_id, side, node, bound)`` for nodes holding k rows: the cost of their k-th row."""
    return state.filter(F.col("rank") == k).select("query_id", "side", "node", F.col("cost").alias("bound"))


def step(state: DataFrame, adj: DataFrame, k: int, broadcast: bool = True,
         hubs: DataFrame | None = None, prune: bool = False) -> DataFrame:
    """One semi-naive round: extend the new rows, merge with the old state, keep the best ``k``.

    Input and output carry ``is_new``; rows kept from the old state are no longer new."""
    frontier = state.filter(F.col("is_new"))
    bound = cost_bounds(state, k) if prune else None
    ext = expand(frontier, adj, broadcast=broadcast, hubs=hubs, bound=bound).withColumn("is_new", F.lit(True))
    old = state.select(*STATE_COLS, F.lit(False).alias("is_new"))
    return top_k(old.unionByName(ext), k)


def bucket_of(col: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def _materialise(df: DataFrame, buckets: int = 0) -> tuple[DataFrame, dict]:
    """Checkpoint a round; the same job counts new rows, their bytes, the state size and (with ``buckets``)
    the set of adjacency buckets the new rows sit in (at most ``buckets`` values)."""
    obs = Observation(f"ksp_round_{next(_obs_ids)}")
    new_bytes = F.sum(F.when(F.col("is_new"), F.length("path") + F.lit(_ROW_OVERHEAD)).otherwise(F.lit(0)))
    metrics = [F.count_if(F.col("is_new")).alias("new_rows"),
               F.coalesce(new_bytes, F.lit(0)).cast("bigint").alias("new_bytes"),
               F.count(F.lit(1)).alias("state_rows")]
    if buckets:
        metrics.append(F.collect_set(F.when(F.col("is_new"), bucket_of(F.col("node"), buckets))).alias("new_buckets"))
    out = df.observe(obs, *metrics).checkpoint(eager=True)
    return out, dict(obs.get)


def _adjacency_table(adj: DataFrame, path: str, buckets: int) -> DataFrame:
    """Write the adjacency once, one folder per bucket of ``frm``, sorted by ``(side, frm)`` inside."""
    # a rebalanced exchange: AQE splits a bucket with a hub over several writing tasks
    (adj.withColumn("b", bucket_of(F.col("frm"), buckets)).hint("rebalance", "b")
     .sortWithinPartitions("b", "side", "frm").write.mode("overwrite").partitionBy("b").parquet(path))
    schema = T.StructType(adj.schema.fields + [T.StructField("b", T.IntegerType())])
    return adj.sparkSession.read.schema(schema).parquet(path)


def _estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (from file sizes; no job); None where the session has no JVM plan."""
    if not hasattr(df, "_jdf"):
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# --------------------------------------------------------------------------------------------------
# the loop and the result


@dataclass
class PreparedGraph:
    """The adjacency of one edge-table version, ready for searches (see ``prepare``)."""

    adj: DataFrame
    buckets: int = 0
    cached: list = field(default_factory=list)
    written: list = field(default_factory=list)

    def release(self) -> None:
        for df in self.cached:
            df.unpersist()
        for path in self.written:
            _delete(self.adj.sparkSession, path)


def prepare(edges: DataFrame, nodes: DataFrame | None = None, config: SearchConfig | None = None) -> PreparedGraph:
    """Build the doubled adjacency once (Parquet bucket folders or executor cache, see ``SearchConfig``).

    A stream of query batches against the same edge-table version prepares it once and passes it to every
    ``search``; ``release`` drops it when the version changes."""
    cfg = config or SearchConfig()
    spark = edges.sparkSession
    store = cfg.adjacency_store
    if store == "auto":
        size = _estimated_bytes(edges)
        store = "table" if size is None or size >= cfg.table_min_bytes else "cache"
    if store == "table":
        buckets = cfg.adjacency_buckets or 4 * spark.sparkContext.defaultParallelism
        path = scratch_path(spark, "adjacency")
        return PreparedGraph(_adjacency_table(adjacency(edges, nodes), path, buckets), buckets, written=[path])
    # The doubled adjacency is a union of two scans; without a cap it keeps the sum of both sides'
    # partitions (e.g. 2 x spark.sql.shuffle.partitions) and every round pays for that many small tasks.
    adj = adjacency(edges, nodes).coalesce(2 * spark.sparkContext.defaultParallelism) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    return PreparedGraph(adj, 0, cached=[adj])


def search(edges: DataFrame, queries: DataFrame, config: SearchConfig | None = None,
           nodes: DataFrame | None = None,
           between_rounds: Callable[[int, DataFrame], DataFrame] | None = None,
           prepared: PreparedGraph | None = None) -> SearchRun:
    """G1 + G2 (+ G4): run the rounds for every query of ``queries`` together.

    ``between_rounds(round, state)`` may return a filtered state (e.g. drop superseded queries); it is asked in each round, before
    the round is materialised and counted;
    ``prepared``: an adjacency built by ``prepare`` for these edges (kept after the search)."""
    cfg = config or SearchConfig()
    spark = edges.sparkSession
    checkpoint_base(spark)

    own = prepared is None
    graph = prepare(edges, nodes, cfg) if own else prepared
    adj, buckets = graph.adj, graph.buckets
    cached: list[DataFrame] = []  # per-search extras (hub table, salted adjacency)
    shuffled = None  # (salted adjacency, hub table or None), built the first time a frontier is too large
    try:
        seeds = valid_seeds(queries, edges, nodes, adj=adj)
        state, counters = _materialise(first_state(seeds), buckets)
        run = SearchRun(state, [dict(round=0, **{k: v for k, v in counters.items() if k != "new_buckets"})])
        for r in range(1, cfg.steps + 1):
            frontier_rows = counters["new_rows"]
            if frontier_rows == 0:
                break
            broadcast = frontier_rows <= cfg.broadcast_rows and counters["new_bytes"] <= cfg.broadcast_bytes
            # the bound table has at most state_rows / k rows of fixed width
            prune = cfg.prune and (counters["state_rows"] // cfg.k) * _BOUND_ROW_BYTES <= cfg.broadcast_bytes
            if broadcast:
                scan = adj
                touched = counters.get("new_buckets")
                if buckets and touched is not None and len(touched) <= buckets // 2:
                    scan = adj.filter(F.col("b").isin(sorted(touched)))  # partition pruning: only those folders
                nxt = step(state, scan, cfg.k, broadcast=True, prune=prune)
            else:
                if shuffled is None:
                    hubs = hub_table(adj, cfg.hub_rows).persist(StorageLevel.MEMORY_AND_DISK)
                    cached.append(hubs)
                    if hubs.count() <= cfg.hub_table_rows:
                        hubs = F.broadcast(hubs)  # beyond it, the hub list is joined by a shuffle, with the same salts
                    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
                    salted = salted_adjacency(adj, hubs, n).persist(StorageLevel.MEMORY_AND_DISK)
                    cached.append(salted)
                    shuffled = (salted, hubs)
                nxt = step(state, shuffled[0], cfg.k, broadcast=False, hubs=shuffled[1], prune=prune)
            if between_rounds is not None:  # before the round is stored, so that it holds and counts what goes on
                nxt = between_rounds(r, nxt)
            state, counters = _materialise(nxt, buckets)
            run.rounds.append(dict(round=r, broadcast=broadcast,
                                   **{k: v for k, v in counters.items() if k != "new_buckets"}))
        run.state = state
        return run
    finally:
        for df in cached:
            df.unpersist()
        if own:  # rounds are checkpointed; the adjacency is not needed after the loop
            graph.release()


def meet(state: DataFrame) -> DataFrame:
    """J4 + F3: every start row × every end row at the same node of the same query (at most k × k)."""
    s = state.filter(F.col("side") == START).select(
        "query_id", "node", F.col("cost").alias("cost_s"), F.col("path").alias("path_s"))
    e = state.filter(F.col("side") == END).select(
        "query_id", "node", F.col("cost").alias("cost_e"), F.col("path").alias("path_e"))
    m = s.join(e, ["query_id", "node"])
    total = F.col("cost_s") + F.col("cost_e")
    return m.select(
        "query_id", "node", total.alias("total"),
        F.concat(total.cast("string"), F.lit(" "), F.col("path_s"), F.col("node").cast("string"),
                 F.col("path_e")).alias("line"))


def hop_count(line: Column) -> Column:
    """Hops of a result line ``total n0 w0 … nk``."""
    return ((F.size(F.split(line, " ")) - 2) / 2).cast("bigint")


def results(state: DataFrame) -> DataFrame:
    """Distinct ``(query_id, total, line)``; the same walk met at several nodes appears once."""
    return (meet(state).select("query_id", "total", "line").distinct()
            .withColumn("hops", hop_count(F.col("line"))))


def k_shortest_paths(edges: DataFrame, queries: DataFrame, config: SearchConfig | None = None,
                     nodes: DataFrame | None = None, prepared: PreparedGraph | None = None) -> DataFrame:
    """``(query_id, total, hops, line)`` for all queries; unordered (rank with ``ranked``)."""
    return results(search(edges, queries, config, nodes, prepared=prepared).state)
