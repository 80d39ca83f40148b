"""Structured Streaming jobs around the batch operators.

Every sink write is keyed by the micro-batch id (``…/batch=<id>`` or ``…/v=<id>``, mode overwrite), so a
retried batch overwrites its own output (exactly-once on top of the checkpointed source offsets). Tests run
the streams with ``availableNow``; a deployment uses ``processing_time="2 seconds"`` (ST1).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.functions.messages import parse_edges, parse_query
from pathlattice.operators import graph as G
from pathlattice.operators import updates as U
from pathlattice.plans import ksp
from pathlattice.sources import snapshot as S
from pathlattice.sources.keyed import KeyedTable
from pathlattice.sources.streams import not_covered, progress_of, with_place


def _start(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None,
           output_mode: str = "append", processing_time: str | None = None, fmt: str | None = None,
           path: str | None = None):
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    if sink is not None:
        w = w.foreachBatch(sink)
    else:
        w = w.format(fmt).option("path", path)
    return w.start()


def run(query, timeout_s: float | None = None):
    """Wait until an ``availableNow`` stream has drained; re-raise its failure.

    Without ``timeout_s`` it waits as long as the stream takes. With it, a stream that is still running is stopped
    and ``TimeoutError`` raised, so nobody goes on with a part of the sink."""
    done = query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if timeout_s is not None and not done:
        query.stop()
        raise TimeoutError(f"the stream was still running after {timeout_s} s; its sink is incomplete")
    return query


# ---------------------------------------------------------------- ST1 + P1: parsed edge stream

def parsed_edge_stream(messages: DataFrame) -> DataFrame:
    """ST1 / P1: ``(seq, src, weight, dst, …, valid)``."""
    return parse_edges(messages, keep=("seq",))


def edge_updates(messages: DataFrame) -> DataFrame:
    """The valid edge updates of messages, with their place in the topic."""
    return parse_edges(with_place(messages), keep=("seq", "partition", "offset")).filter("valid").drop("valid")


def collect_edges(messages: DataFrame, sink_path: str, checkpoint: str, processing_time: str | None = None):
    """S6 sink: parsed edge updates appended as Parquet (valid and quarantined rows, flagged)."""
    return _start(parsed_edge_stream(messages), checkpoint, fmt="parquet", path=sink_path,
                  processing_time=processing_time)


def collect_queries(messages: DataFrame, sink_path: str, checkpoint: str, processing_time: str | None = None):
    """S7 sink: parsed path queries ``(seq, starts, ends)``."""
    p = messages.select("seq", "value", parse_query("value").alias("q")).select(
        "seq", "value", "q.starts", "q.ends")
    return _start(p, checkpoint, fmt="parquet", path=sink_path, processing_time=processing_time)


# ---------------------------------------------------------------- ST2: continuous edge upsert

def edge_upsert_stream(messages: DataFrame, sink_path: str, checkpoint: str, compact_every: int = 10,
                       processing_time: str | None = None):
    """ST2: stateful per-edge aggregate (last weight, first coordinates) in update mode.

    State holds one row per distinct edge and topic partition (RocksDB; no watermark: edges never expire). Each batch's updated
    rows go into the versioned edge store at ``sink_path``: the first batch as a full version, later ones as
    deltas, compacted every ``compact_every`` batches; ``current_edges`` merges them. The progress of the topic's partitions is
    kept with each version."""
    agg = edge_updates(messages).groupBy("src", "dst", "partition").agg(
        F.max_by("weight", "seq").alias("weight"), F.max("seq").alias("last_seq"),
        *(F.min_by(c, "seq").alias(c) for c in G.COORDINATES), F.min("seq").alias("first_seq"), F.max("offset").alias("offset"))
    spark = messages.sparkSession

    def sink(df: DataFrame, batch_id: int):
        rows = df.select(*G.EDGE_STATE, "partition", "offset")
        have = [x for x in S.edge_versions(spark, sink_path) if x[0] <= batch_id]
        S.write_progress(progress_of(rows, S.read_progress(spark, sink_path, batch_id)), sink_path, batch_id + 1)
        if not have:
            S.write_edge_full(G.edge_state(rows), sink_path, batch_id + 1)
        else:
            _publish(spark, sink_path, rows, batch_id + 1, compact_every)

    return _start(agg, checkpoint, sink=sink, output_mode="update", processing_time=processing_time)


def current_edges(spark: SparkSession, sink_path: str) -> DataFrame:
    """The current edge table written by ``edge_upsert_stream`` (newest full version + later deltas)."""
    return S.read_edge_table(spark, sink_path)


# ---------------------------------------------------------------- ST3: snapshot publishing

def publish_stream(messages: DataFrame, base_state: DataFrame, snapshot_base: str, log_path: str,
                   checkpoint: str, min_changes: int = 5, max_delay_s: float = 2.0, compact_every: int = 10,
                   processing_time: str | None = None, base_progress: DataFrame | None = None):
    """ST3: keep a change log; publish a new edge-table version when more than ``min_changes`` changes are
    pending, or at least one is pending and ``max_delay_s`` passed since the last publish.

    A publish writes only the changed edges (a delta version); every ``compact_every`` publishes a full
    version is compacted (``S.read_edge_table`` merges). Version ``v=b+1`` holds every change-log batch up
    to ``b``, so "pending" is decided by batch id, not by ``seq``: messages may arrive out of ``seq`` order
    (Kafka partitions, file listings). Values are last-wins by ``seq``, so arrival order never changes the
    published table. Each version keeps its progress (last offset per partition). Batches of the log that a version holds are deleted.

    With ``processing_time`` a heartbeat of one empty row a second is united with the messages, so pending changes are published in time
    while the topic is idle. ``base_state``: the first full version (``G.edge_state`` columns), ``base_progress``: its messages."""
    import time

    spark = messages.sparkSession
    state = {"last": time.monotonic()}
    if not S.edge_versions(spark, snapshot_base):
        if base_progress is not None:
            S.write_progress(base_progress, snapshot_base, 0)
        S.write_edge_full(base_state, snapshot_base, 0)
    if processing_time:
        messages = messages.unionByName(heartbeat(spark, messages))

    def sink(df: DataFrame, batch_id: int):
        rows = edge_updates(df)
        if not rows.isEmpty():
            rows.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")
        current = S.edge_versions(spark, snapshot_base)[-1][0]
        pending_rows = _log_rows(spark, log_path, current, batch_id)
        pending = 0 if pending_rows is None else pending_rows.count()
        if pending > min_changes or (pending > 0 and time.monotonic() - state["last"] > max_delay_s):
            _publish_log(spark, snapshot_base, log_path, pending_rows, batch_id + 1, compact_every)
            state["last"] = time.monotonic()

    return _start(messages, checkpoint, sink=sink, processing_time=processing_time)


def heartbeat(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """One row a second with the columns of ``messages``, all null: a batch comes along even when no message does."""
    beat = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return beat.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in messages.schema.fields))


def _log_rows(spark: SparkSession, log_path: str, first: int, last: int) -> DataFrame | None:
    """The change-log batches ``first`` to ``last``; None if there are none."""
    have = [b for b in S.numbered(spark, log_path, "batch=") if first <= b <= last]
    if not have:
        return None
    return spark.read.parquet(*(f"{log_path}/batch={b}" for b in have))


def _publish_log(spark: SparkSession, snapshot_base: str, log_path: str, rows: DataFrame, version: int, compact_every: int) -> None:
    S.write_progress(progress_of(rows, S.read_progress(spark, snapshot_base)), snapshot_base, version)
    _publish(spark, snapshot_base, rows, version, compact_every)
    for b in S.numbered(spark, log_path, "batch="):
        if b < version:
            S.delete(spark, f"{log_path}/batch={b}")


def _publish(spark: SparkSession, snapshot_base: str, rows: DataFrame, version: int, compact_every: int) -> None:
    S.write_edge_delta(G.edge_state(rows), snapshot_base, version)
    vs = S.edge_versions(spark, snapshot_base)
    full = max(v for v, kind in vs if kind == "full")
    if len([v for v, kind in vs if kind == "delta" and v > full]) >= compact_every:
        S.write_edge_full(S.read_edge_table(spark, snapshot_base, version), snapshot_base, version)


def flush(spark: SparkSession, snapshot_base: str, log_path: str, compact_every: int = 10) -> DataFrame:
    """Publish whatever is still pending (end of stream) and return the newest edge table."""
    current = S.edge_versions(spark, snapshot_base)[-1][0]
    last = max(S.numbered(spark, log_path, "batch="), default=-1)
    rows = _log_rows(spark, log_path, current, last)
    if rows is not None:
        _publish_log(spark, snapshot_base, log_path, rows, last + 1, compact_every)
    return S.read_edge_table(spark, snapshot_base)


# ---------------------------------------------------------------- ST4 + ST6 + K3: speed layer

def reweight_stream(messages: DataFrame, candidates_base: str, updates_base: str, emit: str | Callable[[DataFrame, int], None],
                    checkpoint: str, best: int = 3, processing_time: str | None = None, weighted_base: str | None = None,
                    compact_every: int = 10, buckets: int = 8):
    """ST4 + ST6 + ST5: per batch, put the batch's last updates into the table of last updates per edge, re-weight the candidate
    walks that hold an edge changed by it, and emit the best walks of their queries.

    Candidates are the newest batch result (see ``batch_result``). When one is taken up, an index ``(src, dst) -> query, walk`` is
    written beside its re-weighted walks (``weighted_base/c=<result>/index`` and ``/lines``, default ``<candidates_base>-weighted``), with all updates that its
    progress does not hold; later batches look the changed edges up there and write the walks that hold them as a delta
    (``weighted_paths`` merges). Nothing else is rewritten: work follows the change, not the candidates. A walk is always re-weighted from the batch result with
    the whole table of updates, so the outcome does not depend on the order in which messages arrive, and a retried batch writes
    the same versions again. ``emit``: a folder (``batch=<id>`` each), or a function ``(rows, batch_id)``, e.g.
    ``streams.message_sink``; ``buckets``: folders per full version, for a few hundred MB each; a batch emits the queries that it touched (``newest_emitted`` reads the state of all)."""
    spark = messages.sparkSession
    out_base = weighted_base or f"{candidates_base.rstrip('/')}-weighted"
    updates = KeyedTable(spark, updates_base, ["src", "dst"], ["src", "dst"], buckets, compact_every, order="seq")

    def sink(df: DataFrame, batch_id: int):
        version = batch_id + 1
        places = updates.change(U.last_places(edge_updates(df)), version)
        result = batch_result(spark, candidates_base)
        if result is None:
            return
        name, candidates, progress = result
        index, lines = _walk_tables(spark, out_base, name, compact_every, buckets)
        live = updates.read(version)
        live = live if progress is None else not_covered(live, progress)
        if not lines.versions(batch_id):
            walks = candidates.select("query_id", "line")
            index.write(U.hops(walks).select("src", "dst", "query_id", F.col("line").alias("old_line")), 0)
            lines.write(U.reweight(walks, live), version)
            for c in S.numbered(spark, out_base, "c="):
                if c < name and c not in S.numbered(spark, out_base, "c=")[-2:]:
                    S.delete(spark, f"{out_base}/c={c}")
            now = lines.read(version)
        else:
            hit = index.read(0, places).join(updates.delta(version).select("src", "dst"), ["src", "dst"], "left_semi") \
                .select("query_id", F.col("old_line").alias("line")).distinct()
            queries = lines.change(U.reweight(hit, live), version)
            if not queries:
                return
            now = lines.read(version, queries).join(lines.delta(version).select("query_id").distinct(), "query_id", "left_semi")
        top = emit_rows(U.best_k(now.select("query_id", "total", "line"), best))
        if callable(emit):
            emit(top, batch_id)
        else:
            top.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{emit}/batch={batch_id}")

    return _start(messages, checkpoint, sink=sink, processing_time=processing_time)


def _walk_tables(spark: SparkSession, base: str, name: int, compact_every: int = 10, buckets: int = 8) -> tuple[KeyedTable, KeyedTable]:
    index = KeyedTable(spark, f"{base}/c={name}/index", ["src", "dst", "query_id", "old_line"], ["src", "dst"], buckets)
    lines = KeyedTable(spark, f"{base}/c={name}/lines", ["query_id", "old_line"], ["query_id"], buckets, compact_every)
    return index, lines


def weighted_paths(spark: SparkSession, weighted_base: str) -> DataFrame:
    """All candidate walks as the speed layer has them: ``(query_id, total, line)`` of the newest batch result taken up."""
    for c in reversed(S.numbered(spark, weighted_base, "c=")):
        _, lines = _walk_tables(spark, weighted_base, c)
        if lines.versions():
            return lines.read().select("query_id", "total", "line")
    raise FileNotFoundError(f"no walks under {weighted_base}")


def batch_result(spark: SparkSession, base: str) -> tuple[int, DataFrame, DataFrame | None] | None:
    """``(name, candidates, progress)`` of the newest batch result: of ``recompute_stream`` (one state per batch, see
    ``current_results``) or a plain version folder ``v=N`` with ``query_id, total, line``, its progress in ``<base>-progress/v=N``."""
    base = base.rstrip("/")
    states = S.versions(spark, f"{base}-status")
    have = states or S.versions(spark, base)
    if not have:
        return None
    name = have[-1]
    rows = current_results(spark, base) if states else spark.read.parquet(f"{base}/v={name}")
    known = name in S.versions(spark, f"{base}-progress")
    return name, rows, spark.read.parquet(f"{base}-progress/v={name}") if known else None


def newest_emitted(spark: SparkSession, emit_path: str) -> DataFrame:
    """Of each query the rows of the newest batch that emitted it."""
    e = spark.read.parquet(emit_path)
    last = e.groupBy("query_id").agg(F.max("batch").alias("batch"))
    return e.join(last, ["query_id", "batch"], "left_semi")


def emit_rows(top: DataFrame) -> DataFrame:
    """K3: best-walk messages ``(query_id, rank, total, key, value)``; key = value = the line."""
    return top.select("query_id", "rank", "total", F.col("line").alias("key"), F.col("line").alias("value"))


# ---------------------------------------------------------------- ST7 / ST8: latest query per user

def latest_query_stream(messages: DataFrame, sink_path: str, checkpoint: str, user_col: str = "user",
                        processing_time: str | None = None):
    """ST7: the newest query per user (update mode); older ones are superseded (ST8)."""
    agg = messages.groupBy(user_col).agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq"))

    def sink(df: DataFrame, batch_id: int):
        df.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    return _start(agg, checkpoint, sink=sink, output_mode="update", processing_time=processing_time)


def superseded_filter(status: Callable[[], DataFrame] | DataFrame) -> Callable[[int, DataFrame], DataFrame]:
    """ST8 hook for ``ksp.search(between_rounds=…)``: drop the state of queries that are no longer newest.

    ``status()`` gives ``(query_id, superseded)`` and is called anew between rounds (a table reader lists its files again),
    so a newer query arriving during the search stops the older one at the next round boundary. The filter is part of the round's job:
    rows of a stopped query are neither stored nor counted."""
    def hook(_round: int, state: DataFrame) -> DataFrame:
        now = status() if callable(status) else status
        return state.join(now.filter("superseded").select("query_id"), "query_id", "left_anti")
    return hook


# ---------------------------------------------------------------- ST9: recompute on a new snapshot

def query_registry(spark: SparkSession, base: str) -> KeyedTable:
    """The path queries to keep answered: ``(query_id, starts, ends, active)``, newest entry per query."""
    return KeyedTable(spark, base, ["query_id"], ["query_id"], buckets=1)


def register_queries(spark: SparkSession, base: str, queries: DataFrame, active: bool = True) -> int:
    """Add (or with ``active=False`` retire) queries; returns the registry's new version."""
    table = query_registry(spark, base)
    version = max((v for v, _ in table.versions()), default=-1) + 1
    table.change(queries.select("query_id", "starts", "ends").withColumn("active", F.lit(active)), version)
    return version


def active_queries(spark: SparkSession, base: str) -> DataFrame:
    return query_registry(spark, base).read().filter("active").drop("active")


def recompute_stream(version_events: DataFrame, snapshot_base: str, queries: DataFrame | Callable[[], DataFrame], results_base: str,
                     checkpoint: str, config: ksp.SearchConfig | None = None,
                     processing_time: str | None = None):
    """ST9: for each batch of "snapshot published" events, answer the active queries on the newest version.

    ``queries``: a table, or a function that is asked anew in each batch (``lambda: active_queries(spark, base)``), so queries may be added and
    retired while the stream runs. Only queries are searched that are new, changed, or that a change of the graph can reach: the
    nodes of a query's kept search state are stored, and an edge whose weight differs between the two snapshots
    touches a query when its source is among the start side's nodes, its target among the end side's, or one of them is a
    requested id. An untouched query keeps its earlier result, which the new snapshot gives as well.

    Batch ``b`` writes ``<results_base>/v=b+1`` (results of the queries searched), ``-reach`` (their nodes), ``-progress`` (the messages that
    the snapshot holds) and last ``-status`` (every active query and the version of its result); ``current_results`` reads them."""
    spark = version_events.sparkSession
    base = results_base.rstrip("/")

    def sink(df: DataFrame, batch_id: int):
        newest = df.agg(F.max("version")).first()[0]
        if newest is None:
            return
        version = batch_id + 1
        asked = (queries() if callable(queries) else queries).select("query_id", "starts", "ends").dropDuplicates(["query_id"])
        earlier = [v for v in S.versions(spark, f"{base}-status") if v < version]
        redo, kept = asked, None
        if earlier:
            before = spark.read.parquet(f"{base}-status/v={earlier[-1]}")
            same = before.join(asked, ["query_id", "starts", "ends"], "left_semi")
            touched = _touched_queries(spark, snapshot_base, base, same, newest)
            if touched is not None:
                kept = same.join(touched, "query_id", "left_anti").select("query_id", "starts", "ends", "computed")
                redo = asked.join(kept.select("query_id"), "query_id", "left_anti")
        snap = S.read_edge_table(spark, snapshot_base, newest)
        run = ksp.search(snap.select("src", "dst", "weight"), redo, config) if not redo.isEmpty() else None
        if run is not None:
            ksp.results(run.state).write.mode("overwrite").parquet(f"{base}/v={version}")
            run.state.select("query_id", "side", "node").distinct().write.mode("overwrite").parquet(f"{base}-reach/v={version}")
        progress = S.read_progress(spark, snapshot_base, newest)
        if progress is not None:
            progress.write.mode("overwrite").parquet(f"{base}-progress/v={version}")
        done = redo.withColumn("computed", F.lit(version))
        done = done if kept is None else done.unionByName(kept)
        done.withColumn("snapshot", F.lit(newest)).write.mode("overwrite").parquet(f"{base}-status/v={version}")

    return _start(version_events, checkpoint, sink=sink, processing_time=processing_time)


def _touched_queries(spark: SparkSession, snapshot_base: str, base: str, status: DataFrame, newest: int) -> DataFrame | None:
    """``query_id`` of the queries of ``status`` that the changes up to snapshot ``newest`` can reach; None if that cannot be told."""
    since = status.agg(F.max("snapshot")).first()[0]
    changed = None if since is None else S.edges_changed(spark, snapshot_base, since, newest)
    if changed is None:
        return None
    ends = changed.select(F.lit(ksp.START).alias("side"), F.col("src").alias("node")).unionByName(
        changed.select(F.lit(ksp.END).alias("side"), F.col("dst").alias("node"))).distinct()
    both = changed.select(F.col("src").alias("node")).unionByName(changed.select(F.col("dst").alias("node"))).distinct()
    requested = status.select("query_id", F.explode(F.array_union("starts", "ends")).alias("node")).join(both, "node", "left_semi")
    computed = [r[0] for r in status.select("computed").distinct().collect()]  # at most one per version kept
    reach = spark.read.option("basePath", f"{base}-reach").parquet(*(f"{base}-reach/v={v}" for v in computed))
    held = reach.join(status.select("query_id", F.col("computed").alias("v")), ["query_id", "v"], "left_semi")
    return held.join(ends, ["side", "node"], "left_semi").select("query_id").unionByName(requested.select("query_id")).distinct()


def current_results(spark: SparkSession, results_base: str) -> DataFrame:
    """The results of the active queries as ``recompute_stream`` left them: ``(query_id, total, hops, line)``."""
    base = results_base.rstrip("/")
    status = spark.read.parquet(S.latest_path(spark, f"{base}-status"))
    computed = [r[0] for r in status.select("computed").distinct().collect()]
    have = [v for v in S.versions(spark, base) if v in computed]
    if not have:
        return status.select("query_id", *(F.lit(None).cast(t).alias(c) for c, t in
                                           (("total", "bigint"), ("hops", "bigint"), ("line", "string")))).limit(0)
    rows = spark.read.option("basePath", base).parquet(*(f"{base}/v={v}" for v in have))
    return rows.join(status.select("query_id", F.col("computed").alias("v")), ["query_id", "v"], "left_semi") \
        .select("query_id", "total", "hops", "line")


# ---------------------------------------------------------------- S7 + ST7 + G4 + K2: batch layer as a stream

def path_query_stream(messages: DataFrame, graph_source: Callable[[], tuple[object, DataFrame]],
                      results_base: str, checkpoint: str, config: ksp.SearchConfig | None = None,
                      client_col: str | None = "client", processing_time: str | None = None,
                      status: Callable[[], DataFrame] | None = None, reject_unknown: bool = False):
    """Per micro-batch of path-query messages ``(seq, client, value)``: keep the newest query per client
    (ST7), parse it (P4), run all of them in one search loop on the newest edge table (G4) and publish the
    results as ``results_base/v=<batch id>`` (K2; ``query_id`` = the message ``seq``).

    ``graph_source()`` returns ``(version, edges)``; the adjacency is prepared once per version and reused by
    every batch until the version changes. ``client_col=None``: one client for all messages (as a Kafka topic has no client
    column). ``status``: see ``superseded_filter``; it stops searches that a newer query replaced. ``reject_unknown``:
    a query with an id outside the graph gets no answer for a smaller question; its ids go to
    ``<results_base>-rejected/v=<batch id>`` (F2)."""
    held: dict = {"version": None, "graph": None}

    def sink(df: DataFrame, batch_id: int):
        version, edges = graph_source()
        if held["graph"] is None or version != held["version"]:
            if held["graph"] is not None:
                held["graph"].release()
            held.update(version=version, graph=ksp.prepare(edges, config=config))
        newest = (df.groupBy(*([client_col] if client_col else [])).agg(F.max("seq").alias("query_id"),
                                                                        F.max_by("value", "seq").alias("value"))
                  .filter("query_id IS NOT NULL").select("query_id", parse_query("value").alias("q"))
                  .select("query_id", "q.starts", "q.ends"))
        if reject_unknown:
            unknown = ksp.unknown_ids(newest, edges)
            unknown.write.mode("overwrite").parquet(f"{results_base.rstrip('/')}-rejected/v={batch_id}")
            bad = df.sparkSession.read.parquet(f"{results_base.rstrip('/')}-rejected/v={batch_id}")
            newest = newest.join(bad.select("query_id").distinct(), "query_id", "left_anti")
        res = ksp.results(ksp.search(edges, newest, config, prepared=held["graph"],
                                     between_rounds=superseded_filter(status) if status else None).state)
        res.write.mode("overwrite").parquet(f"{results_base}/v={batch_id}")

    return _start(messages, checkpoint, sink=sink, processing_time=processing_time)


def newest_results(spark: SparkSession, results_base: str, latest_seq_by_client: DataFrame) -> DataFrame:
    """The published results of each client's newest query (across all result versions)."""
    res = spark.read.parquet(results_base)
    return res.join(latest_seq_by_client.select(F.col("seq").alias("query_id")), "query_id", "left_semi") \
        .select("query_id", "total", "hops", "line")
