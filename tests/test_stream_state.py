"""The order key, progress per partition, incremental re-weighting, idle publishing, the query registry and preemption."""

import time

import pytest
from pyspark.sql import functions as F
from seed_graph import EXTRA_UPDATES, SEED_EDGES, SEED_NODES

from pathlattice.operators import graph as G
from pathlattice.operators import updates as U
from pathlattice.plans import ksp
from pathlattice.sources import results as R
from pathlattice.sources import snapshot as S
from pathlattice.sources import streams as ST
from pathlattice.sources.keyed import KeyedTable
from pathlattice.streaming import jobs as J

KAFKA = "timestamp timestamp, partition int, offset bigint, value string"
KAFKA_MESSAGE = "seq decimal(38,0), partition int, offset bigint, value string"


def kafka(spark, rows):
    """Rows (time in ms, partition, offset, value) as Kafka delivers them, turned into messages."""
    df = spark.createDataFrame(rows, "ms bigint, partition int, offset bigint, value string")
    return ST.kafka_messages(df.withColumn("timestamp", F.timestamp_millis("ms")))


def now(k):
    return 1_760_000_000_000 + k


def edge_text(s, w, d):
    return f"{s} {w} {d} {SEED_NODES[s][1]} {SEED_NODES[s][0]} {SEED_NODES[d][1]} {SEED_NODES[d][0]}"


def seed_messages():
    return [(now(i), i % 3, 100 + i, edge_text(s, w, d)) for i, (s, d, w) in enumerate(SEED_EDGES)]


def feed(spark, df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, files=100):
    return spark.readStream.schema(KAFKA_MESSAGE).option("maxFilesPerTrigger", files).parquet(path)


def test_kafka_order_goes_through_every_consumer(spark, tmp_path):
    """36-digit order keys through edge and node state, upserts, publishing, recompute, the query stream, text results, re-weighting."""
    messages = kafka(spark, seed_messages())
    assert messages.schema["seq"].dataType.simpleString() == "decimal(38,0)"
    edges = J.edge_updates(messages)
    state, nodes = G.edge_state(edges), G.node_state(edges)
    assert state.count() == len(SEED_EDGES) and nodes.count() == len(SEED_NODES)
    late = J.edge_updates(kafka(spark, [(now(50), 1, 200, EXTRA_UPDATES[1])]))
    assert G.node_upsert(nodes, late).count() == len(SEED_NODES) + 1
    assert G.edge_upsert(state, late).count() == len(SEED_EDGES) + 1
    first = messages.agg(F.min("seq")).first()[0]
    assert G.pending_changes(edges, first).first().pending == len(SEED_EDGES) - 1

    src, base = str(tmp_path / "in"), str(tmp_path / "edges")
    feed(spark, messages, src)
    J.run(J.edge_upsert_stream(stream(spark, src), base, str(tmp_path / "ck1")))
    feed(spark, kafka(spark, [(now(60), 2, 300, edge_text("120", 7, "41"))]), src)
    J.run(J.edge_upsert_stream(stream(spark, src), base, str(tmp_path / "ck1")))
    table = {(r.src, r.dst): r.weight for r in S.read_edge_table(spark, base).collect()}
    assert table[120, 41] == 7 and len(table) == len(SEED_EDGES)
    assert dict(S.read_progress(spark, base).collect()) == {0: 112, 1: 110, 2: 300}

    queries = kafka(spark, [(now(70), 0, 5, "120\n80"), (now(80), 0, 6, "75\n36")])
    qsrc, out = str(tmp_path / "q"), str(tmp_path / "results")
    feed(spark, queries.withColumn("client", F.col("offset").cast("string")), qsrc)
    qs = spark.readStream.schema(KAFKA_MESSAGE + ", client string").parquet(qsrc)
    J.run(J.path_query_stream(qs, lambda: (1, J.current_edges(spark, base)), out, str(tmp_path / "ck2")))
    found = spark.read.parquet(f"{out}/v=0")
    ids = sorted(r.seq for r in queries.collect())
    assert {r.query_id for r in found.collect()} == set(ids)
    R.write_results_text(found, str(tmp_path / "text"))
    back = R.read_results_text(spark, str(tmp_path / "text"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, found.select("query_id", "total", "line").collect()))

    events = str(tmp_path / "events")
    spark.createDataFrame([(S.edge_versions(spark, base)[-1][0],)], "version bigint").write.parquet(events)
    asked = queries.select(F.col("seq").alias("query_id"), F.split("value", "\n").alias("p")).select(
        "query_id", F.array(F.col("p")[0].cast("bigint")).alias("starts"), F.array(F.col("p")[1].cast("bigint")).alias("ends"))
    again = str(tmp_path / "again")
    J.run(J.recompute_stream(spark.readStream.schema("version bigint").parquet(events), base, asked, again, str(tmp_path / "ck3")))
    assert sorted(map(tuple, J.current_results(spark, again).collect())) == sorted(
        map(tuple, found.select("query_id", "total", "hops", "line").collect()))

    feed(spark, kafka(spark, [(now(90), 0, 400, edge_text("285", 1, "106"))]), str(tmp_path / "speed"))
    emit = str(tmp_path / "emit")
    J.run(J.reweight_stream(stream(spark, str(tmp_path / "speed")), again, str(tmp_path / "u"), emit, str(tmp_path / "ck4")))
    best = {(r.query_id, r.rank): r.value for r in J.newest_emitted(spark, emit).collect()}
    assert [best[ids[0], k] for k in (1, 2)] == ["1841 120 7 41 570 36 1264 80", "2261 120 1284 285 1 106 976 80"]


def test_replay_takes_what_the_snapshot_had_not_read(spark):
    """Partition 0 is slow: its update is older than what the snapshot holds of partition 1, and still must be replayed."""
    cands = spark.createDataFrame([(1, 12, "12 1 5 2 7 3"), (1, 9, "9 4 9 5")], "query_id bigint, total bigint, line string")
    log = spark.createDataFrame(
        [(10, 0, 5, 1, 2, 50), (30, 1, 9, 2, 3, 7), (5, 1, 3, 4, 5, 2), (40, 1, 8, 4, 5, 9)],
        "seq bigint, partition int, offset bigint, src bigint, dst bigint, weight bigint")
    progress = spark.createDataFrame([(0, 4), (1, 9)], "partition int, offset bigint")
    got = {r.old_line: r.line for r in U.replay(cands, log, progress).collect()}
    assert got == {"12 1 5 2 7 3": "57 1 50 2 7 3", "9 4 9 5": "9 4 9 5"}
    nothing = spark.createDataFrame([], "partition int, offset bigint")
    assert {r.line for r in U.replay(cands, log, nothing).collect()} == {"57 1 50 2 7 3", "9 4 9 5"}


def test_keyed_table_versions_buckets_and_late_rows(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["k"], buckets=4, compact_every=3, order="seq")
    assert t.read() is None

    def rows(*r):
        return spark.createDataFrame(r, "k bigint, seq bigint, x string")

    def now_at(v=None):
        return {r.k: r.x for r in t.read(v).collect()}

    t.change(rows((1, 10, "a"), (2, 20, "b")), 1)
    t.change(rows((1, 5, "late"), (3, 1, "c")), 2)
    assert now_at() == {1: "a", 2: "b", 3: "c"} and now_at(1) == {1: "a", 2: "b"}
    t.change(rows((2, 30, "new")), 3)  # compacts
    assert (3, "full") in t.versions() and now_at() == {1: "a", 2: "new", 3: "c"}
    buckets = t.change(rows((2, 1, "late"), (9, 2, "z")), 4)
    assert now_at() == {1: "a", 2: "new", 3: "c", 9: "z"}
    assert {r.k for r in t.read(4, buckets).collect()} >= {2, 9} and t.read(4, []).count() == 0
    t.change(rows((2, 40, "again")), 4)  # a retried version replaces itself
    assert now_at() == {1: "a", 2: "again", 3: "c"}
    p = KeyedTable(spark, str(tmp_path / "p"), ["k"], ["k"], buckets=4)
    p.write(rows((1, 9, "old")), 1)
    p.change(rows((1, 1, "newer version")), 2)
    assert {r.x for r in p.read().collect()} == {"newer version"}


def test_a_batch_writes_only_walks_with_a_changed_edge(spark, tmp_path):
    cands = [(q, 10 * i + 5, f"{10 * i + 5} {i} {10 * i} {i + 1} 5 {i + 2}") for q in (1, 2) for i in range(1, 40)]
    spark.createDataFrame(cands, "query_id bigint, total bigint, line string").write.parquet(str(tmp_path / "c/v=0"))
    src, out = str(tmp_path / "in"), str(tmp_path / "c-weighted")
    log, sent = [], []

    def collect(rows, batch_id):
        sent.append((batch_id, sorted((r.query_id, r["rank"], r.value) for r in rows.collect())))

    def batch(*edges):
        log.extend((s, w, d) for s, w, d in edges)
        rows = [(len(log) - len(edges) + i, f"{s} {w} {d} 0.0 0.0 0.0 0.0") for i, (s, w, d) in enumerate(edges)]
        spark.createDataFrame(rows, "seq bigint, value string").coalesce(1).write.mode("append").parquet(src)
        J.run(J.reweight_stream(ST.message_stream(spark, "parquet", src), str(tmp_path / "c"), str(tmp_path / "u"), collect,
                                str(tmp_path / "ck"), compact_every=3))
        latest = spark.createDataFrame([(i, s, d, w) for i, (s, w, d) in enumerate(log)], "seq bigint, src bigint, dst bigint, weight bigint")
        whole = U.reweight(spark.read.parquet(str(tmp_path / "c/v=0")), U.last_update_per_edge(latest))
        want = sorted(map(tuple, whole.select("query_id", "total", "line").collect()))
        assert sorted(map(tuple, J.weighted_paths(spark, out).collect())) == want
        return want

    batch((100, 1, 101))
    assert len(sent[-1][1]) == 6  # the first batch sends the best of every query
    want = batch((3, 900, 4), (7, 2, 8))
    lines = J._walk_tables(spark, out, 0)[1]
    # edges 3-4 and 7-8 are in the walks from 2, 3, 6 and 7, of two queries
    assert lines.delta(2).count() == 8 < len(cands)
    assert sent[-1] == (1, sorted((q, k, x[2]) for q in (1, 2) for k, x in enumerate([w for w in want if w[0] == q][:3], 1)))
    before = len(sent)
    batch((500, 1, 501))
    assert lines.delta(3).count() == 0 and len(sent) == before  # nothing to send
    batch((3, 1, 4))
    batch((7, 11, 8), (3, 2, 4))


def test_message_sink_key_is_the_same_in_a_second_try(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, 5, "k", "5 1 5 2"), (1, 2, 6, "k", "6 1 6 2")],
                                 "query_id bigint, rank bigint, total bigint, key string, value string")
    send = ST.message_sink("json", path=str(tmp_path / "m"))
    send(rows, 4)
    send(rows, 4)
    send(rows.limit(1), 5)
    got = spark.read.schema("key string, value string").json(str(tmp_path / "m/batch=*"))
    assert sorted(r.key for r in ST.first_delivery(got.unionByName(got)).collect()) == ["4/1/1", "4/1/2", "5/1/1"]


def test_pending_changes_are_published_while_the_topic_is_idle(spark, tmp_path):
    base = J.edge_updates(kafka(spark, seed_messages()))
    src, snap = str(tmp_path / "in"), str(tmp_path / "snap")
    feed(spark, kafka(spark, [(now(50), 0, 500, edge_text("120", 3, "41"))]), src)
    q = J.publish_stream(stream(spark, src), G.edge_state(base), snap, str(tmp_path / "log"), str(tmp_path / "ck"), max_delay_s=1.0,
                         processing_time="500 milliseconds", base_progress=ST.progress_of(base))
    try:
        end = time.monotonic() + 90
        while S.edge_versions(spark, snap)[-1][0] == 0 and time.monotonic() < end and q.exception() is None:
            time.sleep(0.5)
    finally:
        q.stop()
    assert q.exception() is None and S.edge_versions(spark, snap)[-1][0] > 0
    assert {(r.src, r.dst): r.weight for r in S.read_edge_table(spark, snap).collect()}[120, 41] == 3
    assert dict(S.read_progress(spark, snap).collect())[0] == 500


def test_only_new_and_touched_queries_are_searched(spark, tmp_path):
    snap, reg, out, events = (str(tmp_path / x) for x in ("snap", "reg", "out", "events"))
    state = G.edge_state(J.edge_updates(kafka(spark, seed_messages())))
    S.write_edge_full(state, snap, 0)

    def change(version, text):
        S.write_edge_delta(G.edge_state(J.edge_updates(kafka(spark, [(now(100 + version), 0, 1000 + version, text)]))), snap, version)

    def event(version):
        spark.createDataFrame([(version,)], "version bigint").coalesce(1).write.mode("append").parquet(events)
        J.run(J.recompute_stream(spark.readStream.schema("version bigint").parquet(events), snap, lambda: J.active_queries(spark, reg), out,
                                 str(tmp_path / "ck")))
        done = S.versions(spark, f"{out}-status")[-1]
        computed = dict(spark.read.parquet(f"{out}-status/v={done}").select("query_id", "computed").collect())
        active = J.active_queries(spark, reg)
        plain = ksp.k_shortest_paths(S.read_edge_table(spark, snap, version).select("src", "dst", "weight"), active)
        assert sorted(map(tuple, J.current_results(spark, out).collect())) == sorted(
            map(tuple, plain.select("query_id", "total", "hops", "line").collect()))
        return computed

    J.register_queries(spark, reg, ksp.query_table(spark, [(1, [120], [80]), (2, [41], [36])]))
    assert event(0) == {1: 1, 2: 1}
    change(1, edge_text("106", 1, "80"))  # 80 is no end of query 2, and 41 and 36 reach neither end
    assert event(1) == {1: 2, 2: 1}
    J.register_queries(spark, reg, ksp.query_table(spark, [(3, [75], [36])]))  # added mid-stream; no edge changes
    assert event(1) == {1: 2, 2: 1, 3: 3}
    change(2, edge_text("106", 1, "80"))  # the same weight again
    assert event(2) == {1: 2, 2: 1, 3: 3}
    J.register_queries(spark, reg, ksp.query_table(spark, [(1, [120], [80])]), active=False)
    change(3, EXTRA_UPDATES[0])  # 75 -> 66, and 66 -> 36 is there
    got = event(3)
    assert set(got) == {2, 3} and got[3] == 5


def test_a_query_replaced_during_its_search_leaves_it(spark):
    edges = spark.createDataFrame([(int(s), int(d), w) for s, d, w in SEED_EDGES], "src bigint, dst bigint, weight bigint")
    both = ksp.query_table(spark, [(1, [120], [80]), (2, [75], [80])])
    seen = []

    def status():
        seen.append(1)
        gone = [(1, True)] if len(seen) >= 2 else []
        return spark.createDataFrame(gone, "query_id bigint, superseded boolean")

    run = ksp.search(edges, both, between_rounds=J.superseded_filter(status))
    alone = ksp.search(edges, ksp.query_table(spark, [(2, [75], [80])]))
    assert sorted(map(tuple, ksp.results(run.state).collect())) == sorted(map(tuple, ksp.results(alone.state).collect()))
    # from round 2 on the counters, which decide on broadcasts, hold the rows of the other query only
    assert run.rounds[1]["state_rows"] > alone.rounds[1]["state_rows"]
    assert [r["state_rows"] for r in run.rounds[2:]] == [r["state_rows"] for r in alone.rounds[2:]]
