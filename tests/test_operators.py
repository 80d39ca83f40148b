"""Order operators against brute force (with a forced hot group), codecs, documents and snapshots."""

import random

from pyspark.sql import functions as F

from pathlattice.functions.messages import (decode_hops, encode_line, format_edge, format_query, parse_edges,
                                            parse_query)
from pathlattice.operators import graph as G
from pathlattice.operators.sequence import next_in_group, rank_in_group
from pathlattice.sources import snapshot as S
from pathlattice.sources import trips as TR


def _rows(n=600, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = 0 if i % 3 == 0 else rnd.randint(1, 20)  # group 0 holds a third of all rows
        out.append((g, rnd.randint(0, 50), i, rnd.randint(0, 999)))
    return out


def test_next_in_group_hot_group_matches_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "g int, o int, tie int, v int")
    got = {(r.g, r.tie): r.nxt for r in
           next_in_group(df, ["g"], ["o", "tie"], "v", "nxt", num_blocks=7, hot_rows=50).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        grp = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        for a, b in zip(grp, grp[1:] + [None]):
            want[(g, a[2])] = None if b is None else b[3]
    assert got == want


def test_rank_in_group_hot_group_matches_brute_force(spark):
    rows = _rows(seed=11)
    df = spark.createDataFrame(rows, "g int, o int, tie int, v int")
    got = {(r.g, r.tie): r.rk for r in rank_in_group(df, ["g"], ["o", "tie"], "rk", num_blocks=5, hot_rows=40).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        grp = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(grp):
            want[(g, r[2])] = i + 1
    assert got == want


def test_edge_message_roundtrip_and_quarantine(spark):
    df = spark.createDataFrame([(1, 75, 850, 66, -122.4002, 37.755, -122.392740827108, 37.7787416115368)],
                               "seq bigint, src bigint, weight bigint, dst bigint, src_lon double, src_lat double, "
                               "dst_lon double, dst_lat double")
    msg = df.select("seq", format_edge().alias("value"))
    assert msg.first().value == "75 850 66 -122.4002 37.755 -122.392740827108 37.7787416115368"
    bad = spark.createDataFrame([(2, "75 850 66 -122.4 37.7 -122.3"), (3, "a 1 2 3 4 5 6"), (4, "  1  2  3 4 5 6 7 ")],
                                "seq bigint, value string")
    p = {r.seq: r for r in parse_edges(msg.unionByName(bad)).collect()}
    assert p[1].valid and p[1].dst_lat == 37.7787416115368
    assert not p[2].valid and not p[3].valid
    assert p[4].valid and p[4].weight == 2


def test_query_message_roundtrip(spark):
    df = spark.createDataFrame([([1, 2], [10])], "starts array<bigint>, ends array<bigint>")
    v = df.select(format_query("starts", "ends").alias("v")).first().v
    assert v == "1 2\n10"
    q = spark.createDataFrame([(v,), ("3 3  4\n",)], "v string").select(parse_query("v").alias("q")).collect()
    assert list(q[0].q.starts) == [1, 2] and list(q[0].q.ends) == [10]
    assert list(q[1].q.starts) == [3, 4] and list(q[1].q.ends) == []


def test_result_line_codec(spark):
    df = spark.createDataFrame([("2360 120 1284 285 100 106 976 80",), ("0 75",)], "line string")
    r = df.select("line", decode_hops("line").alias("h")).collect()
    assert [(h.src, h.weight, h.dst) for h in r[0].h] == [(120, 1284, 285), (285, 100, 106), (106, 976, 80)]
    assert list(r[1].h) == []
    enc = df.select(encode_line(F.lit(2360), F.lit(120), decode_hops("line")).alias("e")).first().e
    assert enc == "2360 120 1284 285 100 106 976 80"


def _trips(spark):
    rows = [(1, 10, 20, 5, 1.0, 2.0, 3.0, 4.0), (2, 10, 30, 6, 1.5, 2.5, 5.0, 6.0), (3, 20, 10, 7, 3.0, 4.0, 1.0, 2.0),
            (4, 10, 20, 8, 1.0, 2.0, 3.0, 4.0), (5, 30, 40, 1, 5.0, 6.0, 7.0, 8.0)]
    return spark.createDataFrame(rows, "trip_id bigint, src bigint, dst bigint, weight bigint, src_lat double, "
                                       "src_lon double, dst_lat double, dst_lon double")


def test_documents_chunked_roundtrip(spark, tmp_path):
    t = _trips(spark)
    docs = G.node_documents(G.station_nodes(t), G.adjacency_out(t), G.adjacency_in(t), chunk=2)
    by_key = {}
    for r in docs.collect():
        by_key.setdefault(r.key, []).append(r)
    assert len(by_key["10"]) == 2  # three out-entries in chunks of two
    assert [r.part for r in by_key["40"]] == [0]
    base = str(tmp_path / "snap")
    S.write_snapshot(docs, base, 3)
    back = S.read_snapshot(spark, S.latest_path(spark, base))
    flat = sorted(tuple(r) for r in G.flatten_documents(back, chunk=2).collect())
    assert flat == sorted(tuple(r) for r in G.flatten_documents(docs, chunk=2).collect())
    outs = [r for r in flat if r[0] == "10" and r[3] == "out"]
    assert [(r[4], r[5], r[8]) for r in sorted(outs, key=lambda r: r[4])] == [(0, "20", 5), (1, "30", 6), (2, "20", 8)]
    # one layout at every size, and an export with one line per node
    line = [x for x in open(next(p for p in (tmp_path / "snap" / "v=3").iterdir() if p.name.startswith("part-"))).read().splitlines() if x]
    assert all('"part"' in x for x in line)
    whole = {r.key: r.val for r in G.one_line_documents(back).collect()}
    assert set(whole) == set(by_key) and [n.id for n in whole["10"].neighbors_out] == ["20", "30", "20"]
    flat_edges = G.edge_flatten(back, chunk=2).filter("src = '10'").orderBy("pos").collect()
    assert [(r.pos, r.dst, r.weight) for r in flat_edges] == [(0, "20", 5), (1, "30", 6), (2, "20", 8)]
    out, into = G.adjacency_out(t), G.adjacency_in(t)
    lists = [spark.createDataFrame(a.collect(), a.schema) for a in (out, into)]
    plan = G.node_documents(G.station_nodes(t), *lists)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # no window over neighbor arrays


def test_parallel_edges_of_a_snapshot_keep_the_last_entry(spark):
    """10→20 with 9 then 4, 20→30 with 1: one walk, on the last entry."""
    from pathlattice.plans import ksp

    trips = spark.createDataFrame([(1, 10, 20, 9, 0., 0., 0., 0.), (2, 10, 20, 4, 0., 0., 0., 0.), (3, 20, 30, 1, 0., 0., 0., 0.)],
                                  "trip_id bigint, src bigint, dst bigint, weight bigint, src_lat double, src_lon double, "
                                  "dst_lat double, dst_lon double")
    docs = G.node_documents(G.station_nodes(trips), G.adjacency_out(trips), G.adjacency_in(trips), chunk=1)
    edges = G.collapse_edges(G.edge_flatten(docs, chunk=1), "last", "pos").selectExpr(
        "cast(src as bigint) src", "cast(dst as bigint) dst", "weight")
    got = ksp.k_shortest_paths(edges, ksp.query_table(spark, [(1, [10], [30])]), ksp.SearchConfig(steps=3, k=3)).collect()
    assert [r.line for r in got] == ["5 10 4 20 1 30"]


def test_reductions_hash_and_merge_once(spark):
    rows = spark.createDataFrame([(1, 1, 2, 5, 0., 1., 2., 3.)], "seq bigint, src bigint, dst bigint, weight bigint, "
                                 "src_lon double, src_lat double, dst_lon double, dst_lat double").repartition(2)
    trips = rows.withColumnRenamed("seq", "trip_id")
    for df, levels in ((G.edge_upsert(G.edge_state(rows), rows), 4), (G.node_upsert(G.node_state(rows), rows), 4), (G.station_nodes(trips), 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and plan.count("HashAggregate(") <= 2 * levels


def test_stream_wait_never_returns_with_a_partial_sink(spark, tmp_path):
    import pytest

    from pathlattice.streaming import jobs as J

    spark.range(400).selectExpr("id AS seq", "concat('1 ', id, ' 2 0.0 0.0 0.0 0.0') AS value").repartition(40).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("seq bigint, value string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with pytest.raises(TimeoutError):
        J.run(J.collect_edges(stream, str(tmp_path / "out"), str(tmp_path / "ck")), timeout_s=0.2)
    J.run(J.collect_edges(stream, str(tmp_path / "all"), str(tmp_path / "ck2")))
    assert spark.read.parquet(str(tmp_path / "all")).select("seq").distinct().count() == 400


def test_negative_weights_are_invalid_everywhere(spark):
    from pathlattice.functions.messages import parse_edges

    df = spark.createDataFrame([(1, "1 -5 2 0.0 0.0 0.0 0.0"), (2, "1 5 2 0.0 0.0 0.0 0.0"), (3, None)], "seq bigint, value string")
    assert {r.seq: r.valid for r in parse_edges(df).collect()} == {1: False, 2: True, 3: False}


def test_message_order_is_time_then_partition_then_offset(spark):
    from pathlattice.sources import streams as ST

    rows = [("result", 1, 5, "old", 10), ("result", 0, 1000, "new", 20), ("result", 0, 1001, "newest", 20), ("new_edges", 3, 1, "e", 5)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string, ms bigint").selectExpr(
        "*", "timestamp_millis(ms) AS timestamp")
    edges, last = ST.demux(df)
    assert [r.value for r in edges.collect()] == ["e"] and [r.value for r in last.collect()] == ["newest"]
    order = [r.value for r in df.orderBy(ST.message_order()).collect()]
    assert order == ["e", "old", "new", "newest"]


def test_messages_are_keyed_by_edge_and_written_by_format(spark, tmp_path):
    from pathlattice.functions.messages import edge_message_rows
    from pathlattice.sources import streams as ST

    df = spark.createDataFrame([(1, 7, 2, 0., 1., 2., 3.)], "src bigint, weight bigint, dst bigint, src_lon double, src_lat double, "
                               "dst_lon double, dst_lat double")
    edge_message_rows(df).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("key string, value string").json(str(tmp_path / "in"))
    ST.write_messages(stream, "json", str(tmp_path / "ck"), path=str(tmp_path / "out")).awaitTermination()
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "out")).select("key", "value").collect()] == [("1-2", "1 7 2 0.0 1.0 2.0 3.0")]


def test_empty_and_pathless_results(spark, tmp_path):
    from pathlattice.sources import results as R

    res = spark.createDataFrame([(1, 5, 1, "5 1 5 2")], "query_id bigint, total bigint, hops bigint, line string")
    asked = spark.createDataFrame([(1,), (2,)], "query_id bigint")
    R.write_results_text(res, str(tmp_path / "r"), asked)
    assert [tuple(r) for r in R.read_results_text(spark, str(tmp_path / "r")).collect()] == [(1, 5, "5 1 5 2")]
    assert dict(R.read_status(spark, str(tmp_path / "r")).collect()) == {1: 1, 2: 0}
    R.write_results_text(res.limit(0), str(tmp_path / "e"))
    assert R.read_results_text(spark, str(tmp_path / "e")).collect() == [] == R.read_status(spark, str(tmp_path / "e")).collect()


def test_a_new_batch_result_is_taken_up_mid_stream(spark, tmp_path):
    from pathlattice.streaming import jobs as J

    def publish(v, rows):
        spark.createDataFrame([(0, rows[0][3])], "partition int, offset bigint").write.parquet(str(tmp_path / f"c-progress/v={v}"))
        spark.createDataFrame([r[:3] for r in rows], "query_id bigint, total bigint, line string").write.parquet(str(tmp_path / f"c/v={v}"))

    def message(seq, text):
        spark.createDataFrame([(seq, text)], "seq bigint, value string").write.mode("append").parquet(str(tmp_path / "in"))

    def drain():
        stream = spark.readStream.schema("seq bigint, value string").parquet(str(tmp_path / "in"))
        J.run(J.reweight_stream(stream, str(tmp_path / "c"), str(tmp_path / "u"), str(tmp_path / "emit"), str(tmp_path / "ck")))
        return {(r.query_id, r.value) for r in J.newest_emitted(spark, str(tmp_path / "emit")).collect()}

    publish(1, [(1, 5, "5 1 5 2", 0)])
    message(1, "1 9 2 0.0 0.0 0.0 0.0")
    assert drain() == {(1, "9 1 9 2")}
    publish(2, [(1, 12, "12 1 9 2 3 4", 1), (7, 3, "3 2 3 4", 1)])  # knows the update of seq 1
    message(2, "2 8 4 0.0 0.0 0.0 0.0")
    assert drain() == {(1, "17 1 9 2 8 4"), (7, "8 2 8 4")}


def test_tolerant_read_keeps_last_and_quarantines(spark, tmp_path):
    p = tmp_path / "dirty"
    p.mkdir()
    (p / "part-0.json").write_text(
        '{"key":"1","val":{"lat":1.0,"lon":2.0,"neighbors_in":[],"neighbors_out":[]}}\n'
        '{"key":"1","val":{"lat":9.0,"lon":2.0,"neighbors_in":[],"neighbors_out":[]}}\n'
        '{"key":"2","val":{"lat":\n')
    good, bad = S.read_snapshot_tolerant(spark, str(p))
    assert [(r.key, r.val.lat) for r in good.collect()] == [("1", 9.0)]
    assert bad.count() == 1


def test_seed_map_load(spark, seed_map_path):
    docs = S.load_seed_map(spark, seed_map_path)
    assert docs.count() == 10
    assert G.edge_flatten(docs).count() == 13


def test_trip_csv_quarantine_and_row_cap(spark, tmp_path):
    p = tmp_path / "trips.csv"
    p.write_text("extra,trip_id,duration_sec,start_station_id,start_station_latitude,start_station_longitude,"
                 "end_station_id,end_station_latitude,end_station_longitude\n"
                 "x,1,100,5,1.0,2.0,6,3.0,4.0\n"
                 "x,2,oops,5,1.0,2.0,6,3.0,4.0\n"
                 "x,3,50,6,3.0,4.0,5,1.0,2.0\n")
    raw = TR.normalize_trips(TR.read_trips_raw(spark, str(p), "trip_id"), "trip_id")
    assert TR.quarantine(raw).count() == 1
    t = TR.read_trips(spark, str(p), "trip_id")
    assert [r.trip_id for r in TR.row_cap(t, 1).collect()] == [1]
    assert TR.row_cap(t, -1).count() == 2


def test_seven_column_trip_file_keeps_its_line_order(spark, tmp_path):
    head = ("duration_sec,start_station_id,start_station_latitude,start_station_longitude,end_station_id,"
            "end_station_latitude,end_station_longitude\n")
    (tmp_path / "a.csv").write_text(head + "100,5.0,1.0,2.0,6,3.0,4.0\n-7,5,1.0,2.0,6,3.0,4.0\n,5,1.0,2.0,6,3.0,4.0\n"
                                    "9,5.5,1.0,2.0,6,3.0,4.0\n50,6.0,3.0,4.0,5,1.0,2.0\n")
    (tmp_path / "b.csv").write_text(head + "70,7,1.0,2.0,6,3.0,4.0\n")
    raw = TR.normalize_trips(TR.read_trips_raw(spark, str(tmp_path)))
    assert TR.quarantine(raw).count() == 3
    t = TR.read_trips(spark, str(tmp_path))
    assert [(r.src, r.weight) for r in t.orderBy("trip_id").collect()] == [(5, 100), (6, 50), (7, 70)]
    assert [(r.src, r.weight) for r in TR.row_cap(t, 2).collect()] == [(5, 100), (6, 50)]
    assert [(r.id, r.pos, r.weight) for r in G.adjacency_out(t).orderBy("id").collect()] == [(5, 0, 100), (6, 0, 50), (7, 0, 70)]


def test_edge_upsert_semantics(spark):
    base = spark.createDataFrame([(1, 1, 2, 10, 0.0, 0.0, 1.0, 1.0)],
                                 "seq bigint, src bigint, dst bigint, weight bigint, src_lon double, src_lat double, "
                                 "dst_lon double, dst_lat double")
    ups = spark.createDataFrame([(5, 1, 2, 7, 9.0, 9.0, 9.0, 9.0), (3, 1, 2, 4, 8.0, 8.0, 8.0, 8.0),
                                 (4, 2, 3, 1, 1.0, 1.0, 2.0, 2.0)], base.schema)
    out = {(r.src, r.dst): r for r in G.edge_upsert(G.edge_state(base), ups).collect()}
    assert out[(1, 2)].weight == 7 and out[(1, 2)].src_lon == 0.0  # last weight, first coordinates
    assert out[(2, 3)].weight == 1
    nodes = {r.id: r for r in G.node_upsert(G.node_state(base), ups).collect()}
    assert nodes[1].lon == 0.0 and nodes[3].lon == 2.0


def test_large_row_cap_is_exact(spark, monkeypatch):
    monkeypatch.setattr(TR, "TAKE_ORDERED_MAX", 3)
    t = spark.createDataFrame([(i, 1, 2, 1, 0.0, 0.0, 0.0, 0.0) for i in range(200, 0, -1)],
                              "trip_id bigint, src bigint, dst bigint, weight bigint, src_lat double, src_lon double, "
                              "dst_lat double, dst_lon double")
    from pathlattice.operators import sequence
    monkeypatch.setattr(sequence, "HOT_ROWS", 50)
    got = sorted(r.trip_id for r in TR.row_cap(t, 120).collect())
    assert got == list(range(1, 121))


def test_edge_versions_full_plus_deltas(spark, tmp_path):
    from pathlattice.streaming.jobs import _publish
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 5), rnd.randint(0, 5), rnd.randint(1, 9), float(i), 0.0, 0.0, 0.0) for i in range(120)]
    df = spark.createDataFrame(rows, "seq bigint, src bigint, dst bigint, weight bigint, src_lon double, "
                                     "src_lat double, dst_lon double, dst_lat double")
    base = str(tmp_path / "edges")
    S.write_edge_full(G.edge_state(df.filter("seq < 30")), base, 0)
    for v, (lo, hi) in enumerate([(60, 90), (30, 60), (90, 120)], start=1):  # out of seq order on purpose
        _publish(spark, base, df.filter(f"seq >= {lo} AND seq < {hi}"), v, compact_every=2)
    kinds = S.edge_versions(spark, base)
    assert (2, "full") in kinds and (3, "delta") in kinds
    got = sorted(tuple(r) for r in S.read_edge_table(spark, base).collect())
    want = sorted(tuple(r) for r in G.edge_state(df).select(*S.read_edge_table(spark, base).columns).collect())
    assert got == want
