"""Registered queries over the test tables and their DuckDB twins.

Inputs (FIXTURES.md §2): the part graph (line items → trips, minimum weight) for the batch search, and the
event graph (events → trips with a unique ``seq``; coordinates from ``part``) for everything ordered by
change: trip CSV, documents, upserts, messages, streams, re-weighting and map layers. Trips with
``seq <= cut`` (``cut = max(event_id) * 4 div 5``) form the published snapshot, later ones are the updates.
Every query reads whole tables; the only limits are the features themselves (row cap, top-k).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice import oracle as O
from pathlattice.functions.messages import decode_nodes, encode_line, parse_query
from pathlattice.operators import graph as G
from pathlattice.operators import layers as L
from pathlattice.operators import updates as U
from pathlattice.operators.sequence import rank_in_group
from pathlattice.plans import ksp
from pathlattice.session import scratch_path
from pathlattice.sources import results as R
from pathlattice.sources import snapshot as S
from pathlattice.sources import streams as ST
from pathlattice.sources import testdata as td
from pathlattice.sources import trips as TR
from pathlattice.streaming import jobs as J

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed query parameters (FIXTURES.md §2).
PART_QUERY = [(1, [1, 2, 3], [10, 11, 12])]
PART_QUERY_WITH_UNKNOWN = [(1, [1, 2, 3, -1], [10, 11, 12, -1])]
EVENT_QUERY = [(1, [1, 2], [10, 11])]
MANY_QUERIES = [(1, [1, 2, 3], [10, 11, 12]), (2, [5], [7]), (3, [100, 200], [300, 400]), (4, [42], [42]),
                (5, [10, 11, 12], [1, 2, 3])]
STEPS, K = 5, 3
EVENT_STEPS = 3
ROW_CAP = 1000


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


W = O.with_

# ============================================================== shared oracle fragments

CUT = "cut AS (SELECT max(event_id) * 4 // 5 AS c FROM events)"
TRIP_ROWS = """trip_rows AS (
  SELECT t.seq AS trip_id, t.seq, t.src, t.dst, t.weight, a.lat AS src_lat, a.lon AS src_lon,
         b.lat AS dst_lat, b.lon AS dst_lon, t.kind, CAST(t.ts AS DATE) AS day
  FROM trips_event t LEFT JOIN coords a ON a.id = t.src LEFT JOIN coords b ON b.id = t.dst)"""
TRIPS_OK = """trips_ok AS (SELECT * FROM trip_rows WHERE src_lat IS NOT NULL AND src_lon IS NOT NULL
  AND dst_lat IS NOT NULL AND dst_lon IS NOT NULL)"""
BASE = [O.TRIPS_EVENT, O.COORDS, TRIP_ROWS, CUT]
STATIONS = """stations AS (
  SELECT id, lat, lon FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY pass, trip_id) AS rn FROM (
      SELECT src AS id, src_lat AS lat, src_lon AS lon, 0 AS pass, trip_id FROM trips_ok
      UNION ALL SELECT dst, dst_lat, dst_lon, 1, trip_id FROM trips_ok) u) r
  WHERE rn = 1)"""
ADJ_OUT = """adj_out AS (SELECT src AS id, row_number() OVER (PARTITION BY src ORDER BY trip_id) - 1 AS pos,
  dst AS nb_id, dst_lat AS nb_lat, dst_lon AS nb_lon, weight FROM trips_ok)"""
ADJ_IN = """adj_in AS (SELECT dst AS id, row_number() OVER (PARTITION BY dst ORDER BY trip_id) - 1 AS pos,
  src AS nb_id, src_lat AS nb_lat, src_lon AS nb_lon, weight FROM trips_ok)"""
DOC_ROWS_SELECT = """
SELECT CAST(s.id AS VARCHAR) AS key, s.lat, s.lon, 'out' AS direction, a.pos, CAST(a.nb_id AS VARCHAR) AS nb_id,
       a.nb_lat, a.nb_lon, a.weight FROM adj_out a JOIN stations s ON s.id = a.id
UNION ALL
SELECT CAST(s.id AS VARCHAR), s.lat, s.lon, 'in', a.pos, CAST(a.nb_id AS VARCHAR), a.nb_lat, a.nb_lon, a.weight
FROM adj_in a JOIN stations s ON s.id = a.id"""
DOCS = BASE + [TRIPS_OK, STATIONS, ADJ_OUT, ADJ_IN]

EDGE_STATE_ALL = """edge_all AS (
  SELECT src, dst, arg_max(weight, seq) AS weight, max(seq) AS last_seq, arg_min(src_lon, seq) AS src_lon,
         arg_min(src_lat, seq) AS src_lat, arg_min(dst_lon, seq) AS dst_lon, arg_min(dst_lat, seq) AS dst_lat,
         min(seq) AS first_seq
  FROM trip_rows GROUP BY src, dst)"""
NODE_STATE_ALL = """node_all AS (
  SELECT id, lon, lat, first_seq, role FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY first_seq, role) AS rn FROM (
      SELECT src AS id, src_lon AS lon, src_lat AS lat, seq AS first_seq, 0 AS role FROM trip_rows
      UNION ALL SELECT dst, dst_lon, dst_lat, seq, 1 FROM trip_rows) u) r
  WHERE rn = 1)"""
SNAP_EDGES = """snap_edges AS (
  SELECT src, dst, arg_max(weight, seq) AS weight FROM trip_rows WHERE seq <= (SELECT c FROM cut) GROUP BY src, dst)"""
UPDATES_LAST = """upd AS (
  SELECT src, dst, arg_max(weight, seq) AS new_weight FROM trip_rows WHERE seq > (SELECT c FROM cut)
  GROUP BY src, dst)"""
HOPS_OF_RESULT = """hop_rows AS (
  SELECT query_id, line, CAST(i AS BIGINT) AS pos, CAST(t[2 + 2 * i] AS BIGINT) AS src,
         CAST(t[3 + 2 * i] AS BIGINT) AS weight, CAST(t[4 + 2 * i] AS BIGINT) AS dst
  FROM (SELECT query_id, line, t, unnest(range(0, (len(t) - 2) // 2)) AS i
        FROM (SELECT query_id, line, string_split(line, ' ') AS t FROM result) x) y)"""
REWEIGHTED = """rw AS (
  SELECT h.query_id, h.line AS old_line, h.pos, h.src, coalesce(u.new_weight, h.weight) AS w, h.dst
  FROM hop_rows h LEFT JOIN upd u ON u.src = h.src AND u.dst = h.dst),
rw_paths AS (
  SELECT query_id, old_line, CAST(sum(w) AS BIGINT) AS total,
         CAST(sum(w) AS VARCHAR) || ' ' || CAST(arg_min(src, pos) AS VARCHAR) || ' ' ||
         string_agg(CAST(w AS VARCHAR) || ' ' || CAST(dst AS VARCHAR), ' ' ORDER BY pos) AS line
  FROM rw GROUP BY query_id, old_line
  UNION ALL
  SELECT query_id, line, CAST(0 AS BIGINT), line FROM result WHERE len(string_split(line, ' ')) = 2)"""


def _event_ksp_ctes(edges_cte: list[str], edges: str) -> list[str]:
    return O.ksp_ctes(BASE + edges_cte, edges, EVENT_QUERY, EVENT_STEPS, K)


# ============================================================== Spark-side shared inputs

def _trips_from_csv(spark, sf_dir) -> DataFrame:
    path = td.write_trips_csv(spark, sf_dir, scratch_path(spark, "trips-csv"))
    return TR.read_trips(spark, path, "trip_id")


def _documents(spark, sf_dir) -> DataFrame:
    t = _trips_from_csv(spark, sf_dir)
    return G.node_documents(G.station_nodes(t), G.adjacency_out(t), G.adjacency_in(t))


def _snapshot_rows(spark, sf_dir):
    cut = td.snapshot_cut(spark, sf_dir)
    t = td.trip_rows(spark, sf_dir)
    return t, cut


def _event_candidates(spark, sf_dir, cut=None) -> DataFrame:
    """Candidate walks of the event query on the snapshot graph (or the whole graph when ``cut`` is None)."""
    t = td.trip_rows(spark, sf_dir)
    if cut is not None:
        t = t.filter(F.col("seq") <= F.lit(cut))
    edges = G.collapse_edges(t, "last")
    return ksp.k_shortest_paths(edges, ksp.query_table(spark, EVENT_QUERY), ksp.SearchConfig(steps=EVENT_STEPS, k=K))


def _part_run(spark, sf_dir, queries=PART_QUERY) -> ksp.SearchRun:
    edges = td.part_edges(spark, sf_dir)
    return ksp.search(edges, ksp.query_table(spark, queries), ksp.SearchConfig(steps=STEPS, k=K))


def _part_search(spark, sf_dir, queries=PART_QUERY) -> DataFrame:
    return ksp.results(_part_run(spark, sf_dir, queries).state)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_search(spark, sf_dir)


# ============================================================== ingest

TRIP_COLS = "trip_id, src, dst, weight, src_lat, src_lon, dst_lat, dst_lon"


@register("trips_scan", W(BASE + [TRIPS_OK], f"SELECT {TRIP_COLS} FROM trips_ok"))
def q_trips_scan(spark, sf_dir):
    return _trips_from_csv(spark, sf_dir)


@register("trips_row_cap", W(BASE + [TRIPS_OK], f"SELECT {TRIP_COLS} FROM trips_ok ORDER BY trip_id LIMIT {ROW_CAP}"))
def q_trips_row_cap(spark, sf_dir):
    return TR.row_cap(_trips_from_csv(spark, sf_dir), ROW_CAP)


@register("trips_normalize", W(BASE, f"""SELECT {TRIP_COLS},
  (src_lat IS NOT NULL AND src_lon IS NOT NULL AND dst_lat IS NOT NULL AND dst_lon IS NOT NULL) AS valid
  FROM trip_rows"""))
def q_trips_normalize(spark, sf_dir):
    path = td.write_trips_csv(spark, sf_dir, scratch_path(spark, "trips-csv"))
    return TR.normalize_trips(TR.read_trips_raw(spark, path, "trip_id"), "trip_id")


@register("station_nodes", W(BASE + [TRIPS_OK, STATIONS], "SELECT id, lat, lon FROM stations"))
def q_station_nodes(spark, sf_dir):
    return G.station_nodes(_trips_from_csv(spark, sf_dir))


@register("adjacency_out", W(BASE + [TRIPS_OK, ADJ_OUT], "SELECT * FROM adj_out"))
def q_adjacency_out(spark, sf_dir):
    return G.adjacency_out(_trips_from_csv(spark, sf_dir))


@register("adjacency_in", W(BASE + [TRIPS_OK, ADJ_IN], "SELECT * FROM adj_in"))
def q_adjacency_in(spark, sf_dir):
    return G.adjacency_in(_trips_from_csv(spark, sf_dir))


@register("node_documents", W(DOCS, DOC_ROWS_SELECT))
def q_node_documents(spark, sf_dir):
    return G.flatten_documents(_documents(spark, sf_dir))


@register("graph_snapshot_roundtrip", W(DOCS, DOC_ROWS_SELECT))
def q_graph_snapshot_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "snapshot")
    S.write_snapshot(_documents(spark, sf_dir), base, 1)
    return G.flatten_documents(S.read_snapshot(spark, S.latest_path(spark, base)))


@register("graph_snapshot_scan", W(DOCS, """
SELECT CAST(s.id AS VARCHAR) AS key, s.lat, s.lon,
       CAST((SELECT count(*) FROM adj_in a WHERE a.id = s.id) AS BIGINT) AS n_in,
       CAST((SELECT count(*) FROM adj_out a WHERE a.id = s.id) AS BIGINT) AS n_out
FROM stations s"""))
def q_graph_snapshot_scan(spark, sf_dir):
    base = scratch_path(spark, "snapshot")
    S.write_snapshot(_documents(spark, sf_dir), base, 1)
    d = S.read_snapshot(spark, S.latest_path(spark, base))
    return d.groupBy("key").agg(
        F.first("val.lat").alias("lat"), F.first("val.lon").alias("lon"),
        F.sum(F.size("val.neighbors_in")).cast("bigint").alias("n_in"),
        F.sum(F.size("val.neighbors_out")).cast("bigint").alias("n_out"))


@register("snapshot_tolerant_read", W(DOCS, DOC_ROWS_SELECT))
def q_snapshot_tolerant_read(spark, sf_dir):
    """A stale copy, the current line and a cut-off line per document, in that order in the files."""
    docs = _documents(spark, sf_dir)
    good = F.to_json(F.struct("key", "part", "val"))
    stale = F.to_json(F.struct("key", "part", F.struct((F.col("val.lat") + 1).alias("lat"), "val.lon",
                                                       "val.neighbors_in", "val.neighbors_out").alias("val")))
    broken = F.substring(good, 1, (F.length(good) / 2).cast("int"))
    path = scratch_path(spark, "snapshot-dirty")
    docs.select(F.explode(F.array(stale, good, broken)).alias("value")).write.mode("overwrite").text(path)
    clean, _bad = S.read_snapshot_tolerant(spark, path)
    return G.flatten_documents(clean)


@register("edge_flatten", W(DOCS, """
SELECT CAST(t.src AS VARCHAR) AS src, s.lon AS src_lon, s.lat AS src_lat, CAST(t.dst AS VARCHAR) AS dst,
       t.dst_lon, t.dst_lat, t.weight, row_number() OVER (PARTITION BY t.src ORDER BY t.trip_id) - 1 AS pos
FROM trips_ok t JOIN stations s ON s.id = t.src"""))
def q_edge_flatten(spark, sf_dir):
    return G.edge_flatten(_documents(spark, sf_dir))


# ============================================================== edge tables

EDGE_STATE_COLS = "src, dst, weight, last_seq, src_lon, src_lat, dst_lon, dst_lat, first_seq"


@register("edge_table_last", W(O.event_graph(), "SELECT src, dst, weight FROM edges_event"))
def q_edge_table_last(spark, sf_dir):
    return G.collapse_edges(td.event_trips(spark, sf_dir), "last")


@register("edge_table_min", W(O.part_graph(), "SELECT src, dst, weight FROM edges_part"))
def q_edge_table_min(spark, sf_dir):
    return td.part_edges(spark, sf_dir)


@register("edge_upsert", W(BASE + [EDGE_STATE_ALL], f"SELECT {EDGE_STATE_COLS} FROM edge_all"))
def q_edge_upsert(spark, sf_dir):
    t, cut = _snapshot_rows(spark, sf_dir)
    state = G.edge_state(t.filter(F.col("seq") <= cut))
    return G.edge_upsert(state, t.filter(F.col("seq") > cut))


@register("node_upsert", W(BASE + [NODE_STATE_ALL], "SELECT id, lon, lat, first_seq, role FROM node_all"))
def q_node_upsert(spark, sf_dir):
    t, cut = _snapshot_rows(spark, sf_dir)
    nodes = G.node_state(t.filter(F.col("seq") <= cut))
    return G.node_upsert(nodes, t.filter(F.col("seq") > cut))


@register("pending_changes", W(BASE, """
SELECT count(*) AS pending, min(seq) AS first_seq, max(seq) AS last_seq FROM trip_rows
WHERE seq > (SELECT c FROM cut)"""))
def q_pending_changes(spark, sf_dir):
    t, cut = _snapshot_rows(spark, sf_dir)
    return G.pending_changes(t, cut)


SCENARIO = "scenario AS (SELECT dst AS src, src AS dst, -2 * weight AS inc FROM edges_part)"


def _scenario(spark, sf_dir):
    e = td.part_edges(spark, sf_dir)
    return e, e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("weight") * -2).alias("inc"))


@register("what_if_reweight", W(O.part_graph() + [SCENARIO], """
SELECT e.src, e.dst, abs(e.weight + coalesce(s.inc, 0)) AS weight, s.inc IS NOT NULL AS changed
FROM edges_part e LEFT JOIN (SELECT src, dst, sum(inc) AS inc FROM scenario GROUP BY src, dst) s
  ON s.src = e.src AND s.dst = e.dst"""))
def q_what_if_reweight(spark, sf_dir):
    e, s = _scenario(spark, sf_dir)
    return G.what_if_reweight(e, s)


@register("what_if_unknown_edges", W(O.part_graph() + [SCENARIO], """
SELECT DISTINCT s.src, s.dst FROM scenario s
WHERE NOT EXISTS (SELECT 1 FROM edges_part e WHERE e.src = s.src AND e.dst = s.dst)"""))
def q_what_if_unknown(spark, sf_dir):
    e, s = _scenario(spark, sf_dir)
    return G.what_if_unknown(e, s)


# ============================================================== messages

EDGE_MSG = """edge_msg AS (
  SELECT seq, CASE WHEN kind = 'error' THEN regexp_replace(v, ' [^ ]*$', '') ELSE v END AS value, kind
  FROM (SELECT seq, kind, concat_ws(' ', src, weight, dst, src_lon, src_lat, dst_lon, dst_lat) AS v
        FROM trip_rows) x)"""
PARSED = """parsed AS (
  SELECT seq, TRY_CAST(t[1] AS BIGINT) AS src, TRY_CAST(t[2] AS BIGINT) AS weight, TRY_CAST(t[3] AS BIGINT) AS dst,
         TRY_CAST(t[4] AS DOUBLE) AS src_lon, TRY_CAST(t[5] AS DOUBLE) AS src_lat,
         TRY_CAST(t[6] AS DOUBLE) AS dst_lon, TRY_CAST(t[7] AS DOUBLE) AS dst_lat, len(t) AS n
  FROM (SELECT seq, string_split(trim(value), ' ') AS t FROM edge_msg) x)"""
PARSED_SELECT = """SELECT seq, src, weight, dst, src_lon, src_lat, dst_lon, dst_lat,
  (n = 7 AND src IS NOT NULL AND weight IS NOT NULL AND dst IS NOT NULL AND src_lon IS NOT NULL
   AND src_lat IS NOT NULL AND dst_lon IS NOT NULL AND dst_lat IS NOT NULL{extra}) AS valid FROM parsed"""


@register("edge_message_format", W(BASE, """
SELECT seq, concat_ws('-', src, dst) AS key,
       concat_ws(' ', src, weight, dst, src_lon, src_lat, dst_lon, dst_lat) AS value FROM trip_rows"""))
def q_edge_message_format(spark, sf_dir):
    from pathlattice.functions.messages import edge_message_rows
    return edge_message_rows(td.trip_rows(spark, sf_dir), keep=("seq",))


@register("edge_message_parse", W(BASE + [EDGE_MSG, PARSED], PARSED_SELECT.format(extra="")))
def q_edge_message_parse(spark, sf_dir):
    from pathlattice.functions.messages import parse_edges
    return parse_edges(td.edge_messages(spark, sf_dir))


QGROUPS = """qgroups AS (
  SELECT min(seq) AS seq, kind AS client, arg_min(src, seq) AS s1, min(src) AS s2, arg_max(dst, seq) AS e1,
         max(dst) AS e2
  FROM trips_event GROUP BY CAST(ts AS DATE), kind),
qmsg AS (
  SELECT seq, client, seq AS query_id,
         (CASE WHEN s1 = s2 THEN CAST(s1 AS VARCHAR) ELSE CAST(s1 AS VARCHAR) || ' ' || CAST(s2 AS VARCHAR) END)
         || chr(10) ||
         (CASE WHEN e1 = e2 THEN CAST(e1 AS VARCHAR) ELSE CAST(e1 AS VARCHAR) || ' ' || CAST(e2 AS VARCHAR) END)
         AS value, s1, s2, e1, e2
  FROM qgroups)"""
QPARSED = """
SELECT query_id, 'start' AS side, CAST(0 AS BIGINT) AS pos, s1 AS id FROM qmsg
UNION ALL SELECT query_id, 'start', CAST(1 AS BIGINT), s2 FROM qmsg WHERE s2 <> s1
UNION ALL SELECT query_id, 'end', CAST(0 AS BIGINT), e1 FROM qmsg
UNION ALL SELECT query_id, 'end', CAST(1 AS BIGINT), e2 FROM qmsg WHERE e2 <> e1"""


def _query_msgs(spark, sf_dir):
    return td.query_messages(spark, sf_dir).withColumnRenamed("user", "client")


def _flatten_parsed_queries(df: DataFrame) -> DataFrame:
    s = df.select("query_id", F.lit("start").alias("side"), F.posexplode("starts").alias("pos", "id"))
    e = df.select("query_id", F.lit("end").alias("side"), F.posexplode("ends").alias("pos", "id"))
    return s.unionByName(e).withColumn("pos", F.col("pos").cast("bigint"))


@register("query_message_format", W([O.TRIPS_EVENT, QGROUPS], "SELECT query_id, value FROM qmsg"))
def q_query_message_format(spark, sf_dir):
    return _query_msgs(spark, sf_dir).select("query_id", "value")


@register("query_message_parse", W([O.TRIPS_EVENT, QGROUPS], QPARSED))
def q_query_message_parse(spark, sf_dir):
    m = _query_msgs(spark, sf_dir).select("query_id", parse_query("value").alias("q"))
    return _flatten_parsed_queries(m.select("query_id", "q.starts", "q.ends"))


PART_KSP = O.ksp_ctes(O.part_graph(), "edges_part", PART_QUERY, STEPS, K)


@register("path_decode", W(PART_KSP + [HOPS_OF_RESULT], "SELECT * FROM hop_rows"))
def q_path_decode(spark, sf_dir):
    return U.hops(_part_search(spark, sf_dir))


@register("path_encode", W(PART_KSP, "SELECT query_id, line, line AS encoded FROM result"))
def q_path_encode(spark, sf_dir):
    res = _part_search(spark, sf_dir)
    h = U.hops(res)
    walks = h.groupBy("query_id", "line").agg(
        F.array_sort(F.collect_list(F.struct("pos", "src", "weight", "dst"))).alias("hs"),
        F.sum("weight").alias("total"))
    enc = walks.select("query_id", "line", encode_line("total", F.col("hs")[0]["src"], "hs").alias("encoded"))
    zero = res.filter(F.col("hops") == 0).select("query_id", "line", F.col("line").alias("encoded"))
    return enc.unionByName(zero)


TOPICS = """topic_msgs AS (
  SELECT 'new_edges' AS topic, CAST(src % 4 AS INTEGER) AS partition, seq AS "offset",
         concat_ws(' ', src, weight, dst, src_lon, src_lat, dst_lon, dst_lat) AS value FROM trip_rows
  UNION ALL
  SELECT 'result', CAST(seq % 3 AS INTEGER), seq // 3, concat_ws(' ', weight, src, weight, dst) FROM trip_rows WHERE kind = 'view'),
last_view AS (SELECT arg_max(concat_ws(' ', weight, src, weight, dst), seq) AS value FROM trip_rows WHERE kind = 'view')"""


def _topic_messages(spark, sf_dir):
    from pathlattice.functions.messages import format_edge
    t = td.trip_rows(spark, sf_dir)
    message_time = F.timestamp_millis("seq").alias("timestamp")  # results come in over three partitions, in time order
    edges = t.select(F.lit("new_edges").alias("topic"), F.pmod("src", F.lit(4)).cast("int").alias("partition"),
                     F.col("seq").alias("offset"), format_edge().alias("value"), message_time)
    res = t.filter(F.col("kind") == "view").select(
        F.lit("result").alias("topic"), F.pmod("seq", F.lit(3)).cast("int").alias("partition"),
        F.floor(F.col("seq") / 3).alias("offset"), F.concat_ws(" ", "weight", "src", "weight", "dst").alias("value"), message_time)
    return edges.unionByName(res)


@register("topic_demux", W(BASE + [TOPICS], """
SELECT 'edge' AS kind, partition, "offset", value FROM topic_msgs WHERE topic = 'new_edges'
UNION ALL
SELECT 'last_result', CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), value FROM last_view"""))
def q_topic_demux(spark, sf_dir):
    edges, last = ST.demux(_topic_messages(spark, sf_dir))
    return edges.select(F.lit("edge").alias("kind"), "partition", "offset", "value").unionByName(
        last.select(F.lit("last_result").alias("kind"), F.lit(None).cast("int").alias("partition"),
                    F.lit(None).cast("bigint").alias("offset"), "value"))


# ============================================================== search (single steps and the loop)

UNKNOWN_SEEDS = O.part_graph() + O.seeds_cte(PART_QUERY_WITH_UNKNOWN, "edges_part")


@register("seed_select", W(UNKNOWN_SEEDS, "SELECT query_id, side, node FROM seeds"))
def q_seed_select(spark, sf_dir):
    return ksp.valid_seeds(ksp.query_table(spark, PART_QUERY_WITH_UNKNOWN), td.part_edges(spark, sf_dir))


@register("query_unknown_ids", W(UNKNOWN_SEEDS, """
SELECT DISTINCT query_id, side, node FROM q_seeds WHERE node NOT IN (SELECT id FROM graph_nodes)"""))
def q_query_unknown_ids(spark, sf_dir):
    return ksp.unknown_ids(ksp.query_table(spark, PART_QUERY_WITH_UNKNOWN), td.part_edges(spark, sf_dir))


def _round1_parts(spark, sf_dir, known: bool = False):
    """The state before round 1 and the adjacency; ``known``: over the nodes that start a trip, others are no nodes."""
    edges = td.part_edges(spark, sf_dir)
    nodes = edges.select(F.col("src").alias("id")).distinct() if known else None
    return ksp.first_state(ksp.valid_seeds(ksp.query_table(spark, PART_QUERY), edges, nodes)), ksp.adjacency(edges, nodes)


# more rows than any node has in round 1: nothing is cut
ALL_ROWS = 2**31 - 1


ROUND1 = O.part_graph() + O.seeds_cte(PART_QUERY, "edges_part") + O.search_ctes("edges_part", 1, K)[0]
FWD1 = """SELECT s.query_id, s.side, e.dst AS node, s.cost + e.weight AS cost,
  s.path || CAST(e.src AS VARCHAR) || ' ' || CAST(e.weight AS VARCHAR) || ' ' AS path
  FROM s0 s JOIN edges_part e ON s.node = e.src WHERE s.side = 'start'"""
BWD1 = """SELECT s.query_id, s.side, e.src AS node, s.cost + e.weight AS cost,
  ' ' || CAST(e.weight AS VARCHAR) || ' ' || CAST(e.dst AS VARCHAR) || s.path AS path
  FROM s0 s JOIN edges_part e ON s.node = e.dst WHERE s.side = 'end'"""


@register("expand_forward_1", W(ROUND1, FWD1))
def q_expand_forward_1(spark, sf_dir):
    s0, adj = _round1_parts(spark, sf_dir)
    return ksp.expand(s0, adj).filter(F.col("side") == ksp.START)


@register("expand_backward_1", W(ROUND1, BWD1))
def q_expand_backward_1(spark, sf_dir):
    s0, adj = _round1_parts(spark, sf_dir)
    return ksp.expand(s0, adj).filter(F.col("side") == ksp.END)


@register("merge_messages", W(ROUND1, f"{FWD1}\nUNION\n{BWD1}"))
def q_merge_messages(spark, sf_dir):
    return ksp.step(*_round1_parts(spark, sf_dir), ALL_ROWS).filter("is_new").select(*ksp.STATE_COLS)


@register("state_merge", W(ROUND1, f"SELECT query_id, side, node, cost, path FROM s0\nUNION\n{FWD1}\nUNION\n{BWD1}"))
def q_state_merge(spark, sf_dir):
    return ksp.step(*_round1_parts(spark, sf_dir), ALL_ROWS).select(*ksp.STATE_COLS)


KNOWN_NODES = "known_nodes AS (SELECT DISTINCT src AS id FROM edges_part)"
KNOWN_SEEDS = "known_seeds AS (SELECT * FROM s0 WHERE node IN (SELECT id FROM known_nodes))"


@register("state_merge_known_nodes", W(ROUND1 + [KNOWN_NODES, KNOWN_SEEDS], f"""
SELECT query_id, side, node, cost, path FROM known_seeds
UNION SELECT * FROM ({FWD1.replace("FROM s0", "FROM known_seeds")}) f WHERE node IN (SELECT id FROM known_nodes)
UNION SELECT * FROM ({BWD1.replace("FROM s0", "FROM known_seeds")}) b WHERE node IN (SELECT id FROM known_nodes)"""))
def q_state_merge_known_nodes(spark, sf_dir):
    """An edge to an id that is no node brings nothing into the state."""
    return ksp.step(*_round1_parts(spark, sf_dir, known=True), ALL_ROWS).select(*ksp.STATE_COLS)


@register("top_k_per_node", W(ROUND1, "SELECT * FROM s1"))
def q_top_k_per_node(spark, sf_dir):
    return ksp.step(*_round1_parts(spark, sf_dir), K).select(*ksp.STATE_COLS)


PART_STATE = O.part_graph() + O.seeds_cte(PART_QUERY, "edges_part") + O.search_ctes("edges_part", STEPS, K)[0]


def _final_state(spark, sf_dir) -> DataFrame:
    return _part_run(spark, sf_dir).state.select(*ksp.STATE_COLS)


@register("k_best_forward", W(PART_STATE, f"SELECT * FROM s{STEPS} WHERE side = 'start'"))
def q_k_best_forward(spark, sf_dir):
    return _final_state(spark, sf_dir).filter(F.col("side") == ksp.START)


@register("k_best_backward", W(PART_STATE, f"SELECT * FROM s{STEPS} WHERE side = 'end'"))
def q_k_best_backward(spark, sf_dir):
    return _final_state(spark, sf_dir).filter(F.col("side") == ksp.END)


@register("meeting_nodes", W(PART_KSP, "SELECT DISTINCT query_id, node FROM meet"))
def q_meeting_nodes(spark, sf_dir):
    return ksp.meet(_final_state(spark, sf_dir)).select("query_id", "node").distinct()


@register("meet_in_middle", W(PART_KSP, "SELECT query_id, node, total, line FROM meet"))
def q_meet_in_middle(spark, sf_dir):
    return ksp.meet(_final_state(spark, sf_dir))


@register("distinct_results", W(PART_KSP, "SELECT query_id, total, line FROM result"))
def q_distinct_results(spark, sf_dir):
    return _part_search(spark, sf_dir).select("query_id", "total", "line")


RANKED = "SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY total, line) AS rank, total, line FROM result"


@register("ranked_results", W(PART_KSP, RANKED))
def q_ranked_results(spark, sf_dir):
    return rank_in_group(_part_search(spark, sf_dir), ["query_id"], ["total", "line"], "rank") \
        .select("query_id", "rank", "total", "line")


@register("shortest_path", W(PART_KSP, f"SELECT query_id, total, line FROM ({RANKED}) r WHERE rank = 1"))
def q_shortest_path(spark, sf_dir):
    return U.best_k(_part_search(spark, sf_dir), 1).select("query_id", "total", "line")


register("k_shortest_paths", O.ksp_sql(O.part_graph(), "edges_part", PART_QUERY, STEPS, K))(flagship)


@register("k_shortest_multi_source", O.ksp_sql(O.event_graph(), "edges_event", EVENT_QUERY, EVENT_STEPS, K))
def q_k_shortest_multi_source(spark, sf_dir):
    edges = G.collapse_edges(td.event_trips(spark, sf_dir), "last")
    return ksp.k_shortest_paths(edges, ksp.query_table(spark, EVENT_QUERY), ksp.SearchConfig(steps=EVENT_STEPS, k=K))


@register("k_shortest_many_queries", O.ksp_sql(O.part_graph(), "edges_part", MANY_QUERIES, STEPS, K))
def q_k_shortest_many_queries(spark, sf_dir):
    return _part_search(spark, sf_dir, MANY_QUERIES)


# ============================================================== speed layer (batch form)

SNAP_KSP = _event_ksp_ctes([SNAP_EDGES], "snap_edges")
RW = SNAP_KSP + [UPDATES_LAST, HOPS_OF_RESULT, REWEIGHTED]
RW_RANKED = "SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY total, line) AS rank, total, line FROM rw_paths"


def _reweighted(spark, sf_dir, log_from=None):
    cut = td.snapshot_cut(spark, sf_dir)
    cands = _event_candidates(spark, sf_dir, cut)
    t = td.trip_rows(spark, sf_dir)
    if log_from is None:
        return U.reweight(cands, U.last_update_per_edge(t.filter(F.col("seq") > cut)))
    # the log as four topic partitions, and how far the snapshot had read each of them
    places = t.withColumn("partition", F.pmod("src", F.lit(4)).cast("int")).withColumn("offset", F.col("seq"))
    progress = ST.progress_of(places.filter(F.col("seq") <= cut))
    return U.replay(cands, places.filter(F.col("seq") > F.lit(log_from)), progress)


@register("reweight_paths", W(RW, "SELECT query_id, old_line, total, line FROM rw_paths"))
def q_reweight_paths(spark, sf_dir):
    return _reweighted(spark, sf_dir)


@register("best_three_after_update", W(RW, f"SELECT * FROM ({RW_RANKED}) r WHERE rank <= 3"))
def q_best_three(spark, sf_dir):
    return U.best_k(_reweighted(spark, sf_dir), 3).select("query_id", "rank", "total", "line")


@register("replay_updates", W(RW, "SELECT query_id, old_line, total, line FROM rw_paths"))
def q_replay_updates(spark, sf_dir):
    log_from = td.snapshot_cut(spark, sf_dir, 3, 5)
    return _reweighted(spark, sf_dir, log_from=log_from)


@register("lambda_view", W(RW, RW_RANKED))
def q_lambda_view(spark, sf_dir):
    log_from = td.snapshot_cut(spark, sf_dir, 3, 5)
    rw = _reweighted(spark, sf_dir, log_from=log_from)
    return rank_in_group(rw, ["query_id"], ["total", "line"], "rank").select("query_id", "rank", "total", "line")


@register("result_scan", W(PART_KSP, "SELECT query_id, total, line FROM result"))
def q_result_scan(spark, sf_dir):
    path = R.write_results_text(_part_search(spark, sf_dir), scratch_path(spark, "results-text"))
    return R.read_results_text(spark, path)


@register("result_roundtrip", W(PART_KSP, f"SELECT query_id, total, {O.HOPS} AS hops, line FROM result"))
def q_result_roundtrip(spark, sf_dir):
    path = R.write_results_parquet(_part_search(spark, sf_dir), scratch_path(spark, "results-parquet"))
    return spark.read.parquet(path)


# ============================================================== streams (availableNow over file sources)

def _message_files(df: DataFrame, path: str, batches: int = 8, file_rows: int = 100_000) -> int:
    """Messages as Parquet files in ``batches`` ranges of ``seq``; the number of files that make one micro-batch.

    A file is one task of its batch, so a range is cut into files of at most ``file_rows`` rows: the number of batches stays, and the
    tasks of each grow with the messages."""
    df.select("seq", "value").repartitionByRange(batches, "seq").write.mode("overwrite") \
        .option("maxRecordsPerFile", file_rows).parquet(path)
    return max(1, math.ceil(len(df.sparkSession.read.parquet(path).inputFiles()) / batches))


def _edge_message_stream(spark, sf_dir, name, rows: DataFrame | None = None, malformed="error"):
    msgs = td.edge_messages(spark, sf_dir, malformed)
    if rows is not None:
        msgs = msgs.join(rows.select("seq"), "seq", "left_semi")
    src = scratch_path(spark, f"{name}-in")
    return ST.message_stream(spark, "parquet", src, max_files_per_trigger=_message_files(msgs, src))


@register("edge_stream_source", W(BASE + [EDGE_MSG, PARSED], PARSED_SELECT.format(extra=" AND weight >= 0")))
def q_edge_stream_source(spark, sf_dir):
    stream = _edge_message_stream(spark, sf_dir, "edge-stream")
    sink, ck = scratch_path(spark, "edge-stream-out"), scratch_path(spark, "edge-stream-ck")
    J.run(J.collect_edges(stream, sink, ck))
    return spark.read.parquet(sink)


@register("query_stream_source", W([O.TRIPS_EVENT, QGROUPS], QPARSED))
def q_query_stream_source(spark, sf_dir):
    msgs = _query_msgs(spark, sf_dir)
    src = scratch_path(spark, "query-stream-in")
    stream = ST.message_stream(spark, "parquet", src, max_files_per_trigger=_message_files(msgs, src, batches=4))
    sink, ck = scratch_path(spark, "query-stream-out"), scratch_path(spark, "query-stream-ck")
    J.run(J.collect_queries(stream, sink, ck))
    return _flatten_parsed_queries(spark.read.parquet(sink).withColumnRenamed("seq", "query_id"))


@register("stream_edge_upsert", W(BASE + [EDGE_STATE_ALL], f"SELECT {EDGE_STATE_COLS} FROM edge_all"))
def q_stream_edge_upsert(spark, sf_dir):
    stream = _edge_message_stream(spark, sf_dir, "upsert", malformed=None)
    sink, ck = scratch_path(spark, "upsert-out"), scratch_path(spark, "upsert-ck")
    J.run(J.edge_upsert_stream(stream, sink, ck))
    return J.current_edges(spark, sink).select(*[c.strip() for c in EDGE_STATE_COLS.split(",")])


def _publish(spark, sf_dir):
    t, cut = _snapshot_rows(spark, sf_dir)
    base = scratch_path(spark, "published")
    log, ck = scratch_path(spark, "change-log"), scratch_path(spark, "publish-ck")
    stream = _edge_message_stream(spark, sf_dir, "publish", rows=t.filter(F.col("seq") > cut), malformed=None)
    q = J.publish_stream(stream, G.edge_state(t.filter(F.col("seq") <= cut)), base, log, ck, compact_every=3)
    J.run(q)
    return J.flush(spark, base, log), base


@register("stream_snapshot_publish", W(BASE + [EDGE_STATE_ALL], f"SELECT {EDGE_STATE_COLS} FROM edge_all"))
def q_stream_snapshot_publish(spark, sf_dir):
    snap, _ = _publish(spark, sf_dir)
    return snap.select(*[c.strip() for c in EDGE_STATE_COLS.split(",")])


def _speed_layer(spark, sf_dir, messages: bool = False):
    t, cut = _snapshot_rows(spark, sf_dir)
    cands_base, emit = scratch_path(spark, "candidates"), scratch_path(spark, "emitted")
    _event_candidates(spark, sf_dir, cut).select("query_id", "total", "line") \
        .write.mode("overwrite").parquet(f"{cands_base}/v=0")
    stream = _edge_message_stream(spark, sf_dir, "speed", rows=t.filter(F.col("seq") > cut), malformed=None)
    J.run(J.reweight_stream(stream, cands_base, scratch_path(spark, "speed-updates"),
                            ST.message_sink("json", path=emit) if messages else emit, scratch_path(spark, "speed-ck")))
    return f"{cands_base}-weighted", emit


@register("stream_reweight_paths", W(RW, "SELECT query_id, total, line FROM rw_paths"))
def q_stream_reweight_paths(spark, sf_dir):
    base, _ = _speed_layer(spark, sf_dir)
    return J.weighted_paths(spark, base)


@register("stream_best_path", W(RW, f"SELECT * FROM ({RW_RANKED}) r WHERE rank <= 3"))
def q_stream_best_path(spark, sf_dir):
    _, emit = _speed_layer(spark, sf_dir)
    return J.newest_emitted(spark, emit).select("query_id", "rank", "total", F.col("value").alias("line"))


@register("best_path_emit", W(RW, f"SELECT query_id, rank, line AS value FROM ({RW_RANKED}) r WHERE rank <= 3"))
def q_best_path_emit(spark, sf_dir):
    """K3: the speed layer sends its messages itself; a reader takes the newest of each query and rank."""
    _, emit = _speed_layer(spark, sf_dir, messages=True)
    m = ST.first_delivery(spark.read.schema("key string, value string").json(f"{emit}/batch=*"))
    part = F.split("key", "/")
    m = m.select(part[0].cast("bigint").alias("batch"), part[1].cast("bigint").alias("query_id"),
                 part[2].cast("bigint").alias("rank"), "value")
    return m.groupBy("query_id", "rank").agg(F.max_by("value", "batch").alias("value"))


@register("latest_query", W([O.TRIPS_EVENT, QGROUPS], """
SELECT client, max(seq) AS seq, arg_max(value, seq) AS value FROM qmsg GROUP BY client"""))
def q_latest_query(spark, sf_dir):
    msgs = _query_msgs(spark, sf_dir)
    src = scratch_path(spark, "latest-in")
    msgs.select("seq", "client", "value").repartitionByRange(4, "seq").write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema("seq bigint, client string, value string") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    sink, ck = scratch_path(spark, "latest-out"), scratch_path(spark, "latest-ck")
    J.run(J.latest_query_stream(stream, sink, ck, user_col="client"))
    d = spark.read.parquet(sink)
    return d.groupBy("client").agg(F.max_by(F.struct("seq", "value"), "batch").alias("r")) \
        .select("client", "r.seq", "r.value")


@register("superseded_queries", W([O.TRIPS_EVENT, QGROUPS], """
SELECT m.client, m.seq FROM qmsg m WHERE m.seq < (SELECT max(seq) FROM qmsg x WHERE x.client = m.client)"""))
def q_superseded_queries(spark, sf_dir):
    msgs = _query_msgs(spark, sf_dir)
    newest = msgs.groupBy("client").agg(F.max("seq").alias("newest"))
    path = scratch_path(spark, "query-status")
    msgs.join(newest, "client").select(F.col("seq").alias("query_id"), (F.col("seq") < F.col("newest")).alias("superseded")) \
        .write.parquet(path)
    # the search's hook between rounds: what it takes out of a state that holds every query
    state = msgs.select(F.col("seq").alias("query_id"), "client", "seq")
    kept = J.superseded_filter(lambda: spark.read.parquet(path))(1, state)
    return state.join(kept, "query_id", "left_anti").select("client", "seq")


@register("preempted_search", O.ksp_sql(O.event_graph(), "edges_event", [MANY_QUERIES[1]], EVENT_STEPS, K))
def q_preempted_search(spark, sf_dir):
    """ST8 in a running search: after round 1 a newer query replaces the first, whose rows then leave the search."""
    edges = G.collapse_edges(td.event_trips(spark, sf_dir), "last")
    path = scratch_path(spark, "status")
    spark.createDataFrame([(q, False) for q, _, _ in MANY_QUERIES[:2]], "query_id bigint, superseded boolean").write.parquet(path)
    asked = []

    def status():
        asked.append(path)
        if len(asked) == 2:  # between rounds 1 and 2
            spark.createDataFrame([(MANY_QUERIES[0][0], True)], "query_id bigint, superseded boolean").write.mode("append").parquet(path)
        return spark.read.schema("query_id bigint, superseded boolean").parquet(path)

    run = ksp.search(edges, ksp.query_table(spark, MANY_QUERIES[:2]), ksp.SearchConfig(steps=EVENT_STEPS, k=K),
                     between_rounds=J.superseded_filter(status))
    return ksp.results(run.state)


@register("recompute_on_snapshot", O.ksp_sql(O.event_graph(), "edges_event", EVENT_QUERY, EVENT_STEPS, K))
def q_recompute_on_snapshot(spark, sf_dir):
    _, base = _publish(spark, sf_dir)
    events = scratch_path(spark, "versions")
    spark.createDataFrame([(v,) for v, _ in S.edge_versions(spark, base)], "version bigint") \
        .write.mode("overwrite").parquet(events)
    stream = spark.readStream.schema("version bigint").parquet(events)
    res = scratch_path(spark, "recomputed")
    queries = ksp.query_table(spark, EVENT_QUERY)
    J.run(J.recompute_stream(stream, base, queries, res, scratch_path(spark, "recompute-ck"),
                             ksp.SearchConfig(steps=EVENT_STEPS, k=K)))
    return J.current_results(spark, res)


@register("recompute_active_queries", O.ksp_sql(O.event_graph(), "edges_event", [MANY_QUERIES[0], MANY_QUERIES[2]], EVENT_STEPS, K))
def q_recompute_active_queries(spark, sf_dir):
    """ST9 with a registry: one query from the first published version on, one added and one retired while the stream runs."""
    _, base = _publish(spark, sf_dir)
    events, registry = scratch_path(spark, "versions"), scratch_path(spark, "registry")
    versions = sorted({v for v, _ in S.edge_versions(spark, base)})
    for v in (versions[-2], versions[-1]):
        spark.createDataFrame([(v,)], "version bigint").coalesce(1).write.mode("append").parquet(events)
    stream = spark.readStream.schema("version bigint").option("maxFilesPerTrigger", 1).parquet(events)
    J.register_queries(spark, registry, ksp.query_table(spark, MANY_QUERIES[:2]))
    asked = []

    def active():
        asked.append(registry)
        if len(asked) == 2:
            J.register_queries(spark, registry, ksp.query_table(spark, [MANY_QUERIES[2]]))
            J.register_queries(spark, registry, ksp.query_table(spark, [MANY_QUERIES[1]]), active=False)
        return J.active_queries(spark, registry)

    res = scratch_path(spark, "recomputed")
    J.run(J.recompute_stream(stream, base, active, res, scratch_path(spark, "recompute-ck"),
                             ksp.SearchConfig(steps=EVENT_STEPS, k=K)))
    return J.current_results(spark, res)


# ============================================================== map layers

EDGE_LAYER = """edge_layer AS (SELECT CAST(src AS VARCHAR) || '-' || CAST(dst AS VARCHAR) AS key, src, dst,
  src_lon, src_lat, dst_lon, dst_lat, weight FROM edge_all)"""
FULL_KSP = _event_ksp_ctes([O.EDGES_EVENT], "edges_event")
BEST_HOPS = """best AS (SELECT query_id, total, line FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY total, line) AS rn FROM result) r WHERE rn = 1),
best_hops AS (SELECT * FROM hop_rows WHERE line IN (SELECT line FROM best))"""


def _layers_base(spark, sf_dir):
    t = td.trip_rows(spark, sf_dir)
    edges = G.edge_state(t)
    nodes = G.node_state(t)
    return t, edges, nodes


def _best_path(spark, sf_dir):
    return U.best_k(_event_candidates(spark, sf_dir), 1)


@register("node_layer", W(BASE + [NODE_STATE_ALL], "SELECT id, lon, lat FROM node_all"))
def q_node_layer(spark, sf_dir):
    _, _, nodes = _layers_base(spark, sf_dir)
    return L.node_layer(nodes)


@register("edge_layer", W(BASE + [EDGE_STATE_ALL, EDGE_LAYER], "SELECT * FROM edge_layer"))
def q_edge_layer(spark, sf_dir):
    _, edges, _ = _layers_base(spark, sf_dir)
    return L.edge_layer(edges)


@register("edge_midpoint", W(BASE + [EDGE_STATE_ALL, EDGE_LAYER], """
SELECT key, (src_lon + dst_lon) / 2 AS mid_lon, (src_lat + dst_lat) / 2 AS mid_lat, weight FROM edge_layer"""))
def q_edge_midpoint(spark, sf_dir):
    _, edges, _ = _layers_base(spark, sf_dir)
    return L.edge_midpoints(L.edge_layer(edges))


@register("edge_direction_anchor", W(BASE + [EDGE_STATE_ALL, EDGE_LAYER], """
SELECT key, (src_lon * 3 + dst_lon * 5) / 8 AS a_lon, (src_lat * 3 + dst_lat * 5) / 8 AS a_lat,
       (src_lon + dst_lon * 7) / 8 AS b_lon, (src_lat + dst_lat * 7) / 8 AS b_lat FROM edge_layer"""))
def q_edge_direction_anchor(spark, sf_dir):
    _, edges, _ = _layers_base(spark, sf_dir)
    return L.edge_anchors(L.edge_layer(edges))


@register("map_anchor", W(BASE + [NODE_STATE_ALL], "SELECT min(lon) AS lon, max(lat) AS lat FROM node_all"))
def q_map_anchor(spark, sf_dir):
    _, _, nodes = _layers_base(spark, sf_dir)
    return L.map_anchor(nodes)


@register("path_overlay", W(FULL_KSP + [HOPS_OF_RESULT, BEST_HOPS, EDGE_STATE_ALL, EDGE_LAYER], """
SELECT e.key, e.src, e.dst, coalesce(p.w, e.weight) AS weight, p.w IS NOT NULL AS on_path
FROM edge_layer e LEFT JOIN (SELECT src, dst, max(weight) AS w FROM best_hops GROUP BY src, dst) p
  ON p.src = e.src AND p.dst = e.dst"""))
def q_path_overlay(spark, sf_dir):
    _, edges, _ = _layers_base(spark, sf_dir)
    return L.path_overlay(L.edge_layer(edges), U.hops(_best_path(spark, sf_dir)))


@register("path_node_layer", W(FULL_KSP + [BEST_HOPS.split(",\nbest_hops")[0], NODE_STATE_ALL], """
SELECT b.query_id, CAST(i AS BIGINT) AS pos, CAST(t[2 + 2 * i] AS BIGINT) AS id, n.lon, n.lat
FROM (SELECT query_id, string_split(line, ' ') AS t, unnest(range(0, (len(string_split(line, ' ')) - 2) // 2 + 1)) AS i
      FROM best) b
JOIN node_all n ON n.id = CAST(t[2 + 2 * i] AS BIGINT)"""))
def q_path_node_layer(spark, sf_dir):
    _, _, nodes = _layers_base(spark, sf_dir)
    best = _best_path(spark, sf_dir)
    ids = best.select("query_id", F.posexplode(decode_nodes("line")).alias("pos", "id")) \
        .withColumn("pos", F.col("pos").cast("bigint"))
    return L.path_node_layer(ids, nodes).select("query_id", "pos", "id", "lon", "lat")


@register("resolve_coordinates", W(BASE + ["""snap_nodes AS (
  SELECT id, lon, lat FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY first_seq, role) AS rn FROM (
      SELECT src AS id, src_lon AS lon, src_lat AS lat, seq AS first_seq, 0 AS role FROM trip_rows WHERE seq <= (SELECT c FROM cut)
      UNION ALL SELECT dst, dst_lon, dst_lat, seq, 1 FROM trip_rows WHERE seq <= (SELECT c FROM cut)) u) r
  WHERE rn = 1)""", """ends AS (
  SELECT seq, 0 AS role, src AS id, src_lon AS lon, src_lat AS lat FROM trip_rows WHERE seq > (SELECT c FROM cut)
  UNION ALL SELECT seq, 1, dst, dst_lon, dst_lat FROM trip_rows WHERE seq > (SELECT c FROM cut))"""], """
SELECT e.seq, e.role, e.id, coalesce(n.lon, e.lon) AS lon, coalesce(n.lat, e.lat) AS lat, n.id IS NOT NULL AS known
FROM ends e LEFT JOIN snap_nodes n ON n.id = e.id"""))
def q_resolve_coordinates(spark, sf_dir):
    t, cut = _snapshot_rows(spark, sf_dir)
    nodes = G.node_state(t.filter(F.col("seq") <= cut))
    u = t.filter(F.col("seq") > cut)
    ends = u.select("seq", F.lit(0).alias("role"), F.col("src").alias("id"), F.col("src_lon").alias("lon"),
                    F.col("src_lat").alias("lat")).unionByName(
           u.select("seq", F.lit(1).alias("role"), F.col("dst").alias("id"), F.col("dst_lon").alias("lon"),
                    F.col("dst_lat").alias("lat")))
    return L.resolve_coordinates(ends, nodes)


@register("off_graph_hops", W(FULL_KSP + [SNAP_EDGES, HOPS_OF_RESULT], """
SELECT h.* FROM hop_rows h WHERE NOT EXISTS (SELECT 1 FROM snap_edges e WHERE e.src = h.src AND e.dst = h.dst)"""))
def q_off_graph_hops(spark, sf_dir):
    t, cut = _snapshot_rows(spark, sf_dir)
    snap = G.collapse_edges(t.filter(F.col("seq") <= cut), "last")
    return L.off_graph_hops(U.hops(_event_candidates(spark, sf_dir)), snap)


@register("node_ids", W(BASE + [NODE_STATE_ALL], "SELECT id FROM node_all ORDER BY id"))
def q_node_ids(spark, sf_dir):
    _, _, nodes = _layers_base(spark, sf_dir)
    return nodes.select("id").distinct().orderBy("id")


@register("node_layer_append", W(BASE + [NODE_STATE_ALL], """
SELECT id, lon, lat FROM node_all WHERE first_seq > (SELECT max(event_id) // 50 FROM events)"""))
def q_node_layer_append(spark, sf_dir):
    """L1 append: nodes first seen after an early publish (the first 2% of changes) are added to the layer once."""
    t = td.trip_rows(spark, sf_dir)
    cut = td.snapshot_cut(spark, sf_dir, 1, 50)
    shown = L.node_layer(G.node_state(t.filter(F.col("seq") <= cut)))
    current = G.node_upsert(G.node_state(t.filter(F.col("seq") <= cut)), t.filter(F.col("seq") > cut))
    return L.new_nodes(current, shown)


LATEST_Q_SEEDS = """
  SELECT seq AS query_id, 'start' AS side, s1 AS node FROM latest_q
  UNION ALL SELECT seq, 'start', s2 FROM latest_q
  UNION ALL SELECT seq, 'end', e1 FROM latest_q
  UNION ALL SELECT seq, 'end', e2 FROM latest_q"""
_QUERY_STREAM_RESULTS_SQL = W(
    [O.TRIPS_EVENT, O.EDGES_EVENT, QGROUPS,
     "latest_q AS (SELECT * FROM qmsg WHERE seq IN (SELECT max(seq) FROM qmsg GROUP BY client))"]
    + O.seeds_from(LATEST_Q_SEEDS, "edges_event") + O.search_ctes("edges_event", EVENT_STEPS, K)[0]
    + [O.meet_cte(f"s{EVENT_STEPS}"), O.RESULT_CTE],
    f"SELECT query_id, total, {O.HOPS} AS hops, line FROM result")


@register("query_stream_results", _QUERY_STREAM_RESULTS_SQL)
def q_query_stream_results(spark, sf_dir):
    """The batch layer as a stream: newest query per client → one search loop → versioned results."""
    msgs = _query_msgs(spark, sf_dir)
    src = scratch_path(spark, "path-queries-in")
    msgs.select("seq", "client", "value").repartitionByRange(4, "seq").write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema("seq bigint, client string, value string") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    edges = G.collapse_edges(td.event_trips(spark, sf_dir), "last")
    out, ck = scratch_path(spark, "path-results"), scratch_path(spark, "path-queries-ck")
    J.run(J.path_query_stream(stream, lambda: (0, edges), out, ck, ksp.SearchConfig(steps=EVENT_STEPS, k=K)))
    newest = msgs.groupBy("client").agg(F.max("seq").alias("seq"))
    return J.newest_results(spark, out, newest)


DOC_EDGES = """doc_edges AS (SELECT src, dst, arg_max(weight, trip_id) AS weight FROM trips_ok GROUP BY src, dst)"""


@register("snapshot_k_shortest_paths", O.ksp_sql(BASE + [TRIPS_OK, DOC_EDGES], "doc_edges", EVENT_QUERY, EVENT_STEPS, K))
def q_snapshot_k_shortest_paths(spark, sf_dir):
    """The main path: trips → node documents (parallel edges kept) → snapshot → read → edges, last entry wins → search."""
    base = scratch_path(spark, "snapshot-search")
    S.write_snapshot(_documents(spark, sf_dir), base, 1)
    flat = G.edge_flatten(S.read_snapshot(spark, S.latest_path(spark, base)))
    edges = G.collapse_edges(flat, "last", "pos").select(F.col("src").cast("bigint").alias("src"),
                                                         F.col("dst").cast("bigint").alias("dst"), "weight")
    return ksp.k_shortest_paths(edges, ksp.query_table(spark, EVENT_QUERY), ksp.SearchConfig(steps=EVENT_STEPS, k=K))
