"""Graph building and maintenance: stations, adjacency lists, node documents, edge tables and upserts.

Normalised model: ``trips(trip_id, src, dst, weight, src_lat, src_lon, dst_lat, dst_lon)``,
``nodes(id, lat, lon)``, ``edges(src, dst, weight, …)``. Node documents (one JSON line per node with
neighbor lists) are derived on export only. Every per-key reduction is an aggregate with a partial
(map-side) step, so a hub node never has to be gathered in one task except through bounded chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathlattice.operators.sequence import rank_in_group

# Neighbors per document line: every node is written as the lines part = 0, 1, … of at most so many neighbors a side.
DOCUMENT_CHUNK = 10_000

COORDINATES = ("src_lon", "src_lat", "dst_lon", "dst_lat")
EDGE_STATE = ("src", "dst", "weight", "last_seq", *COORDINATES, "first_seq")


# ---------------------------------------------------------------- stations and adjacency (A1-A3)

def station_nodes(trips: DataFrame) -> DataFrame:
    """A1: one row per station of starts ∪ ends, at the position of its first occurrence.

    The start pass precedes the end pass, each in trip order: a station's first start and first end are each one hash
    aggregate, and the start wins."""
    def first(role):
        return trips.select(F.col(role).alias("id"), F.col(f"{role}_lat").alias("lat"), F.col(f"{role}_lon").alias("lon"),
                            "trip_id")

    both = first("src").select("id", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"), F.col("trip_id").alias("s"),
                               *(F.lit(None).cast(t).alias(n) for n, t in (("e_lat", "double"), ("e_lon", "double"))),
                               F.lit(None).cast(trips.schema["trip_id"].dataType).alias("e")).unionByName(
        first("dst").select("id", *(F.lit(None).cast("double").alias(n) for n in ("s_lat", "s_lon")),
                            F.lit(None).cast(trips.schema["trip_id"].dataType).alias("s"),
                            F.col("lat").alias("e_lat"), F.col("lon").alias("e_lon"), F.col("trip_id").alias("e")))
    # min_by skips rows whose order is null
    g = both.groupBy("id").agg(F.min_by("s_lat", "s").alias("s_lat"), F.min_by("s_lon", "s").alias("s_lon"),
                               F.min("s").alias("s"), F.min_by("e_lat", "e").alias("e_lat"),
                               F.min_by("e_lon", "e").alias("e_lon"))
    return g.select("id", F.when(F.col("s").isNotNull(), F.col("s_lat")).otherwise(F.col("e_lat")).alias("lat"),
                    F.when(F.col("s").isNotNull(), F.col("s_lon")).otherwise(F.col("e_lon")).alias("lon"))


def adjacency_out(trips: DataFrame) -> DataFrame:
    """A2: out-list entries, one per trip (parallel edges kept), ``pos`` = 0-based trip order per station."""
    rows = trips.select(F.col("src").alias("id"), "trip_id", F.col("dst").alias("nb_id"),
                        F.col("dst_lat").alias("nb_lat"), F.col("dst_lon").alias("nb_lon"), "weight")
    return (rank_in_group(rows, ["id"], ["trip_id"], "pos")
            .select("id", (F.col("pos") - 1).alias("pos"), "nb_id", "nb_lat", "nb_lon", "weight"))


def adjacency_in(trips: DataFrame) -> DataFrame:
    """A3: in-list entries, one per trip, in trip order per station."""
    rows = trips.select(F.col("dst").alias("id"), "trip_id", F.col("src").alias("nb_id"),
                        F.col("src_lat").alias("nb_lat"), F.col("src_lon").alias("nb_lon"), "weight")
    return (rank_in_group(rows, ["id"], ["trip_id"], "pos")
            .select("id", (F.col("pos") - 1).alias("pos"), "nb_id", "nb_lat", "nb_lon", "weight"))


def _chunked_lists(adj: DataFrame, name: str, chunk: int) -> DataFrame:
    nb = F.struct(F.col("nb_id").cast("string").alias("id"), F.col("nb_lat").alias("lat"),
                  F.col("nb_lon").alias("lon"), F.col("weight").cast("bigint").alias("weight"))
    return (adj.withColumn("part", (F.col("pos") / chunk).cast("int"))
            .groupBy("id", "part")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("pos"), nb.alias("nb")))).alias("_l"))
            .select("id", "part", F.transform("_l", lambda x: x["nb"]).alias(name)))


def node_documents(stations: DataFrame, adj_out: DataFrame, adj_in: DataFrame,
                   chunk: int = DOCUMENT_CHUNK) -> DataFrame:
    """``(key, part, val{lat, lon, neighbors_in, neighbors_out})``; a missing side is an empty list.

    One layout at every size: a node's lines are ``part = 0, 1, …`` with at most ``chunk`` neighbors a side, and a node
    without edges has the line 0 alone. The neighbor arrays meet only the station's position, in a join on the id."""
    outs = _chunked_lists(adj_out, "neighbors_out", chunk)
    ins = _chunked_lists(adj_in, "neighbors_in", chunk)
    parts = outs.join(ins, ["id", "part"], "full").join(stations, "id")
    empty = F.array().cast("array<struct<id:string,lat:double,lon:double,weight:bigint>>")
    lone = stations.join(adj_out.select("id").unionByName(adj_in.select("id")).distinct(), "id", "left_anti").select(
        "id", F.lit(0).alias("part"), "lat", "lon", empty.alias("neighbors_in"), empty.alias("neighbors_out"))
    docs = parts.select("id", "part", "lat", "lon", F.coalesce("neighbors_in", empty).alias("neighbors_in"),
                        F.coalesce("neighbors_out", empty).alias("neighbors_out")).unionByName(lone)
    return docs.select(F.col("id").cast("string").alias("key"), "part",
                       F.struct("lat", "lon", "neighbors_in", "neighbors_out").alias("val"))


def one_line_documents(docs: DataFrame) -> DataFrame:
    """Export for readers that know one line per node only: ``(key, val)`` with whole lists.

    A node's lists come together in one row here, as that format asks; do not use it on graphs with unbounded hubs."""
    whole = docs.groupBy("key").agg(
        F.min("val.lat").alias("lat"), F.min("val.lon").alias("lon"),
        *(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", F.col(f"val.{n}").alias("l")))),
                                lambda x: x["l"])).alias(n) for n in ("neighbors_in", "neighbors_out")))
    return whole.select("key", F.struct("lat", "lon", "neighbors_in", "neighbors_out").alias("val"))


def flatten_documents(docs: DataFrame, chunk: int = DOCUMENT_CHUNK) -> DataFrame:
    """Documents back to one row per list entry: ``(key, lat, lon, direction, pos, nb_id, nb_lat, nb_lon, weight)``."""
    base = docs.select("key", F.coalesce("part", F.lit(0)).alias("part"), "val")

    def side(field, direction):
        return base.select("key", "part", F.col("val.lat").alias("lat"), F.col("val.lon").alias("lon"),
                           F.posexplode(f"val.{field}").alias("i", "nb")).select(
            "key", "lat", "lon", F.lit(direction).alias("direction"),
            (F.col("part") * chunk + F.col("i")).cast("bigint").alias("pos"),
            F.col("nb.id").alias("nb_id"), F.col("nb.lat").alias("nb_lat"), F.col("nb.lon").alias("nb_lon"),
            F.col("nb.weight").alias("weight"))

    return side("neighbors_out", "out").unionByName(side("neighbors_in", "in"))


def edge_flatten(docs: DataFrame, chunk: int = DOCUMENT_CHUNK) -> DataFrame:
    """Node documents → one edge row per out-list entry, with the coordinates of both ends and its place ``pos`` in the list."""
    return docs.select(F.col("key").alias("src"), F.col("val.lon").alias("src_lon"), F.col("val.lat").alias("src_lat"),
                       F.coalesce("part", F.lit(0)).alias("_part"),
                       F.posexplode("val.neighbors_out").alias("_i", "nb")).select(
        "src", "src_lon", "src_lat", F.col("nb.id").alias("dst"), F.col("nb.lon").alias("dst_lon"),
        F.col("nb.lat").alias("dst_lat"), F.col("nb.weight").alias("weight"),
        (F.col("_part").cast("bigint") * chunk + F.col("_i")).alias("pos"))


def document_nodes(docs: DataFrame) -> DataFrame:
    """``nodes(id, lat, lon)`` of a document table (string ids)."""
    return docs.select(F.col("key").alias("id"), F.col("val.lat").alias("lat"), F.col("val.lon").alias("lon")) \
        .dropDuplicates(["id"])


# ---------------------------------------------------------------- edge tables

def collapse_edges(trips: DataFrame, policy: str = "last", order: str = "seq") -> DataFrame:
    """A5: one edge per ordered pair; ``last`` keeps the weight of the highest ``order`` (the change order, or the list
    position ``pos`` of ``edge_flatten``), ``min`` the least weight."""
    if policy == "last":
        w = F.max_by("weight", order)
    elif policy == "min":
        w = F.min("weight")
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return trips.groupBy("src", "dst").agg(w.alias("weight"))


def edge_state(rows: DataFrame) -> DataFrame:
    """Edge rows with their change order → mergeable edge state.

    ``rows(seq, src, dst, weight, src_lon, src_lat, dst_lon, dst_lat)``; the state keeps the last weight
    (``last_seq``) and the coordinates first seen (``first_seq``). Merging two states is the same aggregate,
    so a snapshot plus a batch of updates is ``edge_state(snapshot ∪ updates)``."""
    if "last_seq" not in rows.columns:
        rows = rows.withColumn("last_seq", F.col("seq")).withColumn("first_seq", F.col("seq"))
    # one min_by per number: a struct in the buffer would turn this into a sort aggregate
    return rows.groupBy("src", "dst").agg(
        F.max_by("weight", "last_seq").alias("weight"), F.max("last_seq").alias("last_seq"),
        *(F.min_by(c, "first_seq").alias(c) for c in COORDINATES), F.min("first_seq").alias("first_seq"),
    ).select(*EDGE_STATE)


def edge_upsert(state: DataFrame, updates: DataFrame) -> DataFrame:
    """A6 (edges): existing edge → new weight, coordinates untouched; new edge → added. One aggregate over both."""
    rows = updates.select("src", "dst", "weight", F.col("seq").alias("last_seq"), *COORDINATES,
                          F.col("seq").alias("first_seq"))
    return edge_state(state.select(*EDGE_STATE).unionByName(rows))


def node_state(rows: DataFrame) -> DataFrame:
    """Nodes first seen in edge rows: the source of a message before its target, earliest ``seq`` first."""
    if "first_seq" in rows.columns and "role" in rows.columns:
        pts = rows.select("id", "lon", "lat", "first_seq", "role")
    else:
        pts = node_points(rows)
    # the first change of each role is one hash aggregate (min_by skips rows whose order is null); nothing is computed with the order
    def when(role, c):
        return F.when(F.col("role") == role, F.col(c))

    g = pts.groupBy("id").agg(*(x for r in (0, 1) for x in (
        F.min(when(r, "first_seq")).alias(f"seq{r}"), F.min_by("lon", when(r, "first_seq")).alias(f"lon{r}"),
        F.min_by("lat", when(r, "first_seq")).alias(f"lat{r}"))))
    source = F.col("seq0").isNotNull() & (F.col("seq1").isNull() | (F.col("seq0") <= F.col("seq1")))
    return g.select("id", *(F.when(source, F.col(f"{c}0")).otherwise(F.col(f"{c}1")).alias(n)
                            for c, n in (("lon", "lon"), ("lat", "lat"), ("seq", "first_seq"))),
                    F.when(source, 0).otherwise(1).alias("role"))


def node_points(updates: DataFrame) -> DataFrame:
    """Both ends of edge rows as ``(id, lon, lat, first_seq, role)``."""
    return updates.select(F.col("src").alias("id"), F.col("src_lon").alias("lon"), F.col("src_lat").alias("lat"),
                          F.col("seq").alias("first_seq"), F.lit(0).alias("role")).unionByName(
        updates.select(F.col("dst").alias("id"), F.col("dst_lon").alias("lon"), F.col("dst_lat").alias("lat"),
                       F.col("seq").alias("first_seq"), F.lit(1).alias("role")))


def node_upsert(nodes: DataFrame, updates: DataFrame) -> DataFrame:
    """A6 (nodes): a node keeps its position; an id first seen in an update is created from it. One aggregate over both."""
    return node_state(nodes.select("id", "lon", "lat", "first_seq", "role").unionByName(node_points(updates)))


def pending_changes(updates: DataFrame, published_seq) -> DataFrame:
    """Changes not yet in the published snapshot."""
    p = updates.filter(F.col("seq") > F.lit(published_seq))
    return p.agg(F.count(F.lit(1)).alias("pending"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


def what_if_reweight(edges: DataFrame, scenario: DataFrame) -> DataFrame:
    """``abs(weight + inc)`` for the scenario's edges, others unchanged."""
    s = scenario.groupBy("src", "dst").agg(F.sum("inc").alias("inc"))
    return edges.join(s, ["src", "dst"], "left").select(
        "src", "dst", F.abs(F.col("weight") + F.coalesce("inc", F.lit(0))).alias("weight"),
        F.col("inc").isNotNull().alias("changed"))


def what_if_unknown(edges: DataFrame, scenario: DataFrame) -> DataFrame:
    """Scenario edges that are not in the graph (the reference treats them as an error)."""
    return scenario.select("src", "dst").distinct().join(edges.select("src", "dst"), ["src", "dst"], "left_anti")
