"""Tables a map view needs: node layer, edge layer (with label and arrow positions) and the path overlay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathlattice.functions.geometry import direction_anchors, edge_key, midpoint


def node_layer(nodes: DataFrame) -> DataFrame:
    """L1: ``(id, lon, lat)``."""
    return nodes.select("id", "lon", "lat")


def new_nodes(nodes: DataFrame, shown: DataFrame) -> DataFrame:
    """L1 append: nodes not yet on the layer."""
    return nodes.join(shown.select("id"), "id", "left_anti").select("id", "lon", "lat")


def edge_layer(edges: DataFrame) -> DataFrame:
    """L2: ``(key, src, dst, src_lon, src_lat, dst_lon, dst_lat, weight)``, one row per ``src-dst``."""
    return edges.select(edge_key("src", "dst").alias("key"), "src", "dst", "src_lon", "src_lat",
                        "dst_lon", "dst_lat", "weight")


def edge_midpoints(layer: DataFrame) -> DataFrame:
    """P10: weight label position."""
    return layer.select("key", midpoint(F.col("src_lon"), F.col("dst_lon")).alias("mid_lon"),
                        midpoint(F.col("src_lat"), F.col("dst_lat")).alias("mid_lat"), "weight")


def edge_anchors(layer: DataFrame) -> DataFrame:
    """Arrow anchor points."""
    lon1, lon2 = direction_anchors(F.col("src_lon"), F.col("dst_lon"))
    lat1, lat2 = direction_anchors(F.col("src_lat"), F.col("dst_lat"))
    return layer.select("key", lon1.alias("a_lon"), lat1.alias("a_lat"), lon2.alias("b_lon"), lat2.alias("b_lat"))


def map_anchor(nodes: DataFrame) -> DataFrame:
    """Where the total of the shown path is written (min lon, max lat)."""
    return nodes.agg(F.min("lon").alias("lon"), F.max("lat").alias("lat"))


def path_overlay(layer: DataFrame, path_hops: DataFrame) -> DataFrame:
    """Edge layer with the shown path's edges flagged and carrying the path's weight; others reset."""
    ph = path_hops.groupBy("src", "dst").agg(F.max("weight").alias("path_weight"))
    return layer.join(ph, ["src", "dst"], "left").select(
        "key", "src", "dst", F.coalesce("path_weight", "weight").alias("weight"),
        F.col("path_weight").isNotNull().alias("on_path"))


def path_node_layer(path_node_ids: DataFrame, nodes: DataFrame) -> DataFrame:
    """Coordinates of the path's nodes (``pos`` kept)."""
    return path_node_ids.join(nodes.select("id", "lon", "lat"), "id")


def off_graph_hops(path_hops: DataFrame, edges: DataFrame) -> DataFrame:
    """Hops of a path that are not edges of the shown graph."""
    return path_hops.join(edges.select("src", "dst"), ["src", "dst"], "left_anti")


def resolve_coordinates(endpoints: DataFrame, nodes: DataFrame) -> DataFrame:
    """An endpoint's position from the node table when the node exists, else the message's."""
    n = nodes.select("id", F.col("lon").alias("n_lon"), F.col("lat").alias("n_lat"), F.lit(True).alias("known"))
    keep = [c for c in endpoints.columns if c not in ("lon", "lat")]
    return endpoints.join(n, "id", "left").select(
        *keep, F.coalesce("n_lon", "lon").alias("lon"), F.coalesce("n_lat", "lat").alias("lat"),
        F.coalesce("known", F.lit(False)).alias("known"))
