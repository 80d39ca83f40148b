"""Explicit schemas of the data model (no inference anywhere)."""

from pyspark.sql import types as T

# Trip CSV: the seven columns the graph is built from (the file may carry more).
TRIP_COLUMNS = [
    "duration_sec",
    "start_station_id",
    "start_station_latitude",
    "start_station_longitude",
    "end_station_id",
    "end_station_latitude",
    "end_station_longitude",
]

# Neighbor entry of a node document; fields in alphabetical order, as the documents are written.
NEIGHBOR = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("weight", T.LongType()),
])

NODE_VALUE = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("neighbors_in", T.ArrayType(NEIGHBOR)),
    T.StructField("neighbors_out", T.ArrayType(NEIGHBOR)),
])

# One JSON line per node: {"key": id, "val": {...}}
NODE_DOCUMENT = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("val", NODE_VALUE),
])

# Seed document: one JSON object keyed by node id.
SEED_MAP = T.MapType(T.StringType(), NODE_VALUE)

# Raw message rows with a total order and their place in the topic (null in files that do not carry it).
MESSAGE = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
])
