"""Trip CSV source (S1, S2) and type normalisation with a quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.schemas import TRIP_COLUMNS

# Column order of the normalised trip table.
TRIP_TABLE = ["trip_id", "src", "dst", "weight", "src_lat", "src_lon", "dst_lat", "dst_lon"]

_RENAME = {
    "duration_sec": "weight",
    "start_station_id": "src",
    "start_station_latitude": "src_lat",
    "start_station_longitude": "src_lon",
    "end_station_id": "dst",
    "end_station_latitude": "dst_lat",
    "end_station_longitude": "dst_lon",
}
_WHOLE = ("duration_sec", "start_station_id", "end_station_id")


def read_trips_raw(spark: SparkSession, path: str, order_col: str | None = None) -> DataFrame:
    """The seven trip columns and the trip order ``trip_id``, all as strings; other columns are not read.

    ``order_col``: a column of the file that gives the trip order. The usual seven-column file has none; its trips are
    ordered by file, byte offset of the split, and place in the split, which is the order of the lines."""
    # Columns are matched by header name (files may carry more columns, in any order); all are read as
    # strings, so nothing is inferred and P3 decides what is valid. Only the selected columns are parsed.
    raw = spark.read.option("header", True).csv(path)
    if order_col is not None:
        return raw.select(F.col(order_col).alias("trip_id"), *TRIP_COLUMNS)
    place = F.format_string("%s|%020d|%020d", "_metadata.file_path", "_metadata.file_block_start",
                            F.monotonically_increasing_id())
    return raw.select(place.alias("trip_id"), *TRIP_COLUMNS)


def _whole_number(c: str):
    """``5`` and ``5.0`` (how a column with gaps is often written) as a bigint; anything else is null."""
    text = F.trim(F.col(c))
    number = text.try_cast("double")
    return F.coalesce(text.try_cast("bigint"),
                      F.when((F.floor(number) == number) & (F.abs(number) < 2.0 ** 53), number.cast("bigint")))


def normalize_trips(raw: DataFrame, order_col: str | None = None) -> DataFrame:
    """Typed trips plus ``valid``; ids and seconds are whole numbers, coordinates doubles. ``order_col``: as for the read;
    with it the trip order is a number, else the text key of the line's place.

    Rows with a missing or malformed field, or a negative duration, keep ``valid = false`` (quarantine) instead of
    failing the job."""
    typed = [_whole_number("trip_id").alias("trip_id") if order_col is not None else F.col("trip_id")]
    for c in TRIP_COLUMNS:
        typed.append((_whole_number(c) if c in _WHOLE else F.col(c).try_cast("double")).alias(_RENAME[c]))
    t = raw.select(*typed)
    valid = F.col("weight") >= 0
    for c in TRIP_TABLE:
        valid = valid & F.col(c).isNotNull()
    return t.withColumn("valid", F.coalesce(valid, F.lit(False)))


def read_trips(spark: SparkSession, path: str, order_col: str | None = None) -> DataFrame:
    """S1 + P3: the valid trips ``(trip_id, src, dst, weight, src_lat, src_lon, dst_lat, dst_lon)``."""
    return normalize_trips(read_trips_raw(spark, path, order_col), order_col) \
        .filter("valid").select(*TRIP_TABLE)


def quarantine(trips: DataFrame) -> DataFrame:
    return trips.filter(~F.col("valid"))


# Caps up to this many rows use a top-n merge in one task; larger caps number the rows in parallel.
TAKE_ORDERED_MAX = 100_000


def row_cap(trips: DataFrame, n: int) -> DataFrame:
    """The first ``n`` trips in trip order; a negative ``n`` keeps all (the cap is exact).

    A small cap is a top-n (each task keeps its first ``n``, one task merges them). A large cap would make that
    merge hold ``n`` rows per partition, so the rows are numbered by the skew-safe ``rank_in_group`` over one
    constant group (split into range blocks when large) and filtered instead."""
    if n < 0:
        return trips
    if n <= TAKE_ORDERED_MAX:
        return trips.orderBy("trip_id").limit(n)
    from pathlattice.operators.sequence import rank_in_group
    ranked = rank_in_group(trips.withColumn("_all", F.lit(0)), ["_all"], ["trip_id"], "_rn")
    return ranked.filter(F.col("_rn") <= n).drop("_all", "_rn")
