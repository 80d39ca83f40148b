"""Ranked result files: text lines ``total n0 w0 … nk`` (K2) and their scan.

A publish holds ``lines`` (text, ``query_id``, a tab, the line) and ``status`` (one row per query with its number of lines), so a
query without a path and a query that was not computed differ, an empty result reads as an empty table, and the number of files
follows the data, not the number of queries. ``export_query_text`` writes one query's plain lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.functions.messages import line_total


def write_results_text(results: DataFrame, path: str, queries: DataFrame | None = None) -> str:
    """K2 (text): sorted lines; the range sort keeps the work spread out. ``queries (query_id)``: the queries that were
    answered, with or without a path (default: those with a line)."""
    (results.select("query_id", "total", "line")
     .repartitionByRange("query_id", "total", "line")
     .sortWithinPartitions("query_id", "total", "line")
     .select(F.concat_ws("\t", F.col("query_id").cast("string"), "line").alias("value"))
     .write.mode("overwrite").text(f"{path}/lines"))
    counts = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_lines"))
    asked = counts.select("query_id") if queries is None else queries.select("query_id").distinct()
    asked.join(counts, "query_id", "left").select("query_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines")) \
        .write.mode("overwrite").parquet(f"{path}/status")
    return path


def write_results_parquet(results: DataFrame, path: str) -> str:
    """K2 (Parquet): the typed rows, for readers that want columns."""
    results.write.mode("overwrite").parquet(path)
    return path


def read_results_text(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, total, line)`` of a text publish; an empty result gives an empty table. Ids have the type that the
    publish had (its status table knows)."""
    parts = F.split("value", "\t", 2)
    id_type = read_status(spark, path).schema["query_id"].dataType
    rows = spark.read.schema("value string").text(f"{path}/lines").filter(F.trim("value") != "").select(
        parts[0].cast(id_type).alias("query_id"), F.trim(parts[1]).alias("line"))
    return rows.select("query_id", line_total("line").alias("total"), "line")


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, n_lines)`` of every query that the publish answered."""
    return spark.read.parquet(f"{path}/status")


def export_query_text(results: DataFrame, query_id, path: str) -> str:
    """One query's lines, sorted, as plain text."""
    (results.filter(F.col("query_id") == query_id).repartitionByRange("total", "line")
     .sortWithinPartitions("total", "line").select("line").write.mode("overwrite").text(path))
    return path
