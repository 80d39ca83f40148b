"""Graph snapshots: node documents as JSON lines (K1 sink, S3/S4 scans) and the seed map document.

A snapshot is written into a new version folder ``<base>/v=<version>``; readers take the highest version
that carries Spark's ``_SUCCESS`` marker, so a reader never sees a half-written snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathlattice.schemas import NODE_DOCUMENT, NODE_VALUE, SEED_MAP

_DOC_WITH_PART = T.StructType(NODE_DOCUMENT.fields + [T.StructField("part", T.IntegerType())])
_DOC_TOLERANT = T.StructType(_DOC_WITH_PART.fields + [T.StructField("_corrupt_record", T.StringType())])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def numbered(spark: SparkSession, base: str, prefix: str, complete: bool = False) -> list[int]:
    """Numbers of the folders ``<base>/<prefix>N``, ascending; with ``complete`` those with Spark's ``_SUCCESS`` marker only."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            if not complete or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[len(prefix):]))
    return sorted(out)


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Completed snapshot versions under ``base``, ascending."""
    return numbered(spark, base, "v=", complete=True)


def drop_versions(spark: SparkSession, base: str, keep: int) -> None:
    """Delete all but the newest ``keep`` complete versions."""
    for v in versions(spark, base)[:-keep]:
        delete(spark, f"{base.rstrip('/')}/v={v}")


def write_snapshot(docs: DataFrame, base: str, version: int) -> str:
    """K1: ``{"key", "part", "val"}`` lines (``part`` counts the lines of a node), in a new version folder."""
    path = f"{base.rstrip('/')}/v={int(version)}"
    docs.select("key", "part", "val").write.mode("overwrite").json(path)
    return path


def latest_path(spark: SparkSession, base: str) -> str | None:
    v = versions(spark, base)
    return f"{base.rstrip('/')}/v={v[-1]}" if v else None


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """S3: node documents with an explicit schema; JSON lines (never multi-line)."""
    return spark.read.schema(_DOC_WITH_PART).json(path).select("key", "part", "val")


def read_snapshot_tolerant(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(documents, quarantine)``. Malformed lines go to the quarantine; a key (and part) repeated
    in the files keeps its last line: by file, then place of the split in the file, then line in the split, so a file that is
    read in several splits keeps its own order whichever task reads which. A key on many lines sends one line per task (a window limit)."""
    raw = (spark.read.schema(_DOC_TOLERANT).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
           .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
           # the number inside the split: what counts on from the task's first line
           .withColumn("_line", F.monotonically_increasing_id()))
    bad = raw.filter(F.col("_corrupt_record").isNotNull() | F.col("key").isNull() | F.col("val").isNull())
    good = raw.filter(F.col("_corrupt_record").isNull() & F.col("key").isNotNull() & F.col("val").isNotNull())
    newest = Window.partitionBy("key", "_p").orderBy(F.desc("_file"), F.desc("_start"), F.desc("_line"))
    last = good.withColumn("_p", F.coalesce("part", F.lit(0))).withColumn("_n", F.row_number().over(newest)) \
        .filter("_n = 1").select("key", "part", "val")
    return last, bad.select("_file", "_corrupt_record")


def load_seed_map(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object ``{id: node}`` (a small bootstrap file) → node documents."""
    text = spark.read.option("wholetext", True).text(path)
    m = text.select(F.from_json("value", SEED_MAP).alias("m"))
    return m.select(F.explode("m").alias("key", "val")).select(
        "key", F.lit(None).cast("int").alias("part"), F.col("val").cast(NODE_VALUE).alias("val"))


# ---------------------------------------------------------------- versioned edge tables (base + deltas)
#
# ``<base>/full/v=N`` holds a complete edge state, ``<base>/delta/v=N`` only the edges changed by publish N.
# ``<base>/progress/v=N`` holds the last message offset per partition that version N holds.
# A publish writes a delta (its size is the change, not the graph); every few publishes a full version is
# compacted. Readers take the newest full version and merge the later deltas into it.

def edge_versions(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """Completed ``(version, kind)`` pairs, ascending; kind is ``full`` or ``delta``."""
    out = [(v, "full") for v in versions(spark, f"{base.rstrip('/')}/full")]
    out += [(v, "delta") for v in versions(spark, f"{base.rstrip('/')}/delta")]
    return sorted(out)


def write_edge_full(state: DataFrame, base: str, version: int) -> None:
    state.write.mode("overwrite").parquet(f"{base.rstrip('/')}/full/v={int(version)}")


def write_edge_delta(changes: DataFrame, base: str, version: int) -> None:
    """``changes``: edge-state rows of the edges changed since the previous version."""
    changes.write.mode("overwrite").parquet(f"{base.rstrip('/')}/delta/v={int(version)}")


def write_progress(progress: DataFrame, base: str, version: int) -> None:
    """Written before the version itself, so a complete version has its progress."""
    progress.select("partition", "offset").coalesce(1).write.mode("overwrite").parquet(f"{base.rstrip('/')}/progress/v={int(version)}")


def read_progress(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The messages that ``version`` (default: newest) holds; None where no progress was kept."""
    vs = [v for v in versions(spark, f"{base.rstrip('/')}/progress") if version is None or v <= version]
    return spark.read.parquet(f"{base.rstrip('/')}/progress/v={vs[-1]}") if vs else None


def edges_changed(spark: SparkSession, base: str, since: int, version: int) -> DataFrame | None:
    """``(src, dst)`` of the edges whose weight differs between two versions; None where the deltas between are gone."""
    vs = edge_versions(spark, base)
    between = sorted({v for v, _ in vs if since < v <= version})
    deltas = {v for v, kind in vs if kind == "delta"}
    if not all(v in deltas for v in between) or not any(kind == "full" and v <= since for v, kind in vs):
        return None
    if not between:
        return read_edge_table(spark, base, version).select("src", "dst").limit(0)
    keys = spark.read.parquet(*(f"{base.rstrip('/')}/delta/v={v}" for v in between)).select("src", "dst").distinct()
    old = read_edge_table(spark, base, since).join(keys, ["src", "dst"], "left_semi").select("src", "dst", F.col("weight").alias("_old"))
    now = read_edge_table(spark, base, version).join(keys, ["src", "dst"], "left_semi")
    return now.join(old, ["src", "dst"], "left").filter(~F.col("weight").eqNullSafe(F.col("_old"))).select("src", "dst")


def apply_deltas(full: DataFrame, deltas: DataFrame) -> DataFrame:
    """Merge changed edges into a full edge state without aggregating the whole table.

    Unchanged edges pass through an anti join with the changed keys, changed ones are re-aggregated with
    their old row (a semi join); the changed-key side is small and AQE broadcasts it by measured size."""
    from pathlattice.operators.graph import edge_state
    cols = full.columns
    d = edge_state(deltas.select(*cols)).select(*cols)
    keys = d.select("src", "dst")
    kept = full.join(keys, ["src", "dst"], "left_anti")
    touched = full.join(keys, ["src", "dst"], "left_semi")
    return kept.unionByName(edge_state(touched.unionByName(d)).select(*cols))


def read_edge_table(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The edge state as of ``version`` (default: newest)."""
    vs = edge_versions(spark, base)
    if version is not None:
        vs = [x for x in vs if x[0] <= version]
    full_v = max(v for v, kind in vs if kind == "full")
    full = spark.read.parquet(f"{base.rstrip('/')}/full/v={full_v}")
    later = [v for v, kind in vs if kind == "delta" and v > full_v]
    if not later:
        return full
    paths = [f"{base.rstrip('/')}/delta/v={v}" for v in later]
    return apply_deltas(full, spark.read.parquet(*paths).select(*full.columns))
