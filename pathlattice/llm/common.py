"""What the operators share: reading a table, lineage cuts, folds by id, sums over a key space too large for one task."""

from __future__ import annotations

import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pathlattice
from pathlattice.session import scratch_path

# A side may be broadcast only when its counted rows times their width stay below this.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: cuts the lineage, so a lost
    executor repeats one step, and a costly step runs once for several uses. The exchanges behind the written table are
    not read again, so Spark deletes their files when the write ends instead of some time later."""
    path = scratch_path(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def drop(*staged: DataFrame) -> None:
    """Delete tables that ``stage`` wrote and no later step reads."""
    for df in staged:
        drop_folder(df.sparkSession, df.staged_at)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that no later step reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if not any(x.startswith("pathlattice") for x in sc._python_includes):
        root = Path(pathlattice.__file__).parent
        # Spark serves the file from the driver's folder while the application lives
        target = f"{tempfile.mkdtemp(prefix='pathlattice-code-')}/pathlattice.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(target)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` whose tasks give their memory back when they end, as Python workers live on for other stages."""
    ship(df.sparkSession)

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory of this Python process to the system: Arrow's pool and the C heap."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the jobs started inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small_batches(spark: SparkSession, rows: int):
    """Jobs started inside hand their rows to Python in Arrow batches of at most ``rows``: for rows that are large each."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold(doc_id, mod: int):
    """crc32 of the id as text, modulo ``mod`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(mod)


def held_out(doc_id, mod: int, remainder: int):
    """Whether the id falls in the held-out fold; a null id does not, and is not learned from either."""
    return F.coalesce(fold(doc_id, mod) == remainder, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark a side for broadcast when its counted size is within ``BROADCAST_BYTES``; beyond it, Spark's shuffle
    join (with AQE's skew handling) is used. Both give the same rows."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def partitions_for(spark: SparkSession, rows: int, per_partition: int) -> int:
    """Number of partitions that keeps each below ``per_partition`` rows, at least the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_partition))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a, b)``: ``(node, component)``, the smallest node of each component.

    Alternating large-star and small-star rounds: in a large star every node passes its smallest neighbour (or
    itself) to its larger neighbours, in a small star to its smaller ones. Edges never outgrow the input, a hub's edges are
    rows of a join (split by AQE when skewed) and never one group in a task. Every round is written to the shared
    folder. It stops when a round changes nothing. Nodes without an edge to another node are not in the result.
    """
    e = stage(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .distinct(), "cc")

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    last = mark(e)
    while last[0]:
        sym = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sym.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"),
                                                                  F.least("a", "m").alias("m"))
        large = sym.join(low, sym.a == low.n).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small_star = large.join(low, large.a == low.n).select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        before, e = e, stage(spark, small_star.filter("a <> b").distinct(), "cc")
        drop(before)
        now = mark(e)
        if tuple(now) == tuple(last):
            break
        last = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
