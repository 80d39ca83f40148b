"""A table with one row per key, kept as full versions plus deltas.

``<base>/full/v=N`` holds every row, one folder ``b=<bucket>`` per hash bucket of ``bucket_by``; ``<base>/delta/v=N`` holds the rows
changed by version N, small enough for plain files. A change writes its own rows only; a reader takes the newest full version, opens
the buckets it needs, and puts the later rows in place. Of several rows of a key the one of the newest version counts, or,
with ``order``, the one highest in that column, so rows may arrive late. Every ``compact_every`` deltas a full version is
written. A version that is written again (a retried batch) replaces itself; readers give the version they want, so a
retry never sees its own earlier try.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from pathlattice.sources import snapshot as S


@dataclass
class KeyedTable:
    spark: SparkSession
    base: str
    keys: Sequence[str]
    bucket_by: Sequence[str]
    buckets: int = 32
    compact_every: int = 10
    order: str | None = None

    def _path(self, kind: str, version: int | None = None) -> str:
        return f"{self.base.rstrip('/')}/{kind}" + ("" if version is None else f"/v={int(version)}")

    def versions(self, upto: int | None = None) -> list[tuple[int, str]]:
        """Complete ``(version, kind)`` pairs, ascending; at one version the delta precedes the full version."""
        out = [(v, kind) for kind in ("delta", "full") for v in S.versions(self.spark, self._path(kind))]
        return sorted(x for x in out if upto is None or x[0] <= upto)

    def bucket(self):
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, version: int) -> None:
        """A full version."""
        # one exchange by bucket, so that a version has few files; a large bucket is split by size
        rows.withColumn("b", self.bucket()).hint("rebalance", "b").write.mode("overwrite").partitionBy("b") \
            .parquet(self._path("full", version))

    def change(self, rows: DataFrame, version: int) -> list[int]:
        """Write the changed rows of ``version``, compacting when enough deltas have come together; the buckets changed (a set that
        the same job collects, at most ``buckets`` numbers)."""
        seen = Observation()
        rows.withColumn("b", self.bucket()).observe(seen, F.collect_set("b").alias("b")).write.mode("overwrite") \
            .parquet(self._path("delta", version))
        have = self.versions(version)
        full = max((v for v, kind in have if kind == "full"), default=None)
        deltas = [v for v, kind in have if kind == "delta" and (full is None or v > full)]
        if len(deltas) >= self.compact_every:
            self.write(self.read(version), version)
            self.drop_before(2)
        return sorted(seen.get["b"])

    def delta(self, version: int) -> DataFrame:
        """The rows that one version changed."""
        return self.spark.read.parquet(self._path("delta", version)).drop("b")

    def drop_before(self, keep_full: int) -> None:
        """Delete what no reader of the newest ``keep_full`` full versions needs."""
        full = [v for v, kind in self.versions() if kind == "full"]
        if len(full) <= keep_full:
            return
        oldest = full[-keep_full]
        for v, kind in self.versions():
            if v < oldest or (v == oldest and kind == "delta"):
                S.delete(self.spark, self._path(kind, v))

    def read(self, upto: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The newest row of every key as of version ``upto``, of the given buckets; None before the first version."""
        have = self.versions(upto)
        if not have:
            return None
        full = max((v for v, kind in have if kind == "full"), default=None)
        deltas = [v for v, kind in have if kind == "delta" and (full is None or v > full)]

        def some(df):
            return df if buckets is None else df.filter(F.col("b").isin(list(buckets)))

        base = None
        if full is not None:
            base = self.spark.read.parquet(self._path("full", full))
            base = some(base).drop("b") if "b" in base.columns else base  # a version without rows has no bucket
        if not deltas:
            return base
        later = some(self.spark.read.option("basePath", self._path("delta")).parquet(
            *(self._path("delta", v) for v in deltas))).drop("b")
        keys = list(self.keys)
        rest = None
        if base is not None:
            changed = later.select(*keys).distinct() if self.order else later.select(*keys)
            rest = base.join(changed, keys, "left_anti")
            if self.order:  # the full version's row may be the higher one
                later = later.unionByName(base.join(changed, keys, "left_semi").withColumn("v", F.lit(full)))
        newest = Window.partitionBy(*keys).orderBy(F.desc(self.order or "v"), F.desc("v"))
        later = later.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n", "v")
        return later if rest is None else rest.unionByName(later)
