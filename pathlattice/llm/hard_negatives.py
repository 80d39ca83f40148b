"""Hard-negative mining with rotated one-bit codes, deterministic score intervals and exact integer scores.

Every vector of whole numbers is turned by one fixed rotation; of the turned vector ``o`` the signs are kept as a code ``x`` (unit length, one bit a
dimension), and with it ``a = <x, o>``, the vector's alignment with its code, and ``r``, the length of what the code leaves over. An anchor ``q``,
turned alike and rounded to bit planes, has ``s = <x, q>`` by popcounts of code and planes. Then, by Cauchy-Schwarz,

    | <q, o> - a s |  <=  r * sqrt(|q|^2 - s^2),        and the rounding of ``q`` by ``e`` moves ``s`` by at most ``|e|``,

so each score lies in a known interval, without probabilities. A row whose interval cannot reach the anchor's present best is
never scored; the others are scored in whole numbers, so the result is exact.

Distribution: rows go once to one of ``groups`` groups (a fixed size, at least the cluster's parallelism); anchors, a
hundredth of the rows, go to every group in blocks behind its rows. A task holds one group and streams the anchors past it. Two
passes: positives (rows of the anchor's label), then negatives, whose bands come from the positives of all groups. Each group
answers with its few best, and a window per anchor (and positive) merges them; no step holds all rows or all anchors.

Cases: rows with a null id, label or vector, or a null or non-finite component, take no part. Vectors of different lengths are compared as
if the shorter one ended in zeros; an empty vector scores 0. A row is "another" row if its id differs; repeated rows count each. An
anchor without positives has no row in the result, nor has a positive without a negative in its band (always so below score 0). Labels
may be as skewed as they like: groups are made without regard to them. Components and scores beyond 64 bits are held at the limit. An empty
table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathlattice.llm.common import map_arrow, stage

SCALE = 256
GROUP_ROWS = 1 << 18
ANCHOR_BLOCK = 256
ROW_BLOCK = 2048
PLANES = 6
PAIRS = 1 << 16
GROUP_VALUES = 1 << 24
SEED = 20_240_521
LIMIT = 2**63 - 1


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """Sign codes of rows with alignment and residual, for intervals of their scores."""

    def __init__(self, f: np.ndarray):
        dim = f.shape[1]
        turned = f @ rotation(dim)
        bits = turned >= 0
        words = -(-dim // 64)
        wide = np.zeros((len(f), words * 64), bool)
        wide[:, :dim] = bits
        self.words = np.packbits(wide, axis=1, bitorder="little").view(np.uint64).reshape(len(f), words)
        self.ones = bits.sum(axis=1).astype(np.float64)
        self.align = np.abs(turned).sum(axis=1) / np.sqrt(dim)
        square = (f * f).sum(axis=1)
        self.size = np.sqrt(square)
        self.rest = np.sqrt(np.maximum(square - self.align ** 2, 0))


class Planes:
    """Turned anchors, each rounded to ``PLANES`` bits a dimension, as bit planes."""

    def __init__(self, f: np.ndarray):
        dim = f.shape[1]
        turned = f @ rotation(dim)
        self.low = turned.min(axis=1)
        span = turned.max(axis=1) - self.low
        self.step = np.where(span > 0, span / (2**PLANES - 1), 1.0)
        level = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, 2**PLANES - 1).astype(np.int64)
        rounded = self.low[:, None] + self.step[:, None] * level
        self.error = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
        self.total = rounded.sum(axis=1)
        self.square = (f * f).sum(axis=1)
        self.dim = dim
        words = -(-dim // 64)
        wide = np.zeros((PLANES, len(f), words * 64), bool)
        wide[:, :, :dim] = (level[None] >> np.arange(PLANES)[:, None, None]) & 1
        self.planes = np.packbits(wide, axis=2, bitorder="little").view(np.uint64).reshape(PLANES, len(f), words)

    def interval(self, c: Codes, rows: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the score of each anchor of ``which`` with each row of ``rows``."""
        count = np.zeros((len(which), len(rows)), np.int32)
        for w in range(c.words.shape[1]):
            code = c.words[rows, w]
            for p in range(PLANES):
                count += np.bitwise_count(self.planes[p, which, w][:, None] & code[None]).astype(np.int32) << p
        low, step = self.low[which, None], self.step[which, None]
        s = (2 * (low * c.ones[rows][None] + step * count) - self.total[which, None]) / np.sqrt(self.dim)
        err = self.error[which, None]
        off_code = np.sqrt(np.maximum(self.square[which, None] - np.maximum(np.abs(s) - err, 0) ** 2, 0))
        # the last term covers the rounding of this very sum
        half = (c.align[rows] * err + c.rest[rows] * off_code
                + 1e-9 * (1 + c.size[rows] * np.sqrt(self.square[which, None])))
        mid = c.align[rows] * s
        return mid - half, mid + half


class Numbers:
    """Vectors of whole numbers with exact inner products: in doubles where they hold every sum, in 64 bits, else in Python's numbers."""

    def __init__(self, m: np.ndarray):
        self.m, self.f = m, m.astype(np.float64)
        self.most = float(np.abs(self.f).max(initial=0))

    def scores(self, which: np.ndarray, other: "Numbers", rows: np.ndarray, wanted: np.ndarray):
        """Scores of the pairs that ``wanted (which x rows)`` marks, held inside 64 bits: positions in both, and the scores.

        Where much is wanted, one product of the whole block is cheaper than picking the pairs."""
        bound = self.m.shape[1] * self.most * other.most
        p, r = np.nonzero(wanted)
        if bound < 2**53 and 8 * len(p) > wanted.size:
            return p, r, (self.f[which] @ other.f[rows].T)[p, r].astype(np.int64)
        if bound < 2**53:
            parts = [np.einsum("ij,ij->i", self.f[which[p[i:i + PAIRS]]], other.f[rows[r[i:i + PAIRS]]]).astype(np.int64)
                     for i in range(0, len(p), PAIRS)]
        elif bound < 2**62:
            parts = [np.einsum("ij,ij->i", self.m[which[p[i:i + PAIRS]]], other.m[rows[r[i:i + PAIRS]]])
                     for i in range(0, len(p), PAIRS)]
        else:
            a, b = self.m[which].tolist(), other.m[rows].tolist()
            parts = [np.array([min(max(sum(x * y for x, y in zip(a[i], b[j])), -LIMIT), LIMIT)
                               for i, j in zip(p.tolist(), r.tolist())], np.int64)]
        return p, r, np.concatenate([np.zeros(0, np.int64), *parts])


def first_of(key: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each key, by higher points and then smaller id; sorted by key and rank."""
    order = np.lexsort((ids, -points, key))
    key = key[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    rank = np.arange(len(key)) - np.repeat(start, np.diff(np.r_[start, len(key)]))
    return order[rank < k]


def padded(vecs: list[np.ndarray], dim: int) -> np.ndarray:
    out = np.zeros((len(vecs), dim), np.int64)
    for row, v in zip(out, vecs):
        row[:min(len(v), dim)] = v[:dim]  # what the others lack counts nothing
    return out


class Group:
    """The rows of one group in memory, sorted by label: ids, labels, vectors and their codes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vecs: list[np.ndarray]):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.dim = max([len(v) for v in vecs] + [1])
        self.numbers = Numbers(padded([vecs[i] for i in order.tolist()], self.dim))
        self.codes = Codes(self.numbers.f)

    def search(self, anchors: "Anchors", which: np.ndarray, lo: int, hi: int, barred, k: int):
        """First ``k`` rows of ``lo:hi`` for each anchor of ``which`` and each of its bands, without those that ``barred``
        marks: positions in ``which``, bands, rows, scores.

        A row is scored only if its interval reaches a band and is not surely below the ``k`` best there so far."""
        numbers, planes = anchors.at(self.dim)
        low, high = anchors.low[which], anchors.high[which]  # anchors x bands
        bands = low.shape[1]
        least = low.astype(np.float64) - 1 - np.abs(low) * 1e-9
        most = high.astype(np.float64) + 1 + np.abs(high) * 1e-9
        key, row, points = (np.zeros(0, np.int64) for _ in range(3))
        for a in range(lo, hi, ROW_BLOCK):
            rows = np.arange(a, min(a + ROW_BLOCK, hi))
            down, up = planes.interval(self.codes, rows, which)
            down, up = np.minimum(down, LIMIT), np.maximum(up, -LIMIT)  # as scores are held
            out = barred(which, rows)
            if bands == 1 and a == lo and len(rows) >= k:
                # k other rows surely score so much, if they are in the band at all
                sure = np.where(out | (down < least) | (up > most), -np.inf, down)
                least = np.maximum(least, np.partition(sure, len(rows) - k, axis=1)[:, len(rows) - k, None])
            floor, ceiling = least.min(axis=1), most.max(axis=1)
            maybe = (up >= floor[:, None]) & (down <= ceiling[:, None])
            p, r, s = numbers.scores(which, self.numbers, rows, maybe & ~out)
            fit = (s >= floor[p]) & (s <= ceiling[p])
            p, r, s = p[fit], rows[r[fit]], s[fit]
            for j in range(bands):
                ok = (s >= low[p, j]) & (s <= high[p, j])
                key, row, points = np.r_[key, p[ok] * bands + j], np.r_[row, r[ok]], np.r_[points, s[ok]]
            keep = first_of(key, points, self.ids[row], k)
            key, row, points = key[keep], row[keep], points[keep]
            full, at, n = np.unique(key, return_index=True, return_counts=True)
            kth = np.full(least.size, -np.inf)
            kth[full[n == k]] = points[at[n == k] + k - 1]
            least = np.maximum(least, kth.reshape(least.shape))
        return key // bands, key % bands, row, points


class Anchors:
    """A block of anchors with the score bands that they look for."""

    def __init__(self, ids, labels, vecs, low, high):
        self.ids, self.labels, self.vecs, self.low, self.high = ids, labels, vecs, low, high
        self._at: dict[int, tuple[Numbers, Planes]] = {}

    def at(self, dim: int) -> tuple[Numbers, Planes]:
        if dim not in self._at:
            numbers = Numbers(padded(self.vecs, dim))
            self._at[dim] = numbers, Planes(numbers.f)
        return self._at[dim]


def positives(group: Group, anchors: Anchors, k: int):
    """First rows of each anchor's label with another id."""
    for label in np.unique(anchors.labels):
        which = np.flatnonzero(anchors.labels == label)
        lo, hi = np.searchsorted(group.labels, [label, label + 1])
        p, _, row, points = group.search(anchors, which, lo, hi,
                                         lambda w, r: anchors.ids[w][:, None] == group.ids[r][None], k)
        yield which[p], np.zeros(len(p), np.int64), row, points


def negatives(group: Group, anchors: Anchors, k: int):
    """First rows of other labels in each band of an anchor."""
    which = np.arange(len(anchors.ids))
    p, band, row, points = group.search(anchors, which, 0, len(group.ids),
                                        lambda w, r: anchors.labels[w][:, None] == group.labels[r][None], k)
    yield p, band, row, points


def whole_rows(vectors: DataFrame, label=None) -> DataFrame:
    """``vec_id, label, vec`` (whole numbers) of the rows that take part; ``label``: an expression in place of the label."""
    def gap(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    v = F.col("embedding").cast("array<double>")
    return vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(~F.exists(v, gap)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col("label") if label is None else label).cast("bigint").alias("label"),
        F.transform(v, lambda x: F.floor(x * SCALE)).alias("vec"))


def against_all(rows: DataFrame, anchors: DataFrame, groups: int, find, k: int) -> DataFrame:
    """``akey, band, id, points``: the first ``k`` rows of every group for each anchor of
    ``anchors (akey, vec_id, label, vec, low, high)`` and band, by ``find``."""
    both = rows.select(F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("kind"),
                       F.lit(0).cast("bigint").alias("akey"), "vec_id", "label", "vec",
                       *(F.array().cast("array<bigint>").alias(c) for c in ("low", "high"))).unionByName(
        anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("kind"), "akey",
                       "vec_id", "label", "vec", "low", "high"))

    def lists(col):
        off = np.asarray(col.offsets)
        flat = np.asarray(col.values)
        return [flat[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]

    def block(waiting):
        low, high = (np.stack(lists(pa.concat_arrays([b.column(c) for b in waiting]))) for c in ("low", "high"))
        ids, labels, akey = (np.concatenate([np.asarray(b.column(c)) for b in waiting]) for c in ("vec_id", "label", "akey"))
        return akey, Anchors(ids, labels, [v for b in waiting for v in lists(b.column("vec"))], low, high)

    def answer(group, waiting):
        for width in sorted({len(x) for b in waiting for x in lists(b.column("low"))}):
            some = [b.filter(pc.equal(pc.list_value_length(b.column("low")), width)) for b in waiting]
            akey, anchors = block([b for b in some if b.num_rows])
            for p, band, row, points in find(group, anchors, k):
                yield pa.RecordBatch.from_arrays([pa.array(akey[p]), pa.array(band, pa.int32()), pa.array(group.ids[row]),
                                                  pa.array(points)], names=["akey", "band", "id", "points"])

    def run(batches):
        held, group, waiting = [], None, []
        for batch in batches:
            is_row = np.asarray(batch.column("kind")) == 0
            if is_row.any():
                held.append(batch.filter(pa.array(is_row)))
            if is_row.all():
                continue
            if group is None and held:
                group = Group(*(np.concatenate([np.asarray(b.column(c)) for b in held]) for c in ("vec_id", "label")),
                              [v for b in held for v in lists(b.column("vec"))])
                held = []
            if group is None:  # no rows in this group
                continue
            rest = batch.filter(pa.array(~is_row))
            for i in range(0, rest.num_rows, ANCHOR_BLOCK):
                waiting.append(rest.slice(i, ANCHOR_BLOCK))
                if sum(b.num_rows for b in waiting) >= ANCHOR_BLOCK:
                    yield from answer(group, waiting)
                    waiting = []
        if waiting:
            yield from answer(group, waiting)

    placed = both.repartitionById(groups, "g").sortWithinPartitions("kind").drop("g")
    return map_arrow(placed, run, "akey bigint, band int, id bigint, points bigint")


def mine(spark: SparkSession, vectors: DataFrame, label=None, anchor_every: int = 100, n_positives: int = 5, n_negatives: int = 5,
         low_percent: int = 80, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vectors (vec_id, embedding, label)``.

    Anchors: ids divisible by ``anchor_every``. Positives: its first ``n_positives`` other rows of its label. Negatives: for each
    positive the first ``n_negatives`` rows of other labels with ``low_percent * positive <= 100 * negative <= 100 * positive``."""
    rows = stage(spark, whole_rows(vectors, label), "vectors")
    n, values = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vec")), F.lit(0))).first()
    groups = max(spark.sparkContext.defaultParallelism, -(-n // group_rows), -(-values // GROUP_VALUES))
    anchors = stage(spark, rows.filter(F.col("vec_id") % anchor_every == 0).withColumn("akey", F.monotonically_increasing_id()),
                    "anchors")
    limits = anchors.withColumn("low", F.array(F.lit(-LIMIT))).withColumn("high", F.array(F.lit(LIMIT)))
    order = Window.partitionBy("akey").orderBy(F.desc("points"), "id")
    found = stage(spark, against_all(rows, limits, groups, positives, n_positives).withColumn("r", F.row_number().over(order))
                  .filter(F.col("r") <= n_positives).select("akey", "r", F.col("id").alias("positive_id"),
                                                            F.col("points").alias("positive_score")), "positives")
    p = F.col("positive_score")
    # ceil(low_percent * p / 100) in whole numbers that stay inside 64 bits
    q, rest = F.floor(p / 100), F.pmod(p, F.lit(100))
    q = (p - rest).cast("decimal(20,0)") / 100
    least = (q.cast("decimal(20,0)") * low_percent + F.ceil(rest * low_percent / 100)).cast("bigint")
    bands = found.groupBy("akey").agg(F.array_sort(F.collect_list(F.struct("r", least.alias("low"), p.alias("high")))).alias("b"))
    banded = anchors.join(bands, "akey").select("akey", "vec_id", "label", "vec", F.col("b.low").alias("low"),
                                                F.col("b.high").alias("high"))
    order = Window.partitionBy("akey", "band").orderBy(F.desc("points"), "id")
    some = against_all(rows, banded, groups, negatives, n_negatives).withColumn("rank", F.row_number().over(order)) \
        .filter(F.col("rank") <= n_negatives).withColumn("r", F.col("band") + 1)
    return some.join(found, ["akey", "r"]).join(anchors.select("akey", F.col("vec_id").alias("anchor_id")), "akey").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("points").alias("negative_score"))
