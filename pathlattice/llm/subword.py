"""Hashed word and character n-gram features, and the scoring of whole texts with a learned linear table.

A text's features are its words, the character n-grams inside each word and, if asked, its adjacent word pairs, each
hashed into ``buckets`` cells. In every model here a text is the mean of its features' vectors followed by a linear
layer, so scoring needs one number per cell and class (vector times layer): a word adds up its cells once per block, a text adds
up its words. Whole texts are read, in blocks of bounded memory (textvec).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm import textvec as tv
from pathlattice.llm.common import held_out, map_arrow

U = np.uint64
SAMPLE_MOD = 1 << 20


@dataclass(frozen=True)
class Features:
    grams: tuple[int, ...] = (3, 4, 5)
    pairs: bool = False     # adjacent word pairs; a word followed by itself is one feature of its own
    lower: bool = False
    buckets: int = 1 << 18


def distinct_words(b: tv.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of each word, and byte span of each distinct word."""
    codes, uniq = pd.factorize(b.hashes())
    first = np.empty(len(uniq), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, b.start[first], b.end[first]


def word_cells(b: tv.Block, start: np.ndarray, end: np.ndarray, f: Features):
    """Per feature kind: cells and their ranges per span."""
    yield ((tv.span_hash(b.prefix, start, end) ^ U(0x51ED270B)) % U(f.buckets)).astype(np.int64), \
        np.arange(len(start) + 1)
    if f.grams:
        chars = tv.char_starts(b)
        for n in f.grams:
            h, off = tv.char_grams(b, chars, start, end, n)
            yield (h % U(f.buckets)).astype(np.int64), off


def pair_cells(b: tv.Block, f: Features) -> tuple[np.ndarray, np.ndarray]:
    """Cells of adjacent word pairs and their ranges per text."""
    h = b.hashes()
    n = np.maximum(b.words_per_text - 1, 0)
    off = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(b.word_off[:-1] - off[:-1], n) + np.arange(off[-1])
    same = h[at] == h[at + 1]
    pair = tv.mix(h[at] * U(3) + h[at + 1])
    return np.where(same, 0, (pair % U(f.buckets)).astype(np.int64)), off


def sparse_rows(b: tv.Block, f: Features):
    """Per text its distinct cells and their counts."""
    codes, start, end = distinct_words(b)
    doc = np.repeat(np.arange(len(b)), b.words_per_text)
    keys = []
    for cells, off in word_cells(b, start, end, f):
        n = np.diff(off)[codes]
        at = np.repeat(off[:-1][codes] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        keys.append(np.repeat(doc, n) * f.buckets + cells[at])
    if f.pairs:
        cells, off = pair_cells(b, f)
        keys.append(np.repeat(np.arange(len(b)), np.diff(off)) * f.buckets + cells)
    uniq, count = np.unique(np.concatenate(keys), return_counts=True)
    cut = np.searchsorted(uniq, np.arange(len(b) + 1) * f.buckets)
    cell = (uniq % f.buckets).astype(np.int32)
    return [(cell[i:j], count[i:j].astype(np.float32)) for i, j in zip(cut[:-1], cut[1:])]


def text_scores(b: tv.Block, f: Features, cells_table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: sum over its features of their rows of ``cells_table`` [buckets, classes], and the feature count."""
    if not len(b.start):
        return np.zeros((len(b), cells_table.shape[1]), np.float32), np.zeros(len(b), np.int64)
    codes, start, end = distinct_words(b)
    total = np.zeros((len(start), cells_table.shape[1]), np.float32)
    count = np.zeros(len(start), np.int64)
    for cells, off in word_cells(b, start, end, f):
        total += tv.sums_by(cells_table[cells], off)
        count += np.diff(off)
    sums = tv.sums_by(total[codes].astype(np.float64), b.word_off)
    n = tv.sums_by(count[codes], b.word_off)
    if f.pairs:
        cells, off = pair_cells(b, f)
        sums = sums + tv.sums_by(cells_table[cells].astype(np.float64), off)
        n = n + np.diff(off)
    return sums, n


@dataclass
class Sample:
    """Feature rows of the learning sample, its classes, and the class shares of all labelled rows."""
    rows: list[tuple[np.ndarray, np.ndarray]]
    y: np.ndarray
    classes: list
    share: np.ndarray


def learning_sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, mod: int, remainder: int,
                    bound: int, f: Features) -> Sample:
    """At most about ``bound`` labelled rows per class outside the held-out fold, drawn by a hash of the id.

    ``labels (doc_id, <label>)``: rows with a null id or label are left out; of several labels of one id, all count.
    Only the drawn ids (a bounded number) are broadcast to find their texts; only their feature rows reach the driver."""
    able = labels.select("doc_id", F.col(label).alias("_y")).filter("doc_id IS NOT NULL AND _y IS NOT NULL") \
        .filter(~held_out("doc_id", mod, remainder))
    counts = {r["_y"]: r["n"] for r in able.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}  # per class
    classes = sorted(counts)
    cut = F.lit(0)
    for c in classes:
        cut = F.when(F.col("_y") == F.lit(c), F.lit(int(min(1.0, bound / counts[c]) * SAMPLE_MOD))).otherwise(cut)
    drawn = able.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_MOD)) < cut)
    picked = docs.select("doc_id", "text").join(F.broadcast(drawn.distinct()), "doc_id").select("text", "_y")
    kind = picked.schema["_y"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            col, y = batch.column("text"), batch.column("_y")
            for b in tv.blocks(col, f.lower):
                rows = sparse_rows(b, f)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.tobytes() for c, _ in rows], pa.binary()),
                     pa.array([n.tobytes() for _, n in rows], pa.binary()), y.slice(b.lo, len(b))],
                    names=["cells", "counts", "_y"])

    got = map_arrow(picked, run, f"cells binary, counts binary, _y {kind}").toArrow()
    ys = got.column("_y").to_pylist()
    rows = [(np.frombuffer(c, np.int32), np.frombuffer(n, np.float32))
            for c, n in zip(got.column("cells").to_pylist(), got.column("counts").to_pylist())]
    order = sorted(range(len(ys)), key=lambda i: (str(ys[i]), len(rows[i][0]), rows[i][0].tobytes(), rows[i][1].tobytes()))  # as the tasks ended, else
    total = sum(counts.values())
    return Sample([rows[i] for i in order], np.array([classes.index(ys[i]) for i in order], np.int64), classes,
                  np.array([counts[c] / total for c in classes]))


class Batches:
    """Mini-batches of sparse mean rows, with the transposed order of each for the gradient of the cells."""

    def __init__(self, rows, y, size: int, seed: int, scale: float):
        order = np.random.RandomState(seed).permutation(len(rows))
        self.parts = []
        for lo in range(0, len(order), size):
            ids = [i for i in order[lo:lo + size] if len(rows[i][0])]
            if not ids:
                continue
            n = np.array([len(rows[i][0]) for i in ids])
            cells = np.concatenate([rows[i][0] for i in ids])
            w = np.concatenate([rows[i][1] * np.float32(scale / rows[i][1].sum()) for i in ids])
            doc = np.repeat(np.arange(len(ids)), n)
            by = np.argsort(cells, kind="stable")
            sorted_cells = cells[by]
            first = np.flatnonzero(np.r_[True, sorted_cells[1:] != sorted_cells[:-1]])
            self.parts.append((cells, w, np.cumsum(n) - n, by, first, sorted_cells[first], doc, y[ids]))

    def __iter__(self):
        return iter(self.parts)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_embeddings(sample: Sample, f: Features, dim: int = 8, epochs: int = 30, batch: int = 64, rate: float = 0.3,
                     scale: float = 30.0, decay: float = 1e-6, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings and softmax layer by mini-batch gradient descent (AdaGrad steps) on the mean feature vector.

    Returns the cell table [buckets, classes] (embedding times layer times ``scale``) and the bias, corrected from the
    sample's class shares to those of all labelled rows."""
    rng = np.random.RandomState(seed)
    k = len(sample.classes)
    emb = rng.uniform(-1, 1, (f.buckets, dim)).astype(np.float32) / dim
    emb *= 0.1
    out = (rng.uniform(-1, 1, (dim, k)) / np.sqrt(dim)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    g_emb, g_out, g_bias = np.full(f.buckets, 1e-6, np.float32), np.full_like(out, 1e-6), np.full_like(bias, 1e-6)
    batches = Batches(sample.rows, sample.y, batch, seed, scale)
    freq = np.bincount(sample.y, minlength=k).astype(np.float64)
    for _ in range(epochs):
        for cells, w, off, by, first, touched, doc, y in batches:
            mean = np.add.reduceat(emb[cells] * w[:, None], off, axis=0)
            err = softmax(mean @ out + bias)
            err[np.arange(len(y)), y] -= 1
            err /= len(y)
            d_mean = err @ out.T
            d_cell = np.add.reduceat(d_mean[doc[by]] * w[by][:, None], first, axis=0) + decay * emb[touched]
            d_out, d_bias = mean.T @ err, err.sum(axis=0)
            g_emb[touched] += (d_cell ** 2).mean(axis=1)
            g_out += d_out ** 2
            g_bias += d_bias ** 2
            emb[touched] -= rate * d_cell / np.sqrt(g_emb[touched])[:, None]
            out -= rate * d_out / np.sqrt(g_out)
            bias -= rate * d_bias / np.sqrt(g_bias)
    bias = bias + np.log(np.maximum(sample.share, 1e-12)) - np.log(np.maximum(freq, 1) / max(freq.sum(), 1))
    return (emb @ out * np.float32(scale)).astype(np.float32), bias


def score_texts(docs: DataFrame, f: Features, cells_table: np.ndarray, columns: str,
                finish: Callable[[np.ndarray, np.ndarray, object], list], keep: tuple[str, ...]) -> DataFrame:
    """Score every whole text: ``keep`` columns, then ``columns`` (a schema string) made by ``finish(mean, n, batch)``
    from the mean cell rows [texts, classes] (zero without features) and the feature counts."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    shared = docs.sparkSession.sparkContext.broadcast(cells_table)  # its size is fixed by the buckets

    def run(batches):
        for batch in batches:
            for b in tv.blocks(batch.column("text"), f.lower):
                rows = batch.slice(b.lo, len(b))
                sums, n = text_scores(b, f, shared.value)
                mean = sums / np.maximum(n, 1)[:, None]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), *finish(mean, n, rows)],
                                                 names=[*keep, *(c.split()[0] for c in columns.split(", "))])

    return map_arrow(docs.select(*dict.fromkeys([*keep, "text"])), run, f"{kinds}, {columns}")
