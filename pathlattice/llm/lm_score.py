"""Language-model scoring by deleted interpolation.

A text is its words (ASCII lower-cased) and one end token. Each token w after context v (the word before it, or the start) gets

    P(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1),

maximum-likelihood estimates of the bigram, the unigram and the uniform model, mixed with weights that depend on the bucket b of the
context's count c(v) (powers of two). Counts come from all training texts. The weights are learned by expectation-maximisation on the
training texts of one fold (``EM_FOLD``), each with its own counts deleted from the model first, so every token is predicted as if its
text had not been seen. A context never seen has weight on the unigram and the uniform model only.

Scale: texts are cut into chunks of about ``CHUNK_TOKENS`` tokens, stored as word codes. A chunk's distinct words and word pairs go packed to shards of the key
space and their exact corpus counts come back (``counting``), so the exchange grows with the distinct n-grams of the chunks, and no task
holds a vocabulary. The fold for the weights has chunks of its own; its statistics reach the driver as a histogram
of (bucket, bigram estimate, unigram estimate) with a fixed number of cells.

Cases: a null or empty text is the end token alone; a null id is held out of training and not marked as held out; repeated rows count and are
scored each; without training texts all counts are 0 and the weight is on the uniform model; an empty table gives an empty
result; other columns are ignored. Words are told apart by 63-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm import textvec as tv
from pathlattice.llm.common import fold, map_arrow, small_batches, stage
from pathlattice.llm.counting import by_chunk, from_planes, key_sums, planes, put_together, rows_of

U = np.uint64
ODD = U(1)
END, START = U(0x3C6EF372FE94F82B) | ODD, U(0x1B873593CC9E2D51) | ODD
CHUNK_TOKENS = 1_000_000
TEXT_ROWS = 1000  # texts in one Arrow batch
SLICE_TOKENS = 250_000
PACKED = ["chunk", "folds", "lengths", "words", "codes"]
EM_FOLD = 1
EM_ROUNDS = 60
BUCKETS = 26
STEPS = 4      # histogram cells per factor of two
LOWEST = 160   # cells of one estimate: down to 2^-40


def token_chunks(docs: DataFrame) -> DataFrame:
    """``chunk, ids, folds, lengths, words, codes``: texts as codes into the chunk's words (tokens with their end).

    Odd chunks hold the texts of the fold for the weights."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    class Open:
        """A chunk that is being filled; words get codes in order of appearance."""

        def __init__(self):
            self.ids, self.folds, self.lengths, self.keys, self.held = [], [], [], [], 0

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        open_chunks = {False: Open(), True: Open()}

        def flush(em):
            nonlocal seq
            c = open_chunks[em]
            codes, words = pd.factorize(np.concatenate(c.keys))
            open_chunks[em] = Open()
            seq += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([((part << 32) + seq) * 2 + em], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(c.lengths)], pa.int32()), pa.concat_arrays(c.ids)),
                 pa.array([np.concatenate(c.folds).tobytes()], pa.binary()),
                 pa.array([np.array(c.lengths, np.int64).tobytes()], pa.binary()),
                 pa.array([words.astype(U).tobytes()], pa.binary()), pa.array([planes(codes.astype(np.uint32))], pa.binary())],
                names=["chunk", "ids", "folds", "lengths", "words", "codes"])

        for batch in batches:
            for b in tv.blocks(batch.column("text"), lower=True):
                folds = np.array(batch.column("fold").slice(b.lo, len(b)).to_pylist(), np.int8)
                n = b.words_per_text + 1
                off = np.concatenate([[0], np.cumsum(n)])
                tokens = np.full(off[-1], END, U)
                inside = np.ones(off[-1], bool)
                inside[off[1:] - 1] = False
                tokens[inside] = b.hashes() | ODD
                ids = batch.column("doc_id").slice(b.lo, len(b))
                for em in (False, True):
                    mine = np.flatnonzero((folds == EM_FOLD) == em)
                    if not len(mine):
                        continue
                    c = open_chunks[em]
                    c.ids.append(ids.take(pa.array(mine)))
                    c.folds.append(folds[mine])
                    c.lengths += n[mine].tolist()
                    c.keys.append(tokens[np.repeat((folds == EM_FOLD) == em, n)])
                    c.held += int(n[mine].sum())
                    if c.held >= CHUNK_TOKENS:
                        yield flush(em)
        for em, c in open_chunks.items():
            if c.held:
                yield flush(em)

    texts = docs.select("doc_id", "text", F.coalesce(fold("doc_id", 10), F.lit(-1)).cast("int").alias("fold"))
    return map_arrow(texts, run, f"chunk bigint, ids array<{id_type}>, folds binary, lengths binary, "
                                 "words binary, codes binary")


class Chunk:
    """A stored chunk unpacked: tokens, word pairs and the sorted keys of both."""

    def __init__(self, row: dict):
        self.folds = np.frombuffer(row["folds"], np.int8)
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.off = np.concatenate([[0], np.cumsum(self.lengths)])
        self.words = np.frombuffer(row["words"], U)
        self.codes = from_planes(row["codes"], np.uint32)
        self.pair = np.empty(len(self.codes), U)
        self.pair[1:] = self.words[self.codes[:-1]]  # contexts
        self.pair[self.off[:-1]] = START
        self.pair *= U(3)
        self.pair += self.words[self.codes]
        self.pair = tv.mix(self.pair) & ~ODD
        self.distinct_pairs = np.unique(self.pair)
        self.keys = np.sort(np.concatenate([self.words, self.distinct_pairs, np.array([START])]))

    def training_weights(self) -> np.ndarray:
        train = np.repeat(self.folds > 0, self.lengths)
        out = np.zeros(len(self.keys), np.uint32)
        out[np.searchsorted(self.keys, self.words)] = np.bincount(self.codes[train], minlength=len(self.words))
        pair, count = np.unique(self.pair[train], return_counts=True)
        out[np.searchsorted(self.keys, pair)] = count
        out[np.searchsorted(self.keys, START)] = (self.folds > 0).sum()
        return out

    def slices(self, sums: np.ndarray):
        """Per run of documents of about ``SLICE_TOKENS``: the documents, the tokens' range, and corpus counts of each token, its
        context and their pair."""
        of_word = sums[np.searchsorted(self.keys, self.words)]
        of_pair = sums[np.searchsorted(self.keys, self.distinct_pairs)]
        of_start = sums[np.searchsorted(self.keys, START)]
        i, n = 0, len(self.lengths)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.off, self.off[i] + SLICE_TOKENS, "right")) - 1)
            a, b = int(self.off[i]), int(self.off[j])
            own = of_word[self.codes[a:b]]
            context = np.empty_like(own)
            context[1:] = own[:-1]
            context[self.off[i:j] - a] = of_start
            yield i, j, a, b, own, context, of_pair[np.searchsorted(self.distinct_pairs, self.pair[a:b])]
            i = j


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + the whole binary logarithm of its count."""
    return np.where(context > 0, np.minimum(1 + np.log2(np.maximum(context, 1)).astype(np.int64), BUCKETS - 1), 0)


def cell(p: np.ndarray) -> np.ndarray:
    """Histogram cell of an estimate; cell 0 is 0."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.clip(np.round(-np.log2(p) * STEPS), 0, LOWEST - 2), 0).astype(np.int64)


def cell_value(c: np.ndarray) -> np.ndarray:
    return np.where(c > 0, 2.0 ** (-(c - 1) / STEPS), 0.0)


def own_counts(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How often each entry's key occurs in its own document."""
    both = tv.mix(keys ^ tv.mix(doc.astype(U) + U(1)))
    codes, _ = pd.factorize(both)
    return np.bincount(codes)[codes]


def held_out_histogram(chunks: DataFrame, n_tokens: int) -> DataFrame:
    """``cell, n`` over all tokens of the fold for the weights, each text's own counts deleted."""
    def run(batches):
        for row in rows_of(batches, [*PACKED, "sums"]):
            c = Chunk(row)
            for i, j, a, b, own, context, pair in c.slices(put_together(row["sums"])):
                n = c.lengths[i:j]
                doc = np.repeat(np.arange(j - i), n)
                mine = own_counts(c.words[c.codes[a:b]], doc)
                before = np.ones_like(mine)
                before[1:] = mine[:-1]
                before[c.off[i:j] - a] = 1
                own, pair, context = own - mine, pair - own_counts(c.pair[a:b], doc), context - before
                rest = n_tokens - np.repeat(n, n)
                code = (bucket(context) * LOWEST + cell(pair / np.maximum(context, 1))) * LOWEST \
                    + cell(own / np.maximum(rest, 1))
                value, count = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(count)], names=["cell", "n"])

    return map_arrow(chunks, run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


def learn_weights(cells: np.ndarray, n: np.ndarray, uniform: float) -> np.ndarray:
    """Weights [bucket, (bigram, unigram, uniform)] by expectation-maximisation on the histogram."""
    b = cells // (LOWEST * LOWEST)
    p = np.stack([cell_value(cells // LOWEST % LOWEST), cell_value(cells % LOWEST), np.full(len(cells), uniform)], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    for _ in range(EM_ROUNDS):
        share = weights[b] * p
        share *= (n / share.sum(axis=1))[:, None]
        total = np.stack([np.bincount(b, weights=share[:, j], minlength=BUCKETS) for j in range(3)], axis=1)
        seen = total.sum(axis=1) > 0
        weights[seen] = total[seen] / total[seen].sum(axis=1, keepdims=True)
    # a bucket may have met no unseen word in the fold: the uniform model keeps a trace of weight everywhere
    return 0.9999 * weights + np.array([0, 0, 1e-4])


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs (doc_id, text)``."""
    with small_batches(spark, TEXT_ROWS):
        chunks = stage(spark, token_chunks(docs), "lm-chunks")
    with small_batches(spark, 1):  # a chunk is some 10 MB
        return stage(spark, scored(spark, chunks, docs.schema["doc_id"].dataType.simpleString()), "lm-scores")


def scored(spark: SparkSession, chunks: DataFrame, id_type: str) -> DataFrame:
    """The scores of the texts in ``chunks``."""
    def keys(row):
        c = Chunk(row)
        return c.keys, c.training_weights()

    n_keys = chunks.agg(F.sum(F.octet_length("codes"))).first()[0] or 0
    sums, totals = key_sums(spark, chunks.select(*PACKED), keys, n_keys // 5, "lm-sums")
    known = totals.agg(F.sum("n_keys").alias("v"), F.sum("total").alias("n")).first()
    starts = chunks.select("folds")
    trained = map_arrow(starts, lambda batches: (
        pa.RecordBatch.from_arrays([pa.array([int((np.frombuffer(x, np.int8) > 0).sum())
                                              for x in batch.column("folds").to_pylist()], pa.int64())], names=["n"])
        for batch in batches), "n bigint").agg(F.sum("n")).first()[0] or 0
    # the start marker was counted once per training text, as if it were a word
    n_train, v = (known["n"] or 0) - trained, (known["v"] or 0) - (1 if trained else 0)
    uniform = 1 / (v + 1)

    held = held_out_histogram(chunks.filter("chunk % 2 = 1").select(*PACKED).join(
        by_chunk(sums.filter("chunk % 2 = 1")), "chunk"), n_train).toPandas()
    weights = learn_weights(held["cell"].to_numpy(np.int64), held["n"].to_numpy(np.float64), uniform)

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            for i, row in enumerate(rows_of([batch], [*PACKED, "sums"])):
                c = Chunk(row)
                for lo, hi, a, b, own, context, pair in c.slices(put_together(row["sums"])):
                    w = weights[bucket(context)]
                    p = w[:, 0] * (pair / np.maximum(context, 1)) + w[:, 1] * (own / max(n_train, 1)) + w[:, 2] * uniform
                    base = np.log10((own + 0.1) / (n_train + 0.1 * (v + 1)))
                    off = c.off[lo:hi + 1] - a
                    yield pa.RecordBatch.from_arrays(
                        [ids[i].values.slice(lo, hi - lo), pa.array(c.folds[lo:hi] == 0), pa.array(c.lengths[lo:hi]),
                         pa.array(tv.sums_by((own > 0).astype(np.int64), off)), pa.array([n_train] * (hi - lo), pa.int64()),
                         pa.array(tv.sums_by(base, off)), pa.array(tv.sums_by(np.log10(p), off))],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return map_arrow(chunks.select("ids", *PACKED).join(by_chunk(sums), "chunk"), run,
                     f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                     "base_score double, score double")
