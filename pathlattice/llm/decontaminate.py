"""Benchmark decontamination: documents that hold a benchmark item, exactly or with up to a quarter of its words edited.

Texts and items are sequences of normalised words (lower-cased, split at every ASCII byte that is no letter or digit), compared by
64-bit word hashes. An item of n words is found where some window of a text is within ``tau = n // 4`` word edits
(insert, delete, replace) of it: a similarity of at least 0.75. Items of under 8 words must match exactly; items of under
``MIN_WORDS`` words say nothing about a leak and are not looked for.

Method: an item of n words within tau edits keeps at least ``n - 1 - 2 tau`` of its word pairs, in at most n + tau words. Stretches of
a text that hold so many pairs of a class of items (of similar length), and then of one item, are compared by exact edit distance, so
every item within tau edits is found, whatever the edits.

Scale: one pass over the texts without a shuffle; the benchmark goes along with the tasks in slices of at most ``SLICE_BYTES``
of text, one pass per slice, so its size has no limit either.

Cases: null or empty texts and items match nothing; equal items are each reported; a repeated document row is
reported as often as it is there; null ids are carried along; empty tables give an empty result; other columns are ignored by
``find_leaks`` and kept by ``remove_leaks``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm import textvec as tv
from pathlattice.llm.common import free_name, map_arrow

U = np.uint64
EDITS = 0.25
MIN_WORDS, MIN_FUZZY = 5, 8
CLASS_RATIO = 1.1
SLICE_BYTES = 8 << 20
ENTRIES = 1 << 22  # (pair, item) entries counted at a time


def tau(n: int) -> int:
    return int(n * EDITS) if n >= MIN_FUZZY else 0


def pair_hash(h: np.ndarray) -> np.ndarray:
    return tv.mix(h[:-1] * U(3) + h[1:])


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Smallest edit distance between ``item`` and any stretch of ``text``, and where the best stretch ends."""
    grid = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, w in enumerate(item, 1):
        best = np.minimum(row[1:] + 1, row[:-1] + (text != w))
        row = np.concatenate([[i], best])
        row = np.minimum.accumulate(row - grid) + grid
    end = int(row.argmin())
    return int(row[end]), end


@dataclass
class Class:
    """Items of similar length and their word pairs."""
    need: int          # item word pairs that every match keeps
    span: int          # words in which they lie
    pairs: np.ndarray  # sorted hashes of the items' word pairs
    first: np.ndarray  # the items with pair i are ``owner[first[i]:first[i + 1]]``
    owner: np.ndarray


def needed(n):
    """Word pairs that an item of n words keeps under ``tau`` edits, and the words in which they lie then."""
    return n - 1 - 2 * tau(n), n + tau(n)


def build_classes(items: list[np.ndarray]) -> list[Class]:
    by: dict[int, list[int]] = {}
    for i, w in enumerate(items):
        if len(w) >= MIN_WORDS:
            exact = len(w) < MIN_FUZZY
            by.setdefault(-len(w) if exact else int(math.log(len(w)) / math.log(CLASS_RATIO)), []).append(i)
    out = []
    for _, members in sorted(by.items()):
        hashes = [np.unique(pair_hash(items[i])) for i in members]
        flat, owner = np.concatenate(hashes), np.repeat(np.array(members), [len(x) for x in hashes])
        order = np.argsort(flat, kind="stable")
        pairs, first = np.unique(flat[order], return_index=True)
        limits = [needed(len(items[i])) for i in members]
        out.append(Class(min(x for x, _ in limits), max(x for _, x in limits), pairs, np.append(first, len(flat)), owner[order]))
    return out


@dataclass
class Index:
    """All classes, and which of them each word pair belongs to."""
    classes: list[Class]
    marked: np.ndarray  # by the top 20 bits of a pair's hash: whether any class may have it
    pairs: np.ndarray
    member: np.ndarray  # [pair, class]
    need: np.ndarray    # of each item, see ``needed``
    span: np.ndarray

    @classmethod
    def of(cls, items: list[np.ndarray]) -> Index:
        classes = build_classes(items)
        pairs = np.unique(np.concatenate([np.zeros(0, U), *(c.pairs for c in classes)]))
        marked = np.zeros(1 << 20, bool)
        marked[pairs >> U(44)] = True
        return cls(classes, marked, pairs, np.stack([np.isin(pairs, c.pairs) for c in classes], axis=1)
                   if classes else np.zeros((0, 0), bool),
                   *np.array([needed(len(w)) for w in items], np.int64).reshape(-1, 2).T)

    def hits(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of word pairs of any class, and the rows of ``member`` there."""
        at = np.flatnonzero(self.marked[pairs >> U(44)])
        row = np.minimum(np.searchsorted(self.pairs, pairs[at]), len(self.pairs) - 1)
        ok = self.pairs[row] == pairs[at]
        return at[ok], self.member[row[ok]]


def class_hits(c: Class, hit: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Those of the class's word pairs (at ``hit``) that stand in some ``span`` words of one text with ``need`` of them."""
    last = np.arange(c.need - 1, len(hit))
    first = last - (c.need - 1)
    ok = (hit[last] + 2 - hit[first] <= c.span) & (doc[hit[first]] == doc[hit[last]])
    # every hit of a span that may be one, from ``span`` words before the last needed hit to as many behind the first
    low = np.searchsorted(hit, hit[last[ok]] + 2 - c.span, "left")
    high = np.searchsorted(hit, hit[first[ok]] + c.span, "left")
    mark = np.zeros(len(hit) + 1, np.int64)
    np.add.at(mark, low, 1)
    np.add.at(mark, high, -1)
    return hit[np.cumsum(mark[:-1]) > 0]


def item_regions(c: Class, hit: np.ndarray, pair: np.ndarray, need: np.ndarray, span: np.ndarray, b: tv.Block, doc: np.ndarray):
    """``item, text, first word, end`` of the regions in which an item of the class may be; ``pair`` are the hits' pairs."""
    row = np.searchsorted(c.pairs, pair)
    count = c.first[row + 1] - c.first[row]
    part = np.cumsum(count) // ENTRIES
    # cut between texts only
    part = part[np.searchsorted(doc[hit], doc[hit], "left")]
    for k in np.unique(part):
        mine = np.flatnonzero(part == k)
        n = count[mine]
        at = np.repeat(c.first[row[mine]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        item, place = c.owner[at], np.repeat(hit[mine], n)
        order = np.argsort(item, kind="stable")  # places stay in order
        item, place = item[order], place[order]
        last = np.arange(len(item)) + need[item] - 1
        first = np.flatnonzero(last < len(item))
        last = last[first]
        ok = (item[first] == item[last]) & (doc[place[first]] == doc[place[last]]) & (place[last] + 2 - place[first] <= span[item[first]])
        item, first, last = item[first[ok]], place[first[ok]], place[last[ok]]
        if not len(item):
            continue
        text = doc[first]
        low = np.maximum(last + 2 - span[item], b.word_off[text])
        high = np.minimum(first + span[item], b.word_off[text + 1])
        fresh = np.ones(len(item), bool)
        fresh[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (low[1:] > high[:-1])
        begin = np.flatnonzero(fresh)
        yield from zip(item[begin].tolist(), text[begin].tolist(), low[begin].tolist(),
                       np.maximum.reduceat(high, begin).tolist())


def leaks_of_block(b: tv.Block, items: list[np.ndarray], index: Index) -> dict[tuple[int, int], tuple[int, int]]:
    """``(text, item) -> (distance, first word of the region it was found in)``, the smallest distance found."""
    h = b.hashes()
    found: dict[tuple[int, int], tuple[int, int]] = {}
    if len(h) < 2 or not index.classes:
        return found
    doc = np.repeat(np.arange(len(b)), b.words_per_text)
    pairs = np.where(doc[:-1] == doc[1:], pair_hash(h), U(0))  # 0 over a text's end
    at, member = index.hits(pairs)
    for k, c in enumerate(index.classes):
        hit = class_hits(c, at[member[:, k]], doc)
        if not len(hit):
            continue
        for i, d, lo, hi in item_regions(c, hit, pairs[hit], index.need, index.span, b, doc):
            n = len(items[i])
            if found.get((d, i), (1,))[0] == 0:
                continue
            dist, _ = edit_distance(items[i], h[lo:hi])
            if dist <= tau(n) and dist < found.get((d, i), (n,))[0]:
                found[d, i] = (dist, lo - int(b.word_off[d]))
    return found


def item_words(texts: list[str]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for b in tv.blocks(pa.array(texts, pa.string()), space=tv.NOT_ALNUM):
        h = b.hashes()
        out += [h[i:j] for i, j in zip(b.word_off[:-1], b.word_off[1:])]
    return out


def slices(benchmark: DataFrame):
    """The benchmark in parts of about ``SLICE_BYTES`` of text each: item ids and word hashes."""
    able = benchmark.select("item_id", F.lower("text").alias("text")).filter("text IS NOT NULL")
    size = able.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // SLICE_BYTES))
    for k in range(n):
        rows = able.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        yield [r["item_id"] for r in rows], item_words([r["text"] for r in rows])


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, distance, item_words, near_word`` for each document row and item found in it."""
    doc_type, item_type = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {doc_type}, item_id {item_type}, distance int, item_words int, near_word bigint"
    out = None
    for ids, items in slices(benchmark):
        index = Index.of(items)
        id_array = pa.array(ids, pa.int64() if item_type in ("bigint", "int") else pa.string())

        def run(batches, items=items, index=index, id_array=id_array):
            for batch in batches:
                for b in tv.blocks(batch.column("text"), space=tv.NOT_ALNUM):
                    found = leaks_of_block(b, items, index)
                    d, i = [x for x, _ in found], [y for _, y in found]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array([b.lo + x for x in d], pa.int64())),
                         id_array.take(pa.array(i, pa.int64())),
                         pa.array([v for v, _ in found.values()], pa.int32()),
                         pa.array([len(items[y]) for y in i], pa.int32()),
                         pa.array([v for _, v in found.values()], pa.int64())],
                        names=["doc_id", "item_id", "distance", "item_words", "near_word"])

        part = map_arrow(docs.select("doc_id", F.lower("text").alias("text")), run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def remove_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no benchmark item is found, without a shuffle."""
    low = free_name(docs, "_lower")
    for _, items in slices(benchmark):
        index = Index.of(items)

        def run(batches, items=items, index=index):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for b in tv.blocks(batch.column(low), space=tv.NOT_ALNUM):
                    for d, _ in leaks_of_block(b, items, index):
                        clean[b.lo + d] = False
                yield batch.filter(pa.array(clean)).drop_columns([low])

        docs = map_arrow(docs.withColumn(low, F.lower("text")), run, docs.schema)
    return docs
