"""Filter interaction audit: what each filter removes, in every order of the filters, per part of the corpus.

Each document gets one bit per filter that it fails. The filters on one text (A to D) are found where the text lies. E, "identical to the
text of a smaller doc_id", is an existential self-join: a left-semi join on the text's hash, the exact text and a smaller id marks the
rows. Its other side holds one row per distinct text (the smallest id, aggregated before the exchange), only texts whose hash occurs with more than one
id are sent, and the rows of a text with many copies are salted. E's ids are united with the other failure ids, bits of
one document are or-ed, and documents are counted by part and combination of bits. All figures of all orders follow from
those counts, at most ``2 ** filters`` rows a part: the document of a combination is removed by the first of its filters in an order.

``shapley`` is a filter's removals summed over all orders: a combination of ``j`` filters gives each of them ``orders / j``.

Cases: a null text is empty (few words: fails A; B, C and D hold); a null source is the part ""; a null id is never smaller nor
larger, so it never fails E, and has no label; rows of equal id and text are counted each and none is smaller than the other; of several labels of an id,
any 1 counts; an empty table gives no row; other columns are ignored. Long texts are read in parts cut between words.
"""

from __future__ import annotations

import itertools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm import textvec as tv
from pathlattice.llm.common import map_arrow, small, stage

LETTERS = "ABCDE"
SALT_ROWS = 10_000  # rows of one hash in one task of the self-join
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in "#$%&*|"]] = True
_CAPITALS = np.zeros(256, bool)
_CAPITALS[65:91] = True


def text_failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, h, mask`` of ``docs (doc_id, part, h, text)``: bit 0 for under 50 words, bit 1 for few distinct words, bit 2 for many
    capitals, bit 3 for a symbol."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            words, distinct, capitals, points = (np.zeros(n, np.int64) for _ in range(4))
            marked = np.zeros(n, bool)
            open_: list[np.ndarray] = []  # word hashes of a long text so far
            for data, off, row, more in tv.parts(batch.column("text")):
                b = tv.parse(data, off)
                at = slice(row, row + len(b))
                words[at] += b.words_per_text
                capitals[at] += tv.sums_by(_CAPITALS[data].astype(np.int64), off)
                points[at] += tv.sums_by(((data & 0xC0) != 0x80).astype(np.int64), off)
                marked[at] |= tv.sums_by(_MARKS[data].astype(np.int64), off) > 0
                h = b.hashes()
                if more or open_:
                    open_.append(np.unique(h))
                    if not more:
                        distinct[row] = len(np.unique(np.concatenate(open_)))
                        open_ = []
                    continue
                text = np.repeat(np.arange(len(b)), b.words_per_text)
                order = np.lexsort((h, text))
                h, text = h[order], text[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                distinct[at] = np.bincount(text[new], minlength=len(b))
            mask = ((words < 50) + 2 * (100 * distinct < 65 * words) + 4 * (100 * capitals > 5 * points) + 8 * marked)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "part", "h")), pa.array(mask, pa.int32())],
                                             names=["doc_id", "part", "h", "mask"])

    return map_arrow(docs.select("doc_id", "part", "h", "text"), run, f"doc_id {id_type}, part string, h bigint, mask int")


def copies(spark: SparkSession, docs: DataFrame, seen: DataFrame, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``doc_id, part, h`` of the rows of ``docs (doc_id, part, h, text)`` whose text a smaller id has too. ``seen (doc_id, h)``: all rows."""
    twice = stage(spark, seen.filter("doc_id IS NOT NULL").groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .filter("lo < hi").select("h", F.ceil(F.col("n") / salt_rows).cast("int").alias("n_salt")), "audit-hashes")
    some = docs.filter("doc_id IS NOT NULL").join(small(twice, twice.count(), 16), "h")
    first = some.groupBy("h", "text").agg(F.min("doc_id").alias("first_id"), F.first("n_salt").alias("n_salt")) \
        .select("h", "text", "first_id", F.explode(F.sequence(F.lit(0), F.col("n_salt") - 1)).alias("salt"))
    rows = some.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("n_salt")).cast("int")).alias("a")
    f = first.alias("f")
    same = (F.col("a.h") == F.col("f.h")) & (F.col("a.salt") == F.col("f.salt")) & (F.col("a.text") == F.col("f.text"))
    return rows.join(f, same & (F.col("f.first_id") < F.col("a.doc_id")), "left_semi").select("doc_id", "part", "h")


def combinations(spark: SparkSession, docs: DataFrame, labels: DataFrame, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and failed filters, and those of them labelled quality 1 and toxic 1."""
    texts = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    base = stage(spark, text_failures(texts), "audit-failures")
    same = copies(spark, texts, base, salt_rows)
    bits = base.withColumn("n", F.lit(1).cast("bigint")).unionByName(
        same.withColumn("mask", F.lit(1 << LETTERS.index("E"))).withColumn("n", F.lit(0).cast("bigint")))
    marked = bits.groupBy("doc_id", "h", "part").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return marked.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")))


def audit(combos: DataFrame, letters: str = LETTERS) -> DataFrame:
    """All orders of the filters over ``combos (part, mask, n, good, toxic)``; bit ``i`` of ``mask`` is the filter ``letters[i]``.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    orders = ["".join(p) for p in itertools.permutations(letters)]
    steps = [{"o": o, "s": i + 1, "b": sum(1 << letters.index(c) for c in o[:i]), "f": 1 << letters.index(o[i])}
             for o in orders for i in range(len(letters))]
    # at most 2 ** filters entries a part
    parts = combos.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("l"))
    rows = parts.select("part", "l", F.explode(F.from_json(
        F.lit(json.dumps(steps)), "array<struct<o:string,s:int,b:int,f:int>>")).alias("x")).select("part", "l", "x.*")

    def total(keep, value):
        return F.aggregate(F.filter("l", keep), F.lit(0).cast("bigint"), lambda acc, e: acc + value(e))

    def fails(e, column):
        return e["mask"].bitwiseAND(F.col(column)) != 0

    def first(e):
        return fails(e, "f") & ~fails(e, "b")

    def count(e):
        return e["n"]

    return rows.select(
        "part", F.col("o").alias("filter_order"), F.col("s").alias("step"),
        total(lambda e: ~fails(e, "f") & ~fails(e, "b"), count).alias("kept"),
        total(first, count).alias("removed"),
        total(lambda e: fails(e, "f") & fails(e, "b"), count).alias("redundant"),
        total(lambda e: e["mask"] == F.col("f"), count).alias("unique_fails"),
        total(first, lambda e: e["good"]).alias("good_lost"),
        total(first, lambda e: e["toxic"]).alias("toxic_lost"),
        total(lambda e: fails(e, "f"), lambda e: e["n"] * F.round(F.lit(len(orders)) / F.bit_count(e["mask"])).cast("bigint"))
        .alias("shapley"))


def filter_audit(spark: SparkSession, docs: DataFrame, labels: DataFrame, salt_rows: int = SALT_ROWS) -> DataFrame:
    """The audit of the five filters over ``docs (doc_id, text, source)`` and ``labels (doc_id, quality, toxic)``."""
    return audit(stage(spark, combinations(spark, docs, labels, salt_rows), "audit-combinations"))
