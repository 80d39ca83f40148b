"""Quality classifier: supervised subword embeddings.

Hashed word, word-pair and character n-gram vectors are averaged per document and go through a softmax layer; vectors
and layer are learned by mini-batch gradient descent in numpy on a bounded sample of labelled rows outside the held-out
fold (``SAMPLE_PER_CLASS`` documents a class, whole texts). Every whole text is then scored.

Cases: a null or empty text has the zero mean, so its score is the learned bias; rows without an id are scored, but
never held out; repeated rows are each scored; with one class or no labels at all, the score is that class or 0.5;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pathlattice.llm import subword as sw
from pathlattice.llm import textvec as tv
from pathlattice.llm.common import held_out, map_arrow

FEATURES = sw.Features(grams=(3, 4), pairs=True)
SAMPLE_PER_CLASS = 1500
CUT = 0.7


def binary_table(sample: sw.Sample, f: sw.Features, **how) -> tuple[np.ndarray, float]:
    """Cell table with one column and bias, both as the log-odds of the label 1."""
    if len(sample.classes) < 2:
        sure = {(): 0.0, (0,): -20.0, (1,): 20.0}.get(tuple(sample.classes), 0.0)
        return np.zeros((f.buckets, 1), np.float32), sure
    cells, bias = sw.train_embeddings(sample, f, **how)
    one = sample.classes.index(1)
    return (cells[:, one] - cells[:, 1 - one])[:, None], float(bias[one] - bias[1 - one])


def score_binary(docs: DataFrame, f: sw.Features, cells: np.ndarray, bias: float, cut: float, mod: int, remainder: int,
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    def finish(mean, n, rows):
        score = 1 / (1 + np.exp(-np.clip(mean[:, 0] + bias, -40, 40)))
        return [pa.array(score), pa.array((score >= cut).astype(np.int32))]

    return sw.score_texts(docs, f, cells, "score double, predicted int", finish, keep) \
        .withColumn("held_out", held_out("doc_id", mod, remainder))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_PER_CLASS,
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``held_out``, ``score`` (likelihood of quality 1) and ``predicted`` for every row."""
    sample = sw.learning_sample(spark, docs, labels, "quality", 4, 2, bound, FEATURES)
    cells, bias = binary_table(sample, FEATURES)
    return score_binary(docs, FEATURES, cells, bias, CUT, 4, 2, keep).select(*keep, "held_out", "score", "predicted")


def accept(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The rows of ``docs`` (all columns) whose score is at least ``CUT``."""
    sample = sw.learning_sample(spark, docs, labels, "quality", 4, 2, bound, FEATURES)
    cells, bias = binary_table(sample, FEATURES)
    shared = spark.sparkContext.broadcast(cells)
    least = np.log(CUT / (1 - CUT)) - bias

    def run(batches):
        for batch in batches:
            ok = [np.zeros(0, bool)]
            for b in tv.blocks(batch.column("text"), FEATURES.lower):
                sums, n = sw.text_scores(b, FEATURES, shared.value)
                ok.append(sums[:, 0] / np.maximum(n, 1) >= least)
            yield batch.filter(pa.array(np.concatenate(ok)))

    return map_arrow(docs, run, docs.schema)
