"""Toxicity: subword-bag embeddings averaged into a linear softmax.

Lower-cased words and their character n-grams share one hashed table of vectors, so an unseen misspelling gets most of
the vectors of the word it comes from. A text is the mean of its features' vectors; the mean goes through a linear softmax;
vectors and layer are learned together by mini-batch gradient descent in numpy, on a bounded sample of labelled rows outside
the held-out fold (``SAMPLE`` rows of each class, whole texts).

A few toxic words must show in a text of thousands, so the mean is taken over telling features only: cells whose share of documents
differs between the classes by ``MIN_Z`` standard errors in the sample. ``NEUTRAL`` copies of one more learned vector stand in every
bag for all the rest, so that a single weak cell does not decide.

Cases: a null or empty text, or one without a telling feature, scores what the neutral vector and bias say; rows without
an id are scored, but never held out nor learned from; repeated rows are each scored; with one class or no labels, the score is that
class or 0.5; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pathlattice.llm import subword as sw
from pathlattice.llm.common import held_out
from pathlattice.llm.quality_classifier import binary_table

FEATURES = sw.Features(grams=(3, 4, 5), lower=True)
SAMPLE = 2000
CUT = 0.5
MIN_Z = 5.0
NEUTRAL = 4.0


def telling_cells(sample: sw.Sample, buckets: int) -> np.ndarray:
    """Cells whose document shares in the two classes differ by at least ``MIN_Z`` standard errors."""
    keep = np.zeros(buckets, bool)
    if len(sample.classes) == 2 and len(sample.y):
        n = np.bincount(sample.y, minlength=2).astype(np.float64)
        hits = [np.bincount(np.concatenate([c for (c, _), y in zip(sample.rows, sample.y) if y == k] or [np.zeros(0, int)]),
                            minlength=buckets) for k in (0, 1)]
        share = (hits[0] + hits[1]) / n.sum()
        error = np.sqrt(np.maximum(share * (1 - share) * (1 / np.maximum(n, 1)).sum(), 1e-12))
        keep = np.abs(hits[1] / max(n[1], 1) - hits[0] / max(n[0], 1)) >= MIN_Z * error
        keep &= share > 0
    keep[buckets - 1] = False  # the neutral vector's place
    return keep


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE,
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``held_out``, ``score`` (likelihood of toxic 1) and ``predicted`` for every row."""
    f = FEATURES
    sample = sw.learning_sample(spark, docs, labels, "toxic", 5, 0, bound, f)
    telling = telling_cells(sample, f.buckets)
    sample.rows = [(np.append(c[telling[c]], f.buckets - 1).astype(np.int32),
                    np.append(n[telling[c]], NEUTRAL).astype(np.float32)) for c, n in sample.rows]
    cells, bias = binary_table(sample, f, epochs=10, scale=10.0)
    neutral = float(cells[f.buckets - 1, 0])
    cells = np.where(telling[:, None], cells, 0)
    columns = np.concatenate([cells, telling[:, None]], axis=1).astype(np.float32)

    def finish(mean, n, rows):
        total, count = mean[:, 0] * n, mean[:, 1] * n
        z = (total + NEUTRAL * neutral) / (count + NEUTRAL) + bias
        score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return [pa.array(score), pa.array((score >= CUT).astype(np.int32))]

    return sw.score_texts(docs, f, columns, "score double, predicted int", finish, keep) \
        .withColumn("held_out", held_out("doc_id", 5, 0)).select(*keep, "held_out", "score", "predicted")
