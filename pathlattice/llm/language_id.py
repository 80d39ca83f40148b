"""Language identification by hierarchical discrimination.

A document is the mean of its hashed words and character n-grams (1 to 4 characters, lower-cased ASCII). One-versus-rest linear
support vector machines choose the language family first; inside the chosen family, one machine for each pair of its
languages (one-versus-one) separates the closely related ones, and the language with most (soft) votes wins. All machines are learned with hinge
loss in numpy on a bounded sample of rows with a language outside the held-out fold, and all are applied to every
whole text in one pass, since each is a column of the same cell table.

``score`` is the share of the chosen family (softmax of its margins) times the votes of the chosen language over
those it could get.

Cases: a null text, or one without a letter, is ``und`` with score 0; rows without an id are predicted but never learned
from; a language outside ``FAMILIES`` is a family of its own; with one learned language all get it; with none, all are
``und``; repeated rows are each predicted; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm import subword as sw
from pathlattice.llm.common import held_out

# Language codes by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tt"),
    "indic": ("hi", "mr", "ne", "bn", "pa", "gu", "ur"),
    "semitic": ("ar", "he", "mt", "am"),
}
FEATURES = sw.Features(grams=(1, 2, 3, 4), lower=True)
SAMPLE_PER_CLASS = 1000
UNKNOWN = "und"


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang.split("-")[0].lower() in members), lang)


def train_svms(sample: sw.Sample, target: np.ndarray, buckets: int, scale: float = 30.0, epochs: int = 20,
               batch: int = 64, rate: float = 0.2, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights [buckets, machines] and biases; ``target`` [class, machine] is +1, -1, or 0 where a machine has no say."""
    w = np.zeros((buckets, target.shape[1]), np.float32)
    bias = np.zeros(target.shape[1], np.float32)
    g_w, g_b = np.full(w.shape, 1e-6, np.float32), np.full(bias.shape, 1e-6, np.float32)
    batches = sw.Batches(sample.rows, sample.y, batch, 11, scale)
    for _ in range(epochs):
        for cells, x, off, by, first, touched, doc, y in batches:
            t = target[y]
            margin = np.add.reduceat(w[cells] * x[:, None], off, axis=0) + bias
            loss = -t * (t * margin < 1) / len(y)
            d_w = np.add.reduceat(loss[doc[by]] * x[by][:, None], first, axis=0) + decay * w[touched]
            d_b = loss.sum(axis=0)
            g_w[touched] += d_w ** 2
            g_b += d_b ** 2
            w[touched] -= rate * d_w / np.sqrt(g_w[touched])
            bias -= rate * d_b / np.sqrt(g_b)
    return w * np.float32(scale), bias


def identify(spark: SparkSession, docs: DataFrame, bound: int = SAMPLE_PER_CLASS,
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``held_out``, ``lang_pred`` and ``score`` for every row of ``docs (doc_id, text, lang)``."""
    sample = sw.learning_sample(spark, docs, docs.select("doc_id", "lang"), "lang", 4, 2, bound, FEATURES)
    langs = [str(c) for c in sample.classes] or [UNKNOWN]
    family = [family_of(c) for c in langs]
    families = sorted(set(family))
    pairs = [(i, j) for i in range(len(langs)) for j in range(i) if family[i] == family[j]]
    k = len(families)
    target = np.zeros((len(langs), k + len(pairs)), np.float32)
    for i, own in enumerate(family):
        target[i, :k] = [1 if own == name else -1 for name in families]
    for c, (i, j) in enumerate(pairs):
        target[i, k + c], target[j, k + c] = 1, -1
    cells, bias = train_svms(sample, target, FEATURES.buckets) if sample.rows else (
        np.zeros((FEATURES.buckets, target.shape[1]), np.float32), np.zeros(target.shape[1], np.float32))
    member = np.array([[own == name for own in family] for name in families])

    def finish(mean, n, rows):
        margin = mean + bias
        f_share = sw.softmax(2 * margin[:, :k])
        chosen = f_share.argmax(axis=1)
        votes = np.zeros((len(mean), len(langs)))
        for c, (i, j) in enumerate(pairs):
            for_i = 1 / (1 + np.exp(-np.clip(4 * margin[:, k + c], -40, 40)))
            votes[:, i] += for_i
            votes[:, j] += 1 - for_i
        most = member.sum(axis=1) - 1  # votes a language of each family can get
        l_share = np.where(member[chosen], (votes + (most[chosen] == 0)[:, None]) / np.maximum(most[chosen], 1)[:, None],
                           -1.0)
        best = l_share.argmax(axis=1)
        at = np.arange(len(best))
        letter = np.array(rows.column("_letter").to_pylist(), bool)
        score = np.where(letter, f_share[at, chosen] * l_share[at, best], 0.0)
        pred = [langs[i] if ok else UNKNOWN for i, ok in zip(best, letter)]
        return [pa.array(pred, pa.string()), pa.array(score.astype(np.float64))]

    marked = docs.select(*dict.fromkeys([*keep, "text"]),
                         F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    return sw.score_texts(marked, FEATURES, cells, "lang_pred string, score double", finish, (*keep, "_letter")) \
        .withColumn("held_out", held_out("doc_id", 4, 2)).select(*keep, "held_out", "lang_pred", "score")
