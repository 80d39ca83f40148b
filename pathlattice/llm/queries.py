"""The registered queries of the operators: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm import (decontaminate, filter_audit, hard_negatives, html_extract, language_id, line_dedup, lm_score, ngram_join,
                             packing, piece_codec, quality_classifier, quality_rules, toxicity)
from pathlattice.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def tokenizer_files() -> tuple[str, str]:
    """The tokenizer file, and its vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


OP1_SQL = r"""
WITH base AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
toks AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM base),
pos AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM toks WHERE len(w) >= 3) p),
reps AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM pos) x WHERE c >= 2),
cover AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM reps, (VALUES (0), (1), (2)) v(d) GROUP BY doc_id),
counts AS (SELECT k.doc_id, k.source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) AS n_lines,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM toks k LEFT JOIN cover c ON c.doc_id = k.doc_id),
fails AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS f_base,
  10 * n_symbols > 3 * n_words AS f_sym, 10 * n_dup_lines > 3 * n_lines AS f_lines FROM counts),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (f_base) AS kb, count(*) FILTER (f_sym) AS ks,
  count(*) FILTER (f_lines) AS kl FROM fails WHERE source IS NOT NULL GROUP BY source),
prior AS (SELECT avg(kb / n) AS mb, var_pop(kb / n) AS vb, avg(ks / n) AS ms, var_pop(ks / n) AS vs,
  avg(kl / n) AS ml, var_pop(kl / n) AS vl FROM hosts),
strength AS (SELECT *,
  CASE WHEN vb > 0 THEN greatest(1.0, least(1000.0, mb * (1 - mb) / vb - 1)) ELSE 1000.0 END AS sb,
  CASE WHEN vs > 0 THEN greatest(1.0, least(1000.0, ms * (1 - ms) / vs - 1)) ELSE 1000.0 END AS ss,
  CASE WHEN vl > 0 THEN greatest(1.0, least(1000.0, ml * (1 - ml) / vl - 1)) ELSE 1000.0 END AS sl FROM prior),
verdict AS (SELECT source, greatest((kb + mb * sb) / (n + sb), (ks + ms * ss) / (n + ss), (kl + ml * sl) / (n + sl))
  AS rate FROM hosts, strength)
SELECT f.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, f_base AS base_failed,
  NOT f_base AND NOT f_sym AND NOT f_lines AND NOT coalesce(v.rate > 0.7, false) AS kept, round(v.rate, 6) AS host_rate
FROM fails f LEFT JOIN verdict v ON v.source = f.source"""


@register("op1_quality_rules", OP1_SQL)
def op1(spark, sf_dir):
    return quality_rules.quality_rules(spark, table(spark, sf_dir, "documents"))


@register("op4_packing")
def op4(spark, sf_dir):
    return packing.pack(spark, table(spark, sf_dir, "documents"), *tokenizer_files()).drop("ids")


@register("op6_quality_classifier")
def op6(spark, sf_dir):
    return quality_classifier.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op8_language_id")
def op8(spark, sf_dir):
    return language_id.identify(spark, table(spark, sf_dir, "documents"))


@register("op9_html_extract")
def op9(spark, sf_dir):
    return html_extract.extract(spark, table(spark, sf_dir, "pages"))


@register("op7_decontaminate")
def op7(spark, sf_dir):
    return decontaminate.find_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op3_line_dedup")
def op3(spark, sf_dir):
    return line_dedup.apply(spark, table(spark, sf_dir, "documents").select("doc_id", "text")) \
        .withColumnRenamed("_removed", "removed_lines")


@register("op5_ngram_join")
def op5(spark, sf_dir):
    return ngram_join.groups(spark, table(spark, sf_dir, "documents")).drop("tag")


@register("op2_lm_score")
def op2(spark, sf_dir):
    return lm_score.score(spark, table(spark, sf_dir, "documents"))


def piece_model() -> str:
    """The piece model file."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register("op12_sentencepiece")
def op12(spark, sf_dir):
    coded = piece_codec.codec(spark, table(spark, sf_dir, "documents"), piece_model())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


OP13_SQL = r"""
WITH base AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
known AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
smallest AS (SELECT t, min(doc_id) AS lo FROM base GROUP BY t),
marks AS (SELECT b.part, coalesce(k.good, false) AS good, coalesce(k.toxic, false) AS toxic,
  CAST(len(w) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INT)
  + 4 * CAST(100 * length(regexp_replace(b.t, '[^A-Z]+', '', 'g')) > 5 * length(b.t) AS INT)
  + 8 * CAST(regexp_matches(b.t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(s.lo < b.doc_id, false) AS INT) AS mask
  FROM base b JOIN smallest s ON s.t = b.t LEFT JOIN known k ON k.doc_id = b.doc_id),
combos AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM marks GROUP BY part, mask),
f(c, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS o, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT o, s, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s) x),
rows_ AS (SELECT part, o, s, bit, coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
  coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS removed,
  coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
  coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS toxic_lost
  FROM combos, steps GROUP BY part, o, s, bit)
SELECT part, o AS filter_order, CAST(s AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM rows_"""


@register("op13_filter_audit", OP13_SQL)
def op13(spark, sf_dir):
    return filter_audit.filter_audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
pos AS (SELECT a.vec_id AS anchor_id, a.label, a.e, v.vec_id AS positive_id, list_dot_product(a.e, v.e) AS ps
  FROM a JOIN v ON v.label = a.label AND v.vec_id <> a.vec_id
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY ps DESC, v.vec_id) <= 5),
neg AS (SELECT a.vec_id AS anchor_id, v.vec_id AS negative_id, list_dot_product(a.e, v.e) AS ns
  FROM a JOIN v ON v.label <> a.label)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY ns DESC, negative_id) AS INT)
  AS rank, negative_id, CAST(ps AS BIGINT) AS positive_score, CAST(ns AS BIGINT) AS negative_score
FROM pos p JOIN neg n ON n.anchor_id = p.anchor_id AND 80 * ps <= 100 * ns AND ns <= ps
QUALIFY rank <= 5"""


@register("op11_hard_negatives", OP11_SQL)
def op11(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark, table(spark, sf_dir, "embeddings"), moved)
