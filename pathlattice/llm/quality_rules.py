"""Quality rules with host verdicts, in DataFrame functions only.

Each document gets its counts and three rule failures: ``base`` (under 50 words, or more than half of its words in
repeated 3-word windows), ``symbols`` (over 0.3 symbol characters a word), ``lines`` (over 30 % of its non-blank lines
repeat an earlier one). Failures are summed by host. Per rule, a beta prior is fitted to the hosts' rates by moments
(mean m, variance v, strength m(1-m)/v - 1), and each host's rate is shrunk to ``(failures + a) / (documents + a + b)``,
so a host with few documents stays near the mean of all. A host is bad when a shrunk rate of any rule is over
``HOST_LIMIT``. A document is kept when it fails no rule itself and its host is not bad.

Cases: a null or empty text has no words and fails ``base``; a null host has no verdict and counts for no prior; a
repeated row is counted and returned as often as it is there; one host alone has variance 0, and the prior is then as
strong as ``MAX_STRENGTH`` documents; an empty table gives an empty result. Other columns are ignored.

Scale: one pass over the texts makes one narrow row per document (written once), host sums are partial aggregates, so
a hot host sends one row per task; the verdicts (one row per host) go back by broadcast while their counted size is small,
else by a shuffle join that AQE splits where a host is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm.common import small, stage

BLANKS = r"[\x20\x09-\x0D]+"
NON_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]+"
HOST_LIMIT = 0.7
MAX_STRENGTH = 1000.0
RULES = ("base", "symbols", "lines")


def window_hashes(words: Column) -> Column:
    """64-bit hashes of the 3-word windows, null below three words."""
    return F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                                                  lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])))


def document_counts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """Counts per document. For ``n_repeat_words``, only a text with two equal windows goes on to sort (hash, position);
    the words covered by its repeated windows at p1 < p2 < ... are sum(min(3, p(i+1) - p(i))), 3 for the last."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(*keep, text.alias("_t"))
    d = d.select(*keep, "_t", F.filter(F.split("_t", BLANKS), lambda w: w != "").alias("_w"),
                 F.filter(F.split("_t", "\n"), lambda x: x.rlike(NON_BLANK)).alias("_l"))
    d = d.select(*keep, F.size("_w").cast("long").alias("n_words"),
                 F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                 (F.char_length("_t") - F.char_length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long")
                 .alias("n_symbols"),
                 F.size("_l").alias("_n_lines"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 window_hashes(F.col("_w")).alias("_h"))
    # sorted (hash, position) of texts with an equal pair of windows, else null
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))).drop("_h")
    d = d.withColumn("_p", F.sort_array(F.transform(
        F.filter("_s", lambda x, i: (x["h"] == F.get(F.col("_s"), i - 1)["h"]) | (x["h"] == F.get(F.col("_s"), i + 1)["h"])),
        lambda x: x["p"]))).drop("_s")
    return d.withColumn("n_repeat_words", F.coalesce(F.aggregate(F.transform(
        "_p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("_p"), i + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")).drop("_p")


def host_verdicts(spark: SparkSession, counts: DataFrame, host: str = "source") -> DataFrame:
    """``host, host_rate`` (the largest shrunk rate) ``, host_bad`` from documents with ``fail_<rule>`` columns."""
    hosts = stage(spark, counts.filter(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.col(f"fail_{r}").cast("long")).alias(f"k_{r}") for r in RULES)), "hosts")
    prior = hosts.agg(*(f(F.col(f"k_{r}") / F.col("n")).alias(f"{a}_{r}") for r in RULES
                        for a, f in (("m", F.avg), ("v", F.var_pop))),
                      F.count(F.lit(1)).alias("hosts"), F.max(F.octet_length(host)).alias("width")).first()

    def rate(r):
        m, v = prior[f"m_{r}"] or 0.0, prior[f"v_{r}"] or 0.0
        strength = max(1.0, min(MAX_STRENGTH, m * (1 - m) / v - 1)) if v > 0 else MAX_STRENGTH
        return (F.col(f"k_{r}") + F.lit(m * strength)) / (F.col("n") + F.lit(strength))

    worst = F.greatest(*(rate(r) for r in RULES))
    verdicts = hosts.select(host, F.round(worst, 6).alias("host_rate"), (worst > HOST_LIMIT).alias("host_bad"))
    return small(verdicts, prior["hosts"], 64 + (prior["width"] or 0))


def quality_rules(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Counts, rule failures and verdict for every row of ``docs (doc_id, text, source)``."""
    counts = document_counts(docs).withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "fail_symbols": 10 * F.col("n_symbols") > 3 * F.col("n_words"),
        "fail_lines": 10 * F.col("n_dup_lines") > 3 * F.col("_n_lines"),
    }).withColumn("fail_base", F.col("base_failed"))
    counts = stage(spark, counts, "quality-counts")
    joined = counts.join(host_verdicts(spark, counts), "source", "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.col("fail_symbols") & ~F.col("fail_lines")
         & ~F.coalesce(F.col("host_bad"), F.lit(False))).alias("kept"), "host_rate")
