"""Corpus pipeline: quality filter, line dedup, near-duplicate documents, benchmark decontamination, packing.

Each stage takes all that its predecessor kept, is written as Parquet into the shared checkpoint folder and read again. All but the
last return the columns of ``documents``; ``n_chars`` follows a changed text. Stages:

* ``quality``: documents that the classifier scores under its cut go.
* ``lines``: repeated lines are cut out of the texts; a document that loses all its text is a copy and goes.
* ``near_duplicates``: one document of each linked group stays.
* ``decontaminate``: documents that hold a benchmark item go.
* ``packing``: the rest becomes pieces of fixed windows.

Null texts and ids pass the stages as each operator defines; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm import decontaminate, line_dedup, ngram_join, packing, quality_classifier, queries
from pathlattice.llm.common import free_name, stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.accept(spark, docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    removed = free_name(docs, "_removed")
    done = line_dedup.apply(spark, docs, removed, drop_emptied=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col(removed) > 0, F.char_length("text").cast(kind))
                               .otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(spark, docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, *queries.tokenizer_files()).drop("ids")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminate", benchmark),
          ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        docs = stage(spark, stage_of(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
