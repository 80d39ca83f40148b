"""Work per row and tasks per batch that must not grow with the tokens of a text or with the messages of a file."""

from pyspark.sql import functions as F

from pathlattice.catalog import _message_files
from pathlattice.functions.messages import decode_hops, is_zero_hop, parse_edges
from pathlattice.operators import sequence
from pathlattice.operators import updates as U

LINES = ["0 7", "12 1 5 2 7 3", "3 1 3 2", "11 1 2 1 9 1"]


def _splits(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("split(")


def test_a_line_is_split_once_per_use(spark):
    df = spark.createDataFrame([(1, x) for x in LINES], "query_id bigint, line string")
    assert _splits(df.select(decode_hops("line").alias("h"))) == 1
    got = {r.line: (r.z, r.n) for r in df.select("line", is_zero_hop("line").alias("z"), F.size(decode_hops("line")).alias("n")).collect()}
    assert got == {x: (len(x.split()) == 2, (len(x.split()) - 2) // 2) for x in LINES}


def test_zero_hop_walks_are_found_without_decoding(spark):
    df = spark.createDataFrame([(1, x) for x in LINES], "query_id bigint, line string")
    latest = spark.createDataFrame([(1, 2, 40)], "src bigint, dst bigint, new_weight bigint")
    out = U.reweight(df, latest)
    assert {(r.old_line, r.total, r.line) for r in out.collect()} == {
        ("0 7", 0, "0 7"), ("12 1 5 2 7 3", 47, "47 1 40 2 7 3"), ("3 1 3 2", 40, "40 1 40 2"),
        ("11 1 2 1 9 1", 11, "11 1 2 1 9 1")}
    filters = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if x.lstrip(" :+-").startswith("Filter")]
    assert not any("transform(" in x for x in filters if "size(" in x and "isnotnull" not in x.lower())


def test_an_edge_message_is_split_once_per_use(spark):
    df = spark.createDataFrame([(1, "1 5 2 0.5 0.25 1.5 1.25"), (2, "1 5 2"), (3, "1 -5 2 0 0 0 0")], "seq bigint, value string")
    ok = parse_edges(df).filter("valid").drop("valid")
    assert _splits(ok) <= 2  # the filter's and the fields'
    assert [tuple(r) for r in ok.collect()] == [(1, 1, 5, 2, 0.5, 0.25, 1.5, 1.25)]


def test_a_large_batch_has_several_files(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("value"))
    per_batch = _message_files(df, str(tmp_path / "m"), batches=4, file_rows=50)
    back = spark.read.parquet(str(tmp_path / "m"))
    assert len(back.inputFiles()) >= 20 and 5 <= per_batch <= 7
    assert back.count() == 1000 and back.agg(F.sum("seq")).first()[0] == 999 * 500
    assert _message_files(df, str(tmp_path / "few"), batches=4) == 1


def test_groups_are_counted_only_in_full_buckets(spark, monkeypatch):
    rows = [(0, i, i) for i in range(60)] + [(g, i, 100 * g + i) for g in range(1, 30) for i in range(5)] + [(None, i, i) for i in range(50)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    for buckets in (1, 7, 4096):  # few buckets: full ones without a hot group
        monkeypatch.setattr(sequence, "COUNT_BUCKETS", buckets)
        plain, hot = sequence._split_hot(df, ["g"], 40)
        assert {r.g for r in hot.select("g").distinct().collect()} == {0, None}
        assert plain.count() == 29 * 5
        assert sequence._split_hot(df, ["g"], 60)[1] is None
