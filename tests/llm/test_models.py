"""Learned operators: held-out accuracy on sf0.01, contracts and odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
from llm_texts import SF, sentence

from pathlattice.llm import html_extract as H
from pathlattice.llm import language_id, queries, quality_classifier, toxicity
from pathlattice.llm import subword as sw
from pathlattice.llm import textvec as tv


def crc(i):
    return zlib.crc32(str(i).encode())


def labelled(spark, frame):
    return frame.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").toPandas()


def test_table_scores_equal_the_mean_of_embeddings():
    """Scoring by block and word equals the feature rows times the table."""
    rng = np.random.RandomState(1)
    texts = ["aa bb aa cc", "", "één zwei 3 !!", "x " * 300 + "yyyyyyyy", "one\ntwo\tthree", None]
    for f in (sw.Features(pairs=True), sw.Features(grams=(1, 2), lower=True)):
        cells = rng.randn(f.buckets, 2).astype(np.float32)
        for b in tv.blocks(pa.array(texts, pa.string()), f.lower):
            rows = sw.sparse_rows(b, f)
            sums, n = sw.text_scores(b, f, cells)
            for (c, count), s, k in zip(rows, sums, n):
                assert count.sum() == k and np.allclose((cells[c] * count[:, None]).sum(axis=0), s, atol=1e-2)


def test_quality(llm_spark, odd, none, labels):
    got = queries.QUERIES["op6_quality_classifier"](llm_spark, SF)
    held = labelled(llm_spark, got)
    assert ((held.score >= 0.7) == held.quality).mean() > 0.95
    rows = got.collect()
    assert len(rows) == 1000 and all(r.held_out == (crc(r.doc_id) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    assert quality_classifier.classify(llm_spark, odd, labels).count() == odd.count()
    assert quality_classifier.classify(llm_spark, none, labels).collect() == []
    no_labels = quality_classifier.classify(llm_spark, odd, labels.limit(0)).collect()
    assert {r.score for r in no_labels} == {0.5}
    accepted = quality_classifier.accept(llm_spark, odd, labels)
    assert accepted.columns == odd.columns and accepted.count() <= odd.count()


def test_labels_of_the_held_out_fold_are_never_seen(llm_spark):
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    real = llm_spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F

    from pathlattice.llm.common import held_out

    flipped = real.withColumn("toxic", F.when(held_out("doc_id", 5, 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity(llm_spark, docs, x).collect()} for x in (real, flipped))
    assert a == b


def test_toxicity(llm_spark, odd, none, labels):
    got = queries.QUERIES["op10_toxicity"](llm_spark, SF)
    held = labelled(llm_spark, got)
    assert ((held.score >= 0.5) == held.toxic).mean() > 0.9
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in got.collect())
    assert toxicity.toxicity(llm_spark, odd, labels).count() == odd.count()
    assert toxicity.toxicity(llm_spark, none, labels).collect() == []


def test_unseen_misspellings_of_toxic_words(llm_spark):
    rng = random.Random(9)
    bad = ["worthlessfool", "dimwitted"]
    docs = [(i, f"{sentence(rng, 50)} {rng.choice(bad) if i % 4 == 0 else ''} {sentence(rng, 50)}") for i in range(1200)]
    test = [(9000 + k, f"{sentence(rng, 50)} {w} {sentence(rng, 50)}") for k, w in enumerate(["worthlessf00l", "dimwiitted", "wworthlessfool"])]
    clean = [(9500 + k, sentence(rng, 100)) for k in range(50)]
    frame = llm_spark.createDataFrame(docs + test + clean, "doc_id bigint, text string")
    marks = llm_spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in docs], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(llm_spark, frame, marks).collect()}
    assert all(got[i] == 1 for i, _ in test) and sum(got[i] for i, _ in clean) == 0


def test_language(llm_spark, odd, none):
    got = queries.QUERIES["op8_language_id"](llm_spark, SF)
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    held = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (held.lang == held.lang_pred).mean() > 0.98 and held.score.between(0, 1).all()
    rows = language_id.identify(llm_spark, odd).collect()
    assert len(rows) == odd.count()
    assert {r.lang_pred for r in rows if r.doc_id in (4, 5, 6)} == {"und"} and {r.lang_pred for r in rows} <= {"und", "en"}
    assert language_id.identify(llm_spark, none).collect() == []
    assert {r.lang_pred for r in language_id.identify(llm_spark, odd.withColumn("lang", odd.lang.substr(9, 1)).na.replace("", None)).collect()} == {"und"}


PAGE = ("<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=/a>menu</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><div id=wrap{n}><div class='post-{n} x'><h2>Head &amp; {n}</h2><p>First para of "
        "{n}.<br>Still  first.<p>Second <b>para</b></p><ul><li>one<li>two</ul></div><div class='sidebar'><p>Related things "
        "here, a long list of them to tempt you away from what you came to read</p></div><div class=comments><p>Reader says hi, at some "
        "length</p></div></div><form><p>Sign up</p></form><footer>&copy; all</footer><script>var p = '<p>no</p>';</script></body></html>")


def test_extraction_by_host_consensus(llm_spark):
    pages = [(i, f"https://a.example/{i}", PAGE.format(n=i)) for i in range(20)]
    # one page whose post is short and whose other container is long: the host's votes decide
    pages.append((50, "https://A.example/odd", PAGE.format(n=50).replace("<form>", "<div class=archive><p>" + "old words " * 80 + "</p></div><form>")))
    pages += [(60, None, PAGE.format(n=60)), (61, "https://b.example/", None), (62, "https://b.example/", ""), (63, "no url", "just text"),
              (64, "https://c.example/x", "<article><p>unclosed &lt;x&gt; <table><tr><td>a<td>b"), (64, "https://c.example/x", "<article><p>twin</article>"),
              (None, "https://c.example/y", "<p>" + "long " * 20_000), (66, "https://d.example", "<article><h1>T</h1><p>a</p></article><aside>b</aside>")]
    frame = llm_spark.createDataFrame([(*p, "extra") for p in pages], "page_id bigint, url string, html string, path string")
    got = [(r.page_id, r.text, r.n_chars) for r in H.extract(llm_spark, frame).collect()]
    assert all(n == len(t) for _, t, n in got) and len(got) == len(pages)
    texts = dict((i, t) for i, t, _ in got if i != 64)
    for n in (3, 50, 60):
        assert texts[n] == f"Head & {n}\nFirst para of {n}. Still first.\nSecond para\none\ntwo"
    assert texts[61] == texts[62] == "" and texts[63] == "just text" and texts[66] == "T\na"
    assert texts[None] == " ".join(["long"] * 20_000)
    assert sorted(t for i, t, _ in got if i == 64) == ["twin", "unclosed <x>\na\nb"]
    assert H.extract(llm_spark, frame.limit(0)).collect() == []


def test_extraction_of_the_given_pages(llm_spark):
    rows = queries.QUERIES["op9_html_extract"](llm_spark, SF).collect()
    source = {r.page_id: r.html for r in llm_spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(source)
    import html
    import re

    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert " ".join(r.text.split()) == " ".join(p for p in parts if p)
