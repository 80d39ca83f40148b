"""Lists of line dedup: packed at every step, and ordered by counts of all texts."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
from llm_texts import sentence
from test_exact import lines_by_force

from pathlattice.llm import line_dedup as L
from pathlattice.llm import links


def families(seed, n, copies, words, edits):
    """One line a text: ``n`` lines, each with copies in which words are replaced."""
    rng, rows = random.Random(seed), []
    for _ in range(n):
        base = sentence(rng, words).split()
        for _ in range(copies):
            w = list(base)
            for p in rng.sample(range(words), edits):
                w[p] = sentence(rng, 2).replace(" ", "")
            rows.append((len(rows), " ".join(w)))
    return rows


def test_no_step_has_a_row_for_each_key_of_a_line(llm_spark, monkeypatch):
    """Near copies some of which are not linked directly: rows of all staged tables follow the lines, not their keys or pairs."""
    rows = families(11, 12, 12, 40, 6)
    staged = Counter()

    def counted(spark, df, name, stage=L.stage):
        out = stage(spark, df, name)
        staged[name] = max(staged[name], out.filter("part IS NULL").count() if "part" in out.columns else out.count())
        return out

    monkeypatch.setattr(L, "stage", counted)
    monkeypatch.setattr(links, "stage", counted)
    docs = llm_spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in L.apply(llm_spark, docs).collect()}
    want = lines_by_force(rows)
    assert got == {i: want[i, t] for i, t in rows}
    assert staged["lines"] == len(rows) and max(staged.values()) <= 4 * len(rows), staged


def test_leaders_and_pairs_between_groups():
    """``facing`` against the plain definition, for short lists and long ones."""
    rng = np.random.default_rng(5)
    count = np.array([1, 2, 5, 5, 30, 90, 3])
    total = int(count.sum())
    base = rng.integers(0, 1 << 63, 4).astype(np.uint64)
    sim = base[rng.integers(0, 4, total)] ^ (np.uint64(1) << rng.integers(0, 64, total).astype(np.uint64))
    n, place = rng.integers(20, 26, total).astype(np.uint32), rng.integers(0, 6, total)
    every, leaders, a = set(), set(), 0
    for c in count.tolist():
        close = {(x, y) for x in range(a, a + c) for y in range(x + 1, a + c)
                 if place[x] != place[y] and L.may_link(sim[x:x + 1], n[x:x + 1].astype(np.int32), sim[y:y + 1], n[y:y + 1].astype(np.int32))[0]}
        every |= close
        led = set()
        for x in range(a, a + c):
            if x not in led:
                mine = {y for y in range(x + 1, a + c) if y not in led and (x, y) in close}
                led |= mine
                leaders |= {(x, y) for y in mine}
        a += c
    for whole, want in ((True, every), (False, leaders)):
        for short in (64, 4):
            got = [p for x, y in L.facing(count, sim, n, place, whole, short) for p in zip(x.tolist(), y.tolist())]
            assert len(got) == len(set(got)) and set(got) == want


def test_all_texts_are_counted(llm_spark):
    """The counts that order keys are of every word of every text, however often it stands."""
    rng = random.Random(12)
    texts = [sentence(rng, 30) for _ in range(40)] + ["again " * 12_000] * 7
    docs = llm_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    ranks = L.word_ranks(L.line_rows(docs))
    words = sum(len(x.replace(".", " ").replace(",", " ").split()) for x in texts)
    assert ranks[:L.RANKS].sum(dtype=np.float64) == ranks[L.RANKS:].sum(dtype=np.float64) == words
    assert ranks.max() >= 84_000


def test_pipeline_lines_counts_all_texts_and_any_order_of_keys_cuts_the_same(llm_spark, monkeypatch):
    rows = families(13, 8, 5, 20, 2)
    docs = llm_spark.createDataFrame(rows, "doc_id bigint, text string")
    told, ranks_of = [], L.word_ranks
    monkeypatch.setattr(L, "word_ranks", lambda x: told.append(ranks_of(x)) or told[-1])
    first = {tuple(r) for r in corpus_pipeline.lines(llm_spark, docs, "").collect()}
    assert told[0][:L.RANKS].sum(dtype=np.float64) == sum(len(t.split()) for _, t in rows)
    monkeypatch.setattr(L, "word_ranks", lambda x: np.random.default_rng(1).integers(0, 300, 2 * L.RANKS).astype(np.float32))
    assert first == {tuple(r) for r in corpus_pipeline.lines(llm_spark, docs, "").collect()}
    assert 8 <= len(first) < len(rows)
