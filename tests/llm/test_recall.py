"""Recall against the similarity an operator states, by length and kind of edit, without the operator's own filters."""

import random

import pytest
from llm_texts import sentence

from pathlattice.llm import line_dedup as L


def edited(rng, words, n, kind):
    """``words`` with ``n`` of them replaced or cut out, or ``n`` new ones put in."""
    w = list(words)
    for p in sorted(rng.sample(range(len(w)), n), reverse=True):
        new = [] if kind == "delete" else [f"q{sentence(rng, 2).replace(' ', '')}z"]
        w[p:p + (kind != "insert")] = new
    return w


@pytest.mark.parametrize("kind", ["replace", "delete", "insert"])
def test_lines_a_quarter_edited_are_found(llm_spark, kind):
    rng, rows, pairs = random.Random(9), [], {}
    for n in (8, 12, 20, 50, 100, 200):
        for k in range(40):
            base = sentence(rng, n).split()
            # an insertion makes the longer line, whose quarter counts
            most = n // 4 if kind != "insert" else n // 3
            near = edited(rng, base, most if k % 2 else max(1, n // 10), kind)
            assert len(near) >= L.MIN_WORDS
            pairs[len(rows) + 1] = n
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(near))]
    got = {r.doc_id: r.cut for r in L.apply(
        llm_spark, llm_spark.createDataFrame(rows, "doc_id bigint, text string"), "cut").collect()}
    for n in (8, 12, 20, 50, 100, 200):
        found = [got[i] for i, m in pairs.items() if m == n]
        assert sum(found) >= 0.95 * len(found), (n, sum(found), len(found))
    assert not any(got[i - 1] for i in pairs)


def test_an_id_on_many_rows_is_one_node(llm_spark):
    """Two texts, each under one id on 400 rows: one pair to verify, one group."""
    import random

    from pathlattice.llm import ngram_join

    rng = random.Random(8)
    a = sentence(rng, 80)
    b = a.replace(a.split()[40], "qqq", 1)
    docs = llm_spark.createDataFrame([(1, a), (2, b)] * 400 + [(2, sentence(rng, 80)), (3, sentence(rng, 60))],
                                     "doc_id bigint, text string").repartition(4)
    nodes = llm_spark.createDataFrame([(7, 1, *map(int, ngram_join.signature(s)), len(s)) for s in sets_of(a)],
                                      "node bigint, doc_id bigint, s1 bigint, s2 bigint, n bigint")
    chunks = ngram_join.chunked_sets(llm_spark, docs, nodes, 1)
    assert sum(len(r.nodes) // 8 for r in chunks.collect()) == 1
    got = {(r.doc_id, r.component_id) for r in ngram_join.groups(llm_spark, docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 3)} or got == {(1, 1), (2, 1), (2, 2), (3, 3)}


def sets_of(text):
    import pyarrow as pa

    from pathlattice.llm import ngram_join
    from pathlattice.llm import textvec as tv

    return [s for b in tv.blocks(pa.array([text]), lower=True) for s in ngram_join.text_sets(b)]
