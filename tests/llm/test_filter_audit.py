"""The filter audit against applying the filters in every order, document by document."""

import itertools
import random
import re

import pyarrow as pa
from llm_texts import SF, sentence

from pathlattice.checks import compare, duck
from pathlattice.llm import filter_audit as A
from pathlattice.llm import queries
from pathlattice.llm import textvec as tv

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_force(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, t, s in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)}
        rows.append((s or "", i, fails))
    out = set()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        steps, shares = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [r for r in left if r[2][c]]
                failing = [r for r in mine if r[2][c]]
                left = [r for r in left if not r[2][c]]
                shares[c] += len(gone)
                steps.append((c, (part, order, step, len(left), len(gone), len(failing) - len(gone),
                                  sum(sum(r[2].values()) == 1 for r in failing),
                                  sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone))))
        out |= {(*row, shares[c]) for c, row in steps}
    return out


def rows(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_odd_rows(llm_spark, odd, odd_rows, labels, none):
    docs = [(r[0], r[1], r[3]) for r in odd_rows]
    known = [tuple(r) for r in labels.collect()]
    assert rows(A.filter_audit(llm_spark, odd, labels)) == by_force(docs, known)
    assert rows(A.filter_audit(llm_spark, odd, labels.limit(0))) == by_force(docs, [])
    assert A.filter_audit(llm_spark, none, labels).count() == 0


def test_many_copies_are_salted_and_found(llm_spark):
    rng = random.Random(3)
    hot, twin = sentence(rng, 60), sentence(rng, 40)
    docs = [(i, hot, f"s{i % 3}") for i in range(200, 0, -1)] + [(i, twin + " #" * (i % 2), None) for i in range(300, 340)]
    docs += [(i, sentence(rng, rng.randint(1, 90)).upper() if i % 4 else "a a a", "s0") for i in range(400, 430)]
    docs += [(7, hot, "s1"), (1, hot, "s1"), (None, hot, "s2")]
    known = [(i, i % 2, i % 3 == 0) for i in range(0, 430, 3)] + [(3, 0, 0), (3, 1, 1)]
    known = [(i, int(q), int(t)) for i, q, t in known]
    d = llm_spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(4)
    k = llm_spark.createDataFrame(known, "doc_id bigint, quality int, toxic int")
    assert rows(A.filter_audit(llm_spark, d, k, salt_rows=10)) == by_force(docs, known)


def test_equal_hashes_of_different_texts(llm_spark):
    """The exact text decides where a hash is shared."""
    rows_ = [(1, "p", 5, "one"), (2, "p", 5, "two"), (3, "p", 5, "one"), (4, "p", 6, "one"), (None, "p", 5, "two"), (2, "p", 5, "two")]
    d = llm_spark.createDataFrame(rows_, "doc_id bigint, part string, h bigint, text string")
    assert [tuple(r) for r in A.copies(llm_spark, d, d.drop("text")).collect()] == [(3, "p", 5)]


def test_long_texts_are_read_in_parts():
    rng = random.Random(9)
    texts = [sentence(rng, 3000), "", None, "x" * 900, "a b", sentence(rng, 500), "y" * 300 + " z"]
    seen = {}
    for data, off, row, more in tv.parts(pa.array(texts, pa.string()), limit=100):
        for k in range(len(off) - 1):
            seen.setdefault(row + k, []).append(data[off[k]:off[k + 1]].tobytes().decode())
    assert ["".join(seen[i]) for i in range(len(texts))] == [t or "" for t in texts]
    for i, t in enumerate(texts):
        assert [w for p in seen[i] for w in WORD.findall(p)] == WORD.findall(t or "")
        assert all(len(p) <= 100 or " " not in p[:-1] for p in seen[i])


def test_query_equals_its_sql(llm_spark):
    ok, said = compare(queries.QUERIES["op13_filter_audit"](llm_spark, SF), duck(SF), queries.ORACLES["op13_filter_audit"])
    assert ok, said
