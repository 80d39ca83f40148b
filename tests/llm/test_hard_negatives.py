"""Hard negatives against scoring all rows, and the intervals against exact scores."""

import math

import numpy as np
import pytest
from llm_texts import SF

from pathlattice.checks import compare, duck
from pathlattice.llm import hard_negatives as H
from pathlattice.llm import queries

SCHEMA = "vec_id bigint, embedding array<double>, label int, points int, akey string"


def by_force(rows, every=100, n_pos=5, n_neg=5, low=80):
    part = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        part.append((i, [max(min(math.floor(256 * x), 2**63 - 1), -2**63) for x in v], label))
    out = []
    for i, v, label in part:
        if i % every:
            continue
        scored = [(max(min(sum(a * b for a, b in zip(v, w)), H.LIMIT), -H.LIMIT), j, m) for j, w, m in part]
        pos = sorted(((s, j) for s, j, m in scored if m == label and j != i), key=lambda x: (-x[0], x[1]))[:n_pos]
        for ps, pid in pos:
            neg = sorted(((s, j) for s, j, m in scored if m != label and low * ps <= 100 * s <= 100 * ps),
                         key=lambda x: (-x[0], x[1]))[:n_neg]
            out += [(i, pid, r, j, ps, s) for r, (s, j) in enumerate(neg, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, v, m, 1, "x") for i, v, m in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in H.mine(spark, df, **more).collect())


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_intervals_hold_and_tell_rows_apart(dim):
    rng = np.random.default_rng(dim)
    rows = np.floor(256 * rng.standard_normal((400, dim)) / np.sqrt(dim)).astype(np.int64)
    rows[:50] = rows[50:100] + rng.integers(-9, 9, (50, dim))
    rows[100:110] = 0
    anchors = np.concatenate([rows[:40], np.zeros((1, dim), np.int64), 1000 * rows[:3]])
    low, high = H.Planes(anchors.astype(float)).interval(H.Codes(rows.astype(float)), np.arange(400), np.arange(len(anchors)))
    exact = anchors @ rows.T
    assert (low <= exact).all() and (exact <= high).all()
    if dim == 64:  # the interval must be worth something: it refutes most of the unrelated rows for the close score of a near copy
        close = np.sort(exact[:40], axis=1)[:, -2:-1]
        assert (high[:40] < close).mean() > 0.3


def test_odd_rows(llm_spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 6)).round(3).tolist()
    rows = [(100 * (i % 4) if i < 8 else i, v, i % 3) for i, v in enumerate(base)]
    rows += rows[:3] + [(700, [0.5] * 6, 1), (701, [0.5] * 6, 1), (702, [0.5] * 6, 2), (703, [0.5] * 6, 2)]  # repeats and ties
    rows += [(None, [1.0] * 6, 1), (800, None, 1), (801, [1.0, None], 1), (802, [nan], 1), (803, [inf, 1.0], 2), (804, [1.0], None)]
    rows += [(900, [1.0, 2.0], 1), (901, [], 2), (1000, [], 1), (902, [0.3] * 11, 2), (1100, [1e300, 1.0], 0), (905, [1e200], 0),
             (906, [3e17, 1.0], 1), (1200, [0.0] * 6, 2)]
    assert mined(llm_spark, rows) == by_force(rows)
    assert mined(llm_spark, rows, group_rows=7) == by_force(rows)
    assert mined(llm_spark, rows, n_positives=2, n_negatives=3, low_percent=33, anchor_every=5) == by_force(rows, 5, 2, 3, 33)
    assert mined(llm_spark, []) == [] == mined(llm_spark, [(3, [1.0], 1), (100, [1.0], 1)])


def test_one_label_holds_most_rows(llm_spark):
    rng = np.random.default_rng(4)
    center = rng.standard_normal(16)
    v = center + 0.6 * rng.standard_normal((900, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(i, x, 0 if i % 10 else 1 + i // 10 % 40) for i, x in enumerate(v.tolist())]
    assert mined(llm_spark, rows, group_rows=200, anchor_every=30) == by_force(rows, 30)


def test_query_equals_its_sql(llm_spark):
    ok, said = compare(queries.QUERIES["op11_hard_negatives"](llm_spark, SF), duck(SF), queries.ORACLES["op11_hard_negatives"])
    assert ok, said
