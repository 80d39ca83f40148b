"""Decontamination on adjacent short rows, and by length of item and kind of edit."""

import random

import pyarrow as pa
import pytest
from llm_texts import sentence
from test_recall import edited

from pathlattice.llm import decontaminate as D
from pathlattice.llm import textvec as tv


def found(items, texts):
    """Texts with a leak of any item."""
    listed = D.item_words(items)
    index = D.Index.of(listed)
    return {b.lo + d for b in tv.blocks(pa.array(texts), space=tv.NOT_ALNUM) for d, _ in D.leaks_of_block(b, listed, index)}


@pytest.mark.parametrize("n, cut", [(20, 0), (20, 4), (40, 8), (40, 10)])
def test_adjacent_copies_get_one_answer(n, cut):
    rng = random.Random(n + cut)
    lost = 0
    for _ in range(20):
        item = sentence(rng, n)
        copy = " ".join(edited(rng, item.split(), cut, "delete"))
        hits = found([item], [copy] * 20 + ["nothing of it here"])
        assert hits <= set(range(20))
        lost += len(hits) not in (0, 20)
    assert lost == 0


@pytest.mark.parametrize("kind", ["replace", "delete", "insert", "mixed"])
@pytest.mark.parametrize("n", [8, 20, 40, 80, 200])
def test_every_item_a_quarter_edited_is_found(n, kind):
    rng = random.Random(n)
    items = [sentence(rng, n) for _ in range(60)]
    texts = []
    for item in items:
        w, left = item.split(), D.tau(n)
        for what in ("replace", "delete", "insert") if kind == "mixed" else (kind,):
            w = edited(rng, w, left if what == kind else min(left, -(-D.tau(n) // 3)), what)
            left -= min(left, -(-D.tau(n) // 3))
        texts.append(" ".join([sentence(rng, 30), *w, sentence(rng, 30)]))
    assert found(items, texts) == set(range(60))
    assert found(items, [sentence(rng, n) for _ in range(20)]) == set()
