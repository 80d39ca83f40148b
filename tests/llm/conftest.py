import random

import pytest
from llm_texts import sentence

from pathlattice.session import build_session


@pytest.fixture(scope="session")
def llm_spark():
    return build_session(shuffle_partitions=4)


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source, score, key, node, _gone, Line): nulls, empty and blank texts, ties, repeated rows, equal ids,
    a very long text, and extra columns named like the operators' own."""
    rng = random.Random(5)
    base = "\n".join(sentence(rng, 30) for _ in range(6))
    near = base.replace("\n", " qqq\n", 1)
    texts = [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \t\r\n \x0b\x0c"), (None, base), (None, None),
             (7, sentence(rng, 20_000)), (8, "x"), (8, "x"), (9, "é ü  \U0001F600 a\tb\n\n c"), (9, "other text of the same id here"),
             (10, "one two three four"), (11, "one two three four five"), (12, "ONE two three four FIVE"),
             (13, base + "\n" + sentence(rng, 120)), (14, "a" * 70_000), (15, "\n".join(["same line of five words"] * 9))]
    return [(i, t, "en" if k % 3 else None, f"s{k % 2}" if k % 4 else None, 0.5, "k", 1, [1], k) for k, (i, t) in enumerate(texts)]


SCHEMA = ("doc_id bigint, text string, lang string, source string, score double, key string, node bigint, "
          "_gone array<int>, line int")


@pytest.fixture(scope="session")
def odd(llm_spark, odd_rows):
    return llm_spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(llm_spark):
    return llm_spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(llm_spark):
    return llm_spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 14)] + [(None, 1, 1), (3, None, None)],
                                     "doc_id bigint, quality int, toxic int")
