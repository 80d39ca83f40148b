"""Invented texts for the tests of the training-data operators."""

import random

SF = "/root/testdata/sf0.01"


def words(rng: random.Random, n: int) -> list[str]:
    syllables = "ka lo mi ren tu vas zor pel dri fa nog shi".split()
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(words(rng, n))
