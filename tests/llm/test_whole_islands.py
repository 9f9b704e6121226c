"""Segments of long islands are found wherever they stand."""

import random

from sheaf.llm import pii


def test_long_islands_are_not_cut():
    model = pii.Field({("phone", "shape=9-9-9"): 20.0, ("phone", "bias"): -10.0})
    rng = random.Random(41)
    d = lambda n: "".join(rng.choices("0123456789", k=n))
    numbers = [f"{d(3)}-{d(3)}-{d(4)}" for _ in range(300)]
    text = " ; ".join(numbers)
    assert len(pii.islands(text)) == 1
    got = [text[a:b] for a, b, _ in model.find(text)]
    assert got == numbers


def test_a_very_long_island_is_decoded():
    model = pii.Field({("ip", "octets"): 20.0, ("ip", "bias"): -10.0})
    text = "1.2.3.4 , " * 2000
    assert len(pii.islands(text)[0]) > 15_000
    assert len(model.find(text)) == 2000
