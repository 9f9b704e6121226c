"""Collocations against a plain version in Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from sheaf.llm import collocations

UPPER = {c: c + 32 for c in range(65, 91)}


def plain(rows, longest, least, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        total[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                100 * b >= 80 * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in candidates.items()
            )
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def frame(spark, rows):
    # Names that the operator uses itself.
    return spark.createDataFrame([(*r, "x", 3, 4) for r in rows], "lang STRING, text STRING, phrase STRING, n INT, rank INT")


@pytest.mark.parametrize("places", [64, 1 << 20])
def test_random_texts(spark, places):
    """Also where nearly all words share a place and none is told to be rare."""
    rng = random.Random(places)
    words = ["a", "b", "C", "the", "é", "naïve", "d'e", "\x00", " ", "😀", "(x)", "r1", "r2"] + [f"w{i}" for i in range(40)]
    rows = []
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\x0b"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", None, "und", ""]), text))
    rows += [("en", "the a b c the a b") for _ in range(40)]
    rows += [("fr", None), ("en", ""), ("fr", "."), (None, "The A b C"), ("en", "a " * 5000)]
    got = collocations.collocations(frame(spark, rows), least=12, top=30, places=places)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got.columns == names
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 4, 12, 30)


def test_counts_of_shorter_windows_and_ties(spark):
    rows = [("en", "a b. b a. c d e. c d e")] * 3
    got = collocations.collocations(frame(spark, rows), longest=3, least=3, top=3)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 3, 3, 3)


def test_tables_without_words(spark):
    for rows in ([], [("en", None), (None, " ,\n")]):
        df = frame(spark, rows or [("en", "")])
        df = df if rows else df.limit(0)
        assert collocations.collocations(df, least=1).collect() == []


def test_products_pass_64_bits(spark):
    """The score is exact where 2,000,000 a needs more than 64 bits."""
    a = 9 * 10**18
    df = spark.createDataFrame([(a, a, a + 1)], "a BIGINT, l BIGINT, r BIGINT")
    score = df.selectExpr("(2000000BD * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r) AS s").first()["s"]
    assert score == 2_000_000 * a // (2 * a + 1)
