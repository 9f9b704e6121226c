"""Operators on pairs of documents or lines, against brute force, and the pipeline."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sheaf.llm import decontaminate, jaccard, line_dedup, linking, toxicity

SF = "/root/testdata/sf0.001"


def roots(items, links):
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def shingle_sets(docs, k):
    out = {}
    for i, text in docs:
        words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        out[i] = frozenset(tuple(words[s : s + k]) for s in range(max(1, len(words) - k + 1))) if words else frozenset()
    return out


def plain_components(docs, k, num, den):
    sets = shingle_sets(docs, k)
    ids = sorted(sets)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    return sets, roots(ids, links)


def varied(rng, n_base=25, n=220):
    """Texts of all lengths, with copies that differ a little, a chain and common passages."""
    word = lambda: rng.choice("abcdefghijkl") + rng.choice("aeiou") + rng.choice("mnrst")
    passage = [word() for _ in range(20)]
    bases = [[word() for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 20, 40, 90, 200]))] for _ in range(n_base)]
    out = [None, "", " \n", "one", "ONE", "a b c", "A  b\tC"]
    while len(out) < n:
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            at = rng.randrange(len(text) + 1)
            edit = rng.random()
            if edit < 0.4 and at < len(text):
                text[at] = word()
            elif edit < 0.7:
                text.insert(at, word())
            elif at < len(text) and len(text) > 1:
                del text[at]
        if rng.random() < 0.3:
            text += passage
        out.append(" ".join(text))
    return list(enumerate(out))


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100), (2, 60, 100)])
def test_jaccard_components_are_those_of_all_pairs(spark, k, num, den):
    docs = varied(random.Random(k))
    frame = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id BIGINT, text STRING, key INT, h STRING").repartition(6)
    sets, want = plain_components(docs, k, num, den)
    got = jaccard.jaccard_components(frame, words=k, num=num, den=den).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in got)
    kept = jaccard.without_copies(frame, words=k, num=num, den=den)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in want if want[i] == i or not sets[i]}


def test_jaccard_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert jaccard.jaccard_components(none).count() == 0
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (3, "x y z"), (None, "a b c d e f"), (3, None)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert len(got) == 5
    assert sorted(r["component_id"] for r in got) == [3, 3, 7, 7, 7]


def test_every_similar_pair_shares_a_key():
    rng = np.random.default_rng(11)
    for num, den in ((85, 100), (80, 100), (60, 100)):
        bands = jaccard.Bands(num, den)
        for _ in range(1500):
            n = int(rng.choice([2, 5, 6, 7, 9, 14, 30, 80, 300, 700]))
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            most = (den - num) * len(a) // num
            drop, add = rng.integers(0, most + 1), rng.integers(0, most + 1)
            b = np.union1d(rng.permutation(a)[drop:], rng.integers(0, 2**64, add, dtype=np.uint64))
            common = len(np.intersect1d(a, b))
            if common and common * den >= (len(a) + len(b) - common) * num and not np.array_equal(a, b):
                assert set(bands.keys(a)) & set(bands.keys(b)), (len(a), len(b), common)


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(12)
    links = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 260)] + [(300, 301), (301, 302), (302, 300)]
    links += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)]
    got = {r["id"]: r["component"] for r in linking.components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    items = {x for a, b in links if a != b for x in (a, b)}
    assert got == roots(items, links)
    assert linking.components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_linking_loses_no_link_between_components(spark):
    """Two groups that only touch through members which are not their leaders."""
    values = {1: 0, 2: 10, 3: 20, 4: 30, 5: 37, 6: 47, 7: 100, 8: 107}
    near = lambda a, b: abs(values[a] - values[b]) <= 10
    buckets = spark.createDataFrame([(9, 1, i) for i in values], "key BIGINT, lead BIGINT, id BIGINT")
    table = spark.createDataFrame(list(values.items()), "id BIGINT, v BIGINT")

    def verify(pairs):
        side = lambda c: table.select(F.col("id").alias(c), F.col("v").alias("v" + c))
        return pairs.join(side("a"), "a").join(side("b"), "b").filter("abs(va - vb) <= 10").select("a", "b")

    got = {r["id"]: r["component"] for r in linking.linked(buckets, verify).collect()}
    links = [(a, b) for a in values for b in values if a < b and near(a, b)]
    want = {i: c for i, c in roots(values, links).items() if any(i in link for link in links)}
    assert got == want


# --- lines


def plain_lines(docs, similarity=0.9):
    occurrences = [(i, n, line) for i, text in docs for n, line in line_dedup.lines_of(text)]
    distinct = list(dict.fromkeys(line for _, _, line in occurrences))
    keys = line_dedup.Blocks(line_dedup.DIFFER, line_dedup.BLOCKS).keys(line_dedup.simhashes(distinct))
    links = [
        (a, b)
        for a in range(len(distinct))
        for b in range(a + 1, len(distinct))
        if ((keys[a] == keys[b]) & (keys[a] != 0)).any() and line_dedup.alike(distinct[a], distinct[b], similarity)
    ]
    group = roots(range(len(distinct)), links)
    at = {line: i for i, line in enumerate(distinct)}
    seen, dropped = set(), defaultdict(set)
    for i, n, line in sorted(occurrences, key=lambda o: (o[0], o[1])):
        g = group[at[line]]
        if g in seen:
            dropped[i].add(n)
        seen.add(g)
    return dropped, links


def test_lines_are_dropped_as_by_comparing_all(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    lines = [" ".join(word() for _ in range(rng.choice([1, 3, 12, 40, 80]))) for _ in range(60)]
    docs = [(0, None), (1, ""), (2, " \n\n"), (3, "Hello 12\nhello 345\n\nbye")]
    for i in range(4, 90):
        own = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(lines).split(" ")
            if rng.random() < 0.4 and len(words) > 10:
                words[rng.randrange(len(words))] = word()
            own.append(" ".join(words))
        docs.append((i, "\n".join(own)))
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id BIGINT, text STRING, no INT, line INT").repartition(5)
    dropped, links = plain_lines(docs)
    assert links
    found = line_dedup.duplicate_lines(frame)
    assert {r["doc_id"]: set(r["lines"]) for r in found.collect()} == dict(dropped)
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_lines(frame, found).collect()}
    want = {}
    for i, text in docs:
        kept = [line for n, line in enumerate((text or "").split("\n")) if n not in dropped.get(i, ())]
        if i not in dropped:
            want[i] = text
        elif any(line.strip() for line in kept):
            want[i] = "\n".join(kept)
    assert got == want
    none = frame.limit(0)
    assert line_dedup.without_lines(none, line_dedup.duplicate_lines(none)).count() == 0


def test_bit_vectors_count_edits():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(14)
    for _ in range(1500):
        a, b = ("".join(rng.choices("abé", k=rng.randint(0, 14))) for _ in range(2))
        for most in range(8):
            assert line_dedup.edits_within(a, b, most) == (distance(a, b) <= most)


def test_simhashes_do_not_depend_on_what_stands_beside():
    rng = random.Random(15)
    lines = [" ".join(rng.choices(["aa", "b", "cc", "ddd", "e"], k=rng.randint(1, 30))) for _ in range(50)]
    lines.append("w " * 120_000 + "x")
    alone = [line_dedup.simhashes([line.strip()])[0] for line in lines]
    assert (line_dedup.simhashes([line.strip() for line in lines]) == np.array(alone)).all()


# --- pipeline


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece"]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        rows = before.select("doc_id", "text").collect()
        kept = {r["doc_id"]: r for r in after.collect()}
        if name != "SentencePiece":
            assert after.columns == docs.columns
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            assert set(kept) == {r["doc_id"] for r in rows if model.score(r["text"]) < toxicity.REJECT}
        elif name == "line dedup":
            dropped, _ = plain_lines([tuple(r) for r in rows])
            for r in rows:
                left = [x for n, x in enumerate((r["text"] or "").split("\n")) if n not in dropped.get(r["doc_id"], ())]
                gone = r["doc_id"] in dropped and not any(x.strip() for x in left)
                assert (r["doc_id"] in kept) == (not gone)
                if not gone:
                    assert kept[r["doc_id"]]["text"] == "\n".join(left)
                    assert kept[r["doc_id"]]["n_chars"] == len("\n".join(left))
        elif name == "n-gram Jaccard join":
            sets, want = plain_components([tuple(r) for r in rows], 5, 80, 100)
            assert set(kept) == {i for i in want if want[i] == i or not sets[i]}
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            built = decontaminate.machines([(str(i), t) for i, t in items])
            for r in rows:
                own = decontaminate.words(r["text"])
                spans = decontaminate.covered([(s, s + m.length) for m in built for s, _ in m.find(own)])
                hit = sum(b - a for a, b in spans)
                assert (r["doc_id"] in kept) == (not (hit and 20 * hit >= len(own)))
        else:
            assert set(kept) == {r["doc_id"] for r in rows}
            assert all(r["restored"] and r["n_pieces"] == len(r["ids"]) for r in kept.values())
        before = after
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == set(kept)


def test_stages_take_an_empty_table(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
