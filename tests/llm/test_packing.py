"""Packed sequences: every id once, within all limits, little padding."""

import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from sheaf.llm import packing, queries
from sheaf.llm.packing import Example, Limits, Packer
from sheaf.llm.shared import table

BPE = str(public_tokenizers.path("byte_bpe_50k.json"))


@lru_cache(1)
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def library_ids(text):
    return np.array([*library().encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check_pieces(rows, texts):
    """Pieces of documents with ids 0, 1 ...; gives the sequences' lengths."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids, at = library_ids(text), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    lengths = []
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        lengths.append(at)
    return lengths


def test_the_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    rows = queries.QUERIES["op12_packing"](spark, sf).collect()
    assert sorted(docs) == list(range(len(docs)))
    lengths = check_pieces(rows, [docs[i] for i in range(len(docs))])
    # No padding: full, or a power of two.
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)
    assert sum(n == 2048 for n in lengths) >= 0.8 * len(lengths)


def test_odd_texts(spark):
    rng = random.Random(3)
    alphabet = "aä é\n\t  0١'st.,<|>endofx漢😀‍\x1c\x85 "
    texts = [None, "", " ", "  ", "a  b", " a ", "x \n y", "<|endoftext|>", "a <|endoftext|> b  ", "w" * 9000, "ab c " * 20_000]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 300))) for _ in range(400)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, ids STRING, start INT")
    limits = Limits(tokens=256, segments=4, loss=200)
    rows = packing.pack_texts(df, BPE, 1, limits=limits, open_=50).collect()
    lengths = check_pieces(rows, texts)
    # The limit of segments may end a sequence early, at a power of two; that of loss always does before 256.
    assert all(n <= 200 for n in lengths)
    per = defaultdict(int)
    for r in rows:
        per[r["sequence_id"]] += 1
    assert max(per.values()) <= 4


def test_both_libraries_give_the_same_ids():
    """On every character that the faster one gets, and on strings of vocabulary entries."""
    from sheaf.llm.tokens import OTHER

    ids = packing.ids_of(BPE)
    assert ids.fast is not None
    own = [c for c in map(chr, range(0x20000)) if not 0xD800 <= ord(c) < 0xE000 and not OTHER.search(c)]
    rng = random.Random(6)
    values = ["".join(f"a{c}b {c}{c} 1{c}\n" for c in own[i : i + 50]) for i in range(0, len(own), 50)]
    values += ["".join(rng.choices(own, k=40)) for _ in range(2000)]
    tokens = [library().decode([i]) for i in rng.sample(range(50256), 5000)]
    values += [v for _ in range(5000) if not OTHER.search(v := "".join(rng.choices(tokens, k=rng.randint(1, 12))))]
    for value in values:
        assert ids.fast.encode_to_numpy(value, allowed_special="all").tolist() == library().encode(value, add_special_tokens=False).ids


def test_tables_without_rows_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id BIGINT, text STRING")
    rows = packing.pack_texts(df, BPE, 1).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 2 * len(library_ids("a b"))
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == 1
    assert packing.pack_texts(df.limit(0), BPE, 1).collect() == []


def sequences(placed):
    out = defaultdict(list)
    for key, start, n, number, offset in placed:
        out[number].append((key, start, n, offset))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_whole_examples_within_all_limits(seed):
    rng = random.Random(seed)
    limits = Limits(tokens=100, segments=6, loss=40)
    sizes = {i: (n := rng.randint(1, 60), rng.randint(0, min(n, 40))) for i in range(500)}
    packer = Packer(limits, False, open_=64)
    placed = []
    for i, (n, loss) in sizes.items():
        bears = np.concatenate([[0], np.cumsum([1] * loss + [0] * (n - loss))])
        placed += packer.add(Example(i, 0, n, bears))
    placed += packer.finish()
    assert sorted(p[0] for p in placed) == list(sizes)
    found = sequences(placed)
    for own in found.values():
        assert sum(n for _, _, n, _ in own) <= 100 and len(own) <= 6
        assert sum(sizes[k][1] for k, *_ in own) <= 40
    # No fewer sequences are possible than the tightest limit asks for.
    least = max(sum(n for n, _ in sizes.values()) / 100, len(sizes) / 6, sum(x for _, x in sizes.values()) / 40)
    # First fit in the order of coming, for comparison.
    bins = []
    for n, loss in sizes.values():
        for b in bins:
            if b[0] + n <= 100 and b[1] + 1 <= 6 and b[2] + loss <= 40:
                b[0] += n; b[1] += 1; b[2] += loss  # noqa: E702
                break
        else:
            bins.append([n, 1, loss])
    assert least <= len(found) <= 1.25 * least and len(found) <= 1.03 * len(bins)


def test_each_choice_has_the_largest_dot_product():
    """Against a plain version of the heuristic, bin by bin."""
    rng = random.Random(8)
    limits = Limits(tokens=50, segments=5, loss=30)
    items = [(i, rng.randint(1, 50)) for i in range(60)]
    items = [(i, n, rng.randint(0, min(n, 30))) for i, n in items]
    packer = Packer(limits, False, open_=1000)
    for i, n, loss in items:
        list(packer.add(Example(i, 0, n, np.concatenate([[0], np.cumsum([1] * loss + [0] * (n - loss))]))))
    got = [[k for k, *_ in own] for own in sequences(packer.finish()).values()]
    left, want = list(items), []
    while left:
        free, own = [50, 5, 30], []
        while fits := [x for x in left if x[1] <= free[0] and free[1] >= 1 and x[2] <= free[2]]:
            dot = lambda x: x[1] / 50 * free[0] / 50 + 1 / 5 * free[1] / 5 + x[2] / 30 * free[2] / 30  # noqa: E731, B023
            most = max(map(dot, fits))
            x = next(x for x in fits if dot(x) >= most - 1e-12)
            left.remove(x)
            own.append(x[0])
            free = [free[0] - x[1], free[1] - 1, free[2] - x[2]]
        want.append(own)
    assert got == want


def test_examples_of_a_table(spark):
    """Prompts bear no loss, answers do; cut examples keep every token."""
    rng = random.Random(2)
    rows = [(i, [rng.random() < 0.4 for _ in range(rng.randint(1, 300))]) for i in range(200)]
    rows += [(200, None), (201, []), (202, [None, True])]
    df = spark.createDataFrame(rows, "example_id INT, bears_loss ARRAY<BOOLEAN>")
    flags = dict(rows)
    limits = Limits(tokens=128, segments=5, loss=48)
    got = packing.pack_examples(df, limits=limits, cut=True).collect()
    per, places = defaultdict(list), defaultdict(list)
    for r in got:
        per[r["sequence_id"]].append(r)
        places[r["example_id"]] += range(r["start"], r["start"] + r["length"])
    for own in per.values():
        assert sum(r["length"] for r in own) <= 128 and len(own) <= 5
        assert sum(flags[r["example_id"]][r["start"] : r["start"] + r["length"]].count(True) for r in own) <= 48
    assert {k: sorted(v) for k, v in places.items()} == {k: list(range(len(f))) for k, f in rows if f}
    with pytest.raises(Exception, match="beyond the limits"):
        packing.pack_examples(df, limits=limits).collect()
