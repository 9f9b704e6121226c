"""Exact Jaccard self-join on word shingles by universe-partition pigeonhole.

The universe of shingle hashes is cut into segments, more of them the larger
the sets of a size band may differ.  Two sets of a band within the similarity
differ in at most H shingles, so of H + 1 segments one is equal in both: the
subsets of the segments are the keys of an index.  Some segments are also
indexed by their one-deletion neighbourhoods and then bear one difference; one
such segment stands for two plain ones and is larger.  Which segments are of
what kind is decided for each band by the cost of the rows that it makes and
of the false meetings that it lets happen.  A few segments more than needed
pay for those that tell nothing: sets with that few poor segments leave them
out of the index.  What meets is verified exactly on the whole sets.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.linking import TaskBuckets, linked, shared_buckets
from sheaf.llm.shared import discard, map_texts, staged

#: Words a worker remembers the hashes of.
REMEMBERED = 200_000

#: Parts of the universe of each of which a set has one bit, to tell sets apart cheaply.
PARTS = 1024

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3D4B5)


class WordHashes(dict):
    """64-bit hash of every word, computed once for each worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_WORDS = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``k`` words; one for fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    size = min(k, n)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out = out * _BASE + h[i : n - size + 1 + i]
    return np.unique(mixed(out))


def set_id(h: np.ndarray) -> int:
    """Signed 64-bit name of a set of hashes."""
    return xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63)


class Scheme:
    """Segments of one size band: ``plain`` of them, then ``loose`` ones with one-deletion neighbourhoods."""

    def __init__(self, low: int, high: int, differ: int, salt: int) -> None:
        self.low, self.high = low, high
        cost, self.plain, self.loose, self.slack = min(self.options(low, high, differ))
        n = self.plain + self.loose
        # A loose segment covers twice the hashes of a plain one.
        parts = np.array([1.0] * self.plain + [2.0] * self.loose)
        edges = np.concatenate([[0.0], np.cumsum(parts)]) / parts.sum()
        self.edges = np.array([min(int(e * 2.0**64), 2**64 - 1) for e in edges[:-1]], np.uint64)
        self.names = mixed(np.arange(1, n + 1, dtype=np.uint64) * _STEP + np.uint64(salt) * _BASE)

    @staticmethod
    def options(low: int, high: int, differ: int):
        """(cost, plain, loose, slack) of the divisions that bear ``differ`` differences."""
        size = (low + high) / 2
        need = differ + 1
        for slack in sorted({0, 1, 2, 3, 4 + need // 32, 4 + need // 16, 4 + need // 12}):
            for loose in sorted({0, 1, 2, (need + slack) // 4, (need + slack + 1) // 2}):
                plain = max(0, need + slack - 2 * loose)
                if plain + loose == 0 or 2 * loose > need + slack + 1:
                    continue
                mean = size / (plain + 2 * loose)
                rows = plain + loose * (1 + 2 * mean)
                # Poor segments of a set are about Poisson; beyond the slack all of them are indexed.
                poor = plain * (1 + mean) * math.exp(-mean)
                within = sum(math.exp(-poor) * poor**i / math.factorial(i) for i in range(min(slack, 100) + 1))
                # A poor segment meets what hundreds of rows cost, one of two shingles as much as two.
                false = 400 * poor * max(0.0, 1 - within) + 2 * plain * math.exp(-mean) * mean * mean / 2
                yield rows + false, plain, loose, slack

    def keys(self, h: np.ndarray) -> np.ndarray:
        """Index keys of a sorted set."""
        bounds = np.append(np.searchsorted(h, self.edges), len(h))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)])
        sums = (total[bounds[1:]] - total[bounds[:-1]]) * _STEP
        count = np.diff(bounds)
        plain = self.plain
        take = np.ones(plain, bool)
        poor = count[:plain] <= 1
        if poor.sum() <= self.slack:
            take = ~poor
        keys = [mixed(sums[:plain][take] + self.names[:plain][take])]
        for i in range(plain, plain + self.loose):
            part = h[bounds[i] : bounds[i + 1]]
            keys.append(mixed(np.append(sums[i : i + 1], sums[i] - part * _STEP) + self.names[i]))
        return np.unique(np.concatenate(keys))


class Bands:
    """Size bands for sets of similarity ``num`` / ``den`` and more.

    A set is compared, as the larger one, with sets of its band and the one
    below, so it is indexed under the schemes of both.
    """

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.schemes: list[Scheme] = []
        self.lows: list[int] = []
        self.next = 1

    def differ(self, n: int) -> int:
        """Shingles in which a set of ``n`` and a larger similar one can differ, at most."""
        return n * (self.den - self.num) // self.num

    def grow(self, n: int) -> None:
        while self.next <= n:
            low = self.next
            high = max(low, low * self.den // self.num)
            self.schemes.append(Scheme(low, high, self.differ(high), len(self.schemes)))
            self.lows.append(low)
            self.next = high + 1

    def keys(self, h: np.ndarray) -> list[int]:
        n = len(h)
        self.grow(n)
        band = int(np.searchsorted(self.lows, n, "right")) - 1
        own = [self.schemes[band]] if self.differ(self.schemes[band].high) else []
        if band and self.differ(self.schemes[band - 1].high) and n * self.num <= self.schemes[band - 1].high * self.den:
            own.append(self.schemes[band - 1])
        if not own:
            return []  # sets this small are similar only if they are equal
        return np.concatenate([s.keys(h) for s in own]).view(np.int64).tolist()


@lru_cache(maxsize=4)
def bands(num: int, den: int) -> Bands:
    return Bands(num, den)


def jaccard_components(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 4,
    num: int = 85,
    den: int = 100,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Two texts are linked if ``den`` * intersection >= ``num`` * union of their
    sets of distinct ``words``-word shingles (A-Z lower-cased, words between
    ASCII white space); shorter texts are one shingle, empty and null ones have
    none and are linked with nothing.  ``component_id`` is the smallest
    ``doc_id`` reachable by links; rows with equal sets share it, rows without
    links have their own.  Sets are compared by 64-bit hashes of shingles, and
    named by a 64-bit hash: two of n different sets get one name with a
    probability of about n * n / 4e19.

    Rows that repeat a ``doc_id`` all stay; an empty table gives an empty
    result.  Copies are one set from the start and never paired.
    """
    group = groups(docs, doc_id, text, words, num, den)
    least = group.filter("group is not null").groupBy("group").agg(F.min("doc").alias("least"))
    return group.join(least, "group", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("least", "doc").alias("component_id"),
    )


def without_copies(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 4,
    num: int = 85,
    den: int = 100,
) -> DataFrame:
    """``docs`` with one document of every component: that of the smallest id, then text hash.

    Documents without shingles all stay.  Rows that repeat both id and text
    are one document and stay or go together.
    """
    group = groups(docs, doc_id, text, words, num, den).filter("group is not null")
    place = F.struct("doc", "mark")
    first = group.groupBy("group").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    more = (
        group.join(first.select("group", "first"), "group")
        .filter(~place.eqNullSafe(F.col("first")))
        .select(F.col("doc").alias("__doc"), F.col("mark").alias("__mark"))
        .distinct()
    )
    return docs.join(
        more, docs[doc_id].eqNullSafe(more["__doc"]) & (text_mark(docs[text]) == more["__mark"]), "left_anti"
    )


def text_mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def groups(docs: DataFrame, doc_id: str, text: str, words: int, num: int, den: int) -> DataFrame:
    """(doc, mark, n, group) of every row: id, text hash, shingles, and what names its component; null without shingles."""
    base = docs.select(
        F.col(doc_id).alias("doc"), text_mark(F.col(text)).alias("mark"), F.col(text).cast("string").alias("text")
    )

    measured = staged(measure(base, words, num, den))
    key = F.explode(F.arrays_zip("keys", "leads")).alias("k")
    rows = measured.select("set", key).select(F.col("k.keys").alias("key"), F.col("k.leads").alias("lead"), F.col("set").alias("id"))
    buckets = staged(shared_buckets(rows))
    sets = staged(measured.select("doc", "mark", "n", "set"))
    discard(measured)
    wanted = buckets.select("id").unionByName(buckets.select(F.col("lead").alias("id"))).distinct()
    whole = whole_sets(base, sets, wanted, words)
    label = linked(
        buckets,
        lambda pairs: similar(pairs, whole, num, den),
        sketches(whole),
        lambda x, y: may_be_similar_blocks(x, y, num, den),
    )
    discard(buckets, whole)
    return sets.join(label.select(F.col("id").alias("set"), "component"), "set", "left").select(
        "doc", "mark", "n", F.coalesce("component", "set").alias("group")
    )


def measure(base: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(doc, mark, n, set, keys, leads) of every text: shingles, name of their set, index keys and their leads.

    Copies within a task have keys once.
    """
    seen: set[int] = set()
    buckets = TaskBuckets()

    def work(texts):
        index_of = bands(num, den)
        out = {"n": [], "set": [], "keys": [], "leads": []}
        for value in texts:
            h = shingles(value, words)
            name = set_id(h) if len(h) else None
            keys: list[int] = []
            if name is not None and name not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
                keys = index_of.keys(h)
            for column, found in zip(out.values(), (len(h), name, keys, buckets.leads_of(name, keys)), strict=True):
                column.append(found)
        return out

    return map_texts(base, ["text"], work, "n bigint, set bigint, keys array<bigint>, leads array<bigint>", keep=("doc", "mark"))


def whole_sets(base: DataFrame, sets: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, n, bits, h): size, parities and whole sets of the wanted ids, each from one of its texts.

    A bit tells whether a set has an odd number of shingles in a part of the
    universe: sets differ in no fewer shingles than bits.
    """
    texts = (
        sets.join(wanted, sets["set"] == wanted["id"])
        .groupBy("id")
        .agg(F.min(F.struct("doc", "mark")).alias("of"))
        .select("id", F.col("of.doc").alias("doc"), F.col("of.mark").alias("mark"))
    )

    def build(names, texts):
        out = {"id": names, "n": [], "bits": [], "h": []}
        for value in texts:
            h = shingles(value, words)
            out["n"].append(len(h))
            odd = np.bincount((h >> np.uint64(54)).astype(np.int64), minlength=PARTS) & 1
            out["bits"].append(np.packbits(odd.astype(np.uint8)).view(np.int64).tolist())
            out["h"].append(h.view(np.int64).tolist())
        return out

    same = base["doc"].eqNullSafe(texts["doc"]) & (base["mark"] == texts["mark"])
    picked = base.join(texts, same).select("id", "text")
    # Rows that repeat both id and text give a set again; pairs are made distinct behind it.
    return staged(map_texts(picked, ["id", "text"], build, "id bigint, n bigint, bits array<bigint>, h array<bigint>"))


def may_be_similar(a: Column, b: Column, num: int, den: int) -> Column:
    """Whether two sets can be similar by what needs no set: sizes and parities (structs of n and bits)."""
    n = a["n"] + b["n"]
    apart = F.lit(0)
    for i in range(PARTS // 64):
        apart = apart + F.bit_count(a["bits"][i].bitwiseXOR(b["bits"][i]))
    # Sets that differ in d shingles share (n - d) / 2 of (n + d) / 2.
    return (F.least(a["n"], b["n"]) * den >= F.greatest(a["n"], b["n"]) * num) & ((n - apart) * den >= (n + apart) * num)


def sketches(whole: DataFrame) -> DataFrame:
    """(id, sketch): size and parities in one array, for :func:`may_be_similar_blocks`."""
    return whole.select("id", F.concat(F.array("n"), F.col("bits")).alias("sketch"))


def may_be_similar_blocks(xs: list, ys: list, num: int, den: int) -> np.ndarray:
    """As :func:`may_be_similar`, for all pairs of two lists of sketches."""
    x, y = np.array(xs, np.int64), np.array(ys, np.int64)
    n = x[:, None, 0] + y[None, :, 0]
    apart = np.zeros(n.shape, np.int64)
    for i in range(1, x.shape[1]):
        apart += np.bitwise_count((x[:, None, i] ^ y[None, :, i]).view(np.uint64))
    sizes = np.minimum(x[:, None, 0], y[None, :, 0]) * den >= np.maximum(x[:, None, 0], y[None, :, 0]) * num
    return sizes & ((n - apart) * den >= (n + apart) * num)


def similar(pairs: DataFrame, whole: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of sets within the similarity; whole sets are joined only to those that may be."""
    small = lambda c: whole.select(F.col("id").alias(c), F.struct("n", "bits").alias("s" + c))
    held = lambda c: whole.select(F.col("id").alias(c), F.col("h").alias("h" + c))
    near = (
        pairs.join(small("a"), "a")
        .join(small("b"), "b")
        .filter(may_be_similar(F.col("sa"), F.col("sb"), num, den))
        .select("a", "b", F.col("sa.n").alias("na"), F.col("sb.n").alias("nb"))
        .distinct()
    )
    both = near.join(held("a"), "a").join(held("b"), "b")
    common = F.size(F.array_intersect("ha", "hb"))
    return both.filter(common * den >= (F.col("na") + F.col("nb") - common) * num).select("a", "b").distinct()
