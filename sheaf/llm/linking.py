"""Links between items that share a bucket, and their connected components.

Nothing here pairs all items of a bucket: each item is first compared with the
leader of its bucket, items already in one component are not compared any
more, and only what then still meets in a bucket from different components is
compared pair by pair.  No true link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.shared import discard, map_texts, staged

#: Columns that :class:`TaskBuckets` makes.
FIELDS = "key bigint, lead bigint, id bigint"
#: Items that are compared as one array, and blocks that one meets at once.
BLOCK, MEETS = 1024, 8
#: Items of small blocks that are compared as one array.
TOGETHER = 64
#: Items of a bucket up to which it is refined, and in how many turns, each of which shuffles sketches of its own buckets.
SMALL, TURNS = 64, 4
#: Keys that a task remembers; beyond them its memory starts anew.
REMEMBERED = 250_000
#: Parts that packed keys are dealt into, as bits; entries that a task gathers before it hands them on.
PART_BITS, GATHERED = 12, 1 << 19
#: Bits of a key that packed entries keep, and items of one key among those gathered that stay packed.
KEY_BITS, HOT = 43, 32


class TaskBuckets:
    """Rows (key, lead, id) of one task, with hot keys gathered within the task.

    The first item of a key in a task stands for the key (no lead); the later
    ones name the first as their lead.  However many items share a key, a task
    sends only one row without lead, so no key gathers in one place later.
    """

    def __init__(self) -> None:
        self.first: dict[int, int] = {}
        self.clear()

    def clear(self) -> None:
        self.keys: list[int] = []
        self.leads: list[int | None] = []
        self.ids: list[int] = []

    def leads_of(self, item: int, keys: list[int]) -> list[int | None]:
        """The lead of an item for each of its keys."""
        first = self.first
        if len(first) + len(keys) > REMEMBERED:
            first.clear()
        found = [first.setdefault(key, item) for key in keys]
        return [None if lead == item else lead for lead in found]

    def add(self, item: int, keys: list[int]) -> None:
        self.leads += self.leads_of(item, keys)
        self.keys += keys
        self.ids += [item] * len(keys)

    def take(self) -> dict[str, list]:
        rows = {"key": self.keys, "lead": self.leads, "id": self.ids}
        self.clear()
        return rows


def shared_buckets(rows: DataFrame) -> DataFrame:
    """Rows of keys with two items and more, each with a lead: that of its task, or the key's smallest."""
    key = Window.partitionBy("key", "lead")
    both = rows.select("key", "lead", "id", F.min("id").over(key).alias("least"), F.max("id").over(key).alias("most"))
    found = both.filter(F.col("lead").isNotNull() | (F.col("least") < F.col("most")))
    return found.select("key", F.coalesce("lead", "least").alias("lead"), "id")


class PackedKeys:
    """Entries (key, item) of one task, packed by parts of the keys: 12 bytes an entry, not a row.

    Rows are (part, keys, ids, leads) of arrays as bytes.  Entries without
    leads hold the rest of a key and, as lowest bit, whether the key is hot.
    Of a key with more than ``HOT`` items among those gathered only the first
    is such an entry; the others name it as their lead, so however many items
    share a key, few of them gather in one place.
    """

    FIELDS = "part int, keys binary, ids binary, leads binary"

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.n = 0

    def add(self, items: np.ndarray, keys: np.ndarray) -> None:
        """A row of 64-bit keys for each item; 0 is none."""
        held = keys != 0
        self.keys.append(keys[held])
        self.ids.append(np.repeat(items, held.sum(axis=1)))
        self.n += len(self.keys[-1])

    def take(self) -> dict[str, list]:
        """Rows of what was gathered."""
        code = np.concatenate(self.keys).view(np.uint64) >> np.uint64(64 - KEY_BITS)
        ids = np.concatenate(self.ids)
        self.__init__()
        order = np.argsort(code, kind="stable")
        code, ids = code[order], ids[order]
        starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        sizes = np.diff(np.append(starts, len(code)))
        hot, first = np.repeat(sizes > HOT, sizes), np.zeros(len(code), bool)
        first[starts] = True
        out = {"part": [], "keys": [], "ids": [], "leads": []}
        named = hot & ~first
        if named.any():
            out["part"].append(int(code[starts[0]]) >> (KEY_BITS - PART_BITS))
            out["keys"].append(code[named].tobytes())
            out["ids"].append(ids[named].tobytes())
            out["leads"].append(np.repeat(ids[starts], sizes)[named].tobytes())
        code, ids, hot = code[~named], ids[~named], hot[~named]
        part = code >> np.uint64(KEY_BITS - PART_BITS)
        rest = ((code << np.uint64(1)) | hot.astype(np.uint64)).astype(np.uint32)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        for lo, hi in zip(starts, np.append(starts[1:], len(part)), strict=True):
            out["part"].append(int(part[lo]))
            out["keys"].append(rest[lo:hi].tobytes())
            out["ids"].append(ids[lo:hi].tobytes())
            out["leads"].append(None)
        return out


def _met(part: int, keys: list[bytes], ids: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of one part that two items and more share, where the items of each begin, and these, the smallest first."""
    rest, held = np.frombuffer(b"".join(keys), np.uint32), np.frombuffer(b"".join(ids), np.int64)
    order = np.argsort(rest >> 1, kind="stable")
    code, held, hot = rest[order] >> 1, held[order], rest[order] & 1
    same = code[1:] == code[:-1]
    shared = np.append(False, same) | np.append(same, False)
    code, held, hot = code[shared], held[shared], hot[shared]
    order = np.lexsort((-hot.astype(np.int8), held, code))
    code, held, hot = code[order], held[order], hot[order]
    # An item may come from several tasks; hot entries stand before its others.
    again = np.append(False, (code[1:] == code[:-1]) & (held[1:] == held[:-1])) if len(code) else np.zeros(0, bool)
    code, held, hot = code[~again], held[~again], hot[~again]
    if not len(code):
        return held, np.zeros(1, np.int32), held
    starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    sizes = np.diff(np.append(starts, len(code)))
    # Keys of the same items are one by the hash of these, but those whose items are also named elsewhere.
    whole = code[starts].astype(np.uint64) | np.uint64(part << (KEY_BITS - PART_BITS))
    name = np.where(np.maximum.reduceat(hot, starts) > 0, whole, _name(held, starts)).view(np.int64)
    many = sizes > 1
    return name[many], np.append(0, np.cumsum(sizes[many])).astype(np.int32), held[np.repeat(many, sizes)]


def packed_buckets(packed: DataFrame) -> DataFrame:
    """As :func:`shared_buckets`, of rows of :class:`PackedKeys`: keys that the same items share are one."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(names, starts, items):
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(items, pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), lists], names=["key", "items"])

        now, keys, ids = None, [], []
        for rows in batches:
            for row in rows.to_pylist():
                if row["leads"] is not None:
                    names, *own = (np.frombuffer(row[c], np.int64) for c in ("keys", "leads", "ids"))
                    yield batch(names, 2 * np.arange(len(names) + 1, dtype=np.int32), np.stack(own, axis=1).ravel())
                    continue
                if row["part"] != now and keys:
                    yield batch(*_met(now, keys, ids))
                    keys, ids = [], []
                now = row["part"]
                keys.append(row["keys"])
                ids.append(row["ids"])
        if keys:
            yield batch(*_met(now, keys, ids))

    # Whole buckets go through the shuffle, the first item of each as its lead.
    met = packed.repartition("part").sortWithinPartitions("part").mapInArrow(meet, "key bigint, items array<bigint>").distinct()
    return met.select("key", F.col("items")[0].alias("lead"), F.explode("items").alias("id")).select("key", "lead", "id")


def refined(
    buckets: DataFrame,
    sketches: DataFrame,
    may_be: Callable[[list, np.ndarray, np.ndarray], np.ndarray],
    classes: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``buckets`` without what can be no link: small ones fall into the groups of items that may be linked.

    ``sketches`` are (id, sketch) of all items; ``may_be`` takes a list of
    sketches and tells which pairs of places in it may be links.  Buckets of
    more than ``SMALL`` items are dealt into ``classes``, an array of numbers
    for each sketch of which items that may be linked share one; what is then
    still larger stays as it is.  The result is a staged table.
    """
    sketches = staged(sketches.dropDuplicates(["id"]))
    members = buckets.select("key", "id").unionByName(buckets.select("key", F.col("lead").alias("id"))).distinct()
    sized = staged(members.withColumn("n", F.count("*").over(Window.partitionBy("key"))))
    if classes is not None:
        whole = sized
        dealt = whole.filter(F.col("n") > SMALL).join(sketches, "id").select("key", "id", F.explode(classes(F.col("sketch"))).alias("class"))
        dealt = dealt.select(F.xxhash64("key", "class").alias("key"), "id").distinct()
        dealt = dealt.withColumn("n", F.count("*").over(Window.partitionBy("key")))
        sized = staged(whole.filter(F.col("n") <= SMALL).unionByName(dealt.select("key", "id", "n").filter("n > 1")))
        discard(whole)
    def split(ids, sketches):
        out = {"key": [], "lead": [], "id": []}
        sizes = np.array([len(own) for own in ids])
        starts = np.cumsum(sizes) - sizes
        pairs = {n: np.triu_indices(n, 1) for n in set(sizes.tolist())}
        left, right = (np.concatenate([pairs[n][k] + at for n, at in zip(sizes, starts)]) for k in (0, 1))
        near = may_be([s for own in sketches for s in own], left, right)
        items = np.array([i for own in ids for i in own], np.int64)
        # The first of a group stands for it; few rounds, as groups are small.
        group = np.arange(len(items))
        left, right = left[near], right[near]
        while (group[left] != group[right]).any():
            least = np.minimum(group[left], group[right])
            np.minimum.at(group, left, least)
            np.minimum.at(group, right, least)
        order = np.argsort(group, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
        n = np.diff(np.append(first, len(items)))
        own = items[order]
        name, lead = _name(own, first).view(np.int64), np.minimum.reduceat(own, first)
        many = np.repeat(n > 1, n)
        out["key"], out["lead"], out["id"] = np.repeat(name, n)[many], np.repeat(lead, n)[many], own[many]
        return out

    turns = []
    for turn in range(TURNS):
        # Keys are hashes; other bits than those that they are dealt into tasks by.
        own = sized.filter((F.col("n") <= SMALL) & (F.pmod(F.col("key"), F.lit(TURNS)) == turn))
        small = own.select("key", "id").join(sketches, "id")
        held = small.groupBy("key").agg(F.collect_list("id").alias("ids"), F.collect_list("sketch").alias("sketches"))
        turns.append(staged(map_texts(held, ["ids", "sketches"], split, FIELDS).distinct()))
    apart = reduce(DataFrame.unionByName, turns).distinct()
    large = sized.filter(F.col("n") > SMALL)
    large = large.join(large.groupBy("key").agg(F.min("id").alias("lead")), "key")
    found = staged(apart.unionByName(large.select("key", "lead", "id")))
    discard(sized, sketches, *turns)
    return found


def _name(items: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash for each run of items, whatever their order."""
    own = items.view(np.uint64)
    mixed = (own ^ (own >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ends of the edges (a, b): the smallest id reachable.

    Alternates large-star and small-star rounds; each reads and writes a table
    of no more rows than edges.
    """
    now = staged(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        before, now = now, staged(small.select("e.u", "e.v").filter("u <> v").distinct())
        discard(before)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def linked(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    sketches: DataFrame | None = None,
    may_link: Callable[[list, list], np.ndarray] | None = None,
    may_be: Callable[[list, np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """(id, component) of all items with a link; ``buckets`` as :func:`shared_buckets` gives them.

    ``verify`` takes distinct pairs (a, b), a < b, and returns those that are
    links.  Three rounds: every item with the most central item that it meets,
    the one with the largest buckets, of which copies are made rather than from
    each other; with the other leaders of its buckets, where these are still in
    another component; and the pairs of different components that meet in a
    bucket.  ``may_link`` tells by two lists of ``sketches`` (id, sketch: of any
    type) which of their pairs may be links, before these become rows;
    ``may_be`` tells it of pairs of places in one list, as for :func:`refined`.
    Tables that are made on the way are deleted.
    """
    pair = (F.least("lead", "id").alias("a"), F.greatest("lead", "id").alias("b"))
    members = buckets.select("key", "id").unionByName(buckets.select("key", F.col("lead").alias("id"))).distinct()
    sizes = members.groupBy("key").agg(F.count("*").alias("n"))
    central = staged(members.join(sizes, "key").groupBy("id").agg(F.sum("n").alias("weight")))
    weighed = members.join(central, "id")
    leads = weighed.groupBy("key").agg(F.max(F.struct("weight", "id")).alias("top"))
    stars = staged(
        weighed.join(leads, "key")
        .filter("id <> top.id")
        .groupBy("id", F.col("top.id").alias("lead"))
        .agg(F.max("top.weight").alias("weight"))
    )
    first = stars.groupBy("id").agg(F.max(F.struct("weight", "lead"))["lead"].alias("lead")).select(*pair).distinct()
    edges = staged(verify(first))
    label = components(edges)

    every = stars.select(*pair).unionByName(buckets.filter("lead <> id").select(*pair)).distinct()
    rest = _apart(every, label)
    more = staged(verify(rest.join(first, ["a", "b"], "left_anti")))
    both = edges.unionByName(more)
    label = staged(components(both))

    own = members.join(label, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    # By component of a key: how many items; the largest one is only compared with the others.
    parts = own.groupBy("key", "component").agg(F.count("*").alias("n"))
    keys = (
        parts.groupBy("key")
        .agg(F.count("*").alias("parts"), F.max(F.struct("n", "component"))["component"].alias("largest"))
        .filter("parts > 1")
        .select("key", "largest")
    )
    mixed = staged(own.join(keys, "key").select("key", "id", "component"))
    across = _across(mixed, sketches, may_link, may_be)
    last = staged(verify(across.join(every, ["a", "b"], "left_anti")))
    discard(central, stars, label, mixed)
    found = components(both.unionByName(last))
    discard(edges, more, last)
    return found


def _across(
    mixed: DataFrame,
    sketches: DataFrame | None,
    may_link: Callable[[list, list], np.ndarray] | None,
    may_be: Callable[[list, np.ndarray, np.ndarray], np.ndarray] | None,
) -> DataFrame:
    """Pairs (a, b) that meet in a key from different components and may be links.

    The items of a key are dealt into blocks of about ``BLOCK``, and every two
    blocks are compared as arrays: only pairs that may be links become rows.
    A block meets ``MEETS`` others at a time, so what is shuffled at once grows
    with the items, not with their pairs.
    """
    blocks = mixed.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = mixed.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    if sketches is None:
        placed = placed.withColumn("sketch", F.lit(None).cast("array<bigint>"))
    else:
        placed = placed.join(sketches.dropDuplicates(["id"]), "id")
    # So many tasks, however few bytes: the work grows with the pairs.
    dealt = (
        placed.repartition(int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "block")
        .groupBy("key", "blocks", "block")
        .agg(F.collect_list(F.struct("id", "component", "sketch")).alias("items"))
    )
    # A block meets itself and those after it; most keys have but one.
    alone = dealt.filter("blocks = 1").select("items", F.lit(None).cast(dealt.schema["items"].dataType).alias("others"), F.lit(True).alias("same"))
    dealt = dealt.filter("blocks > 1")
    most = blocks.agg(F.max("blocks")).first()[0] or 0

    def compare(left, right, same):
        out = {"a": [], "b": []}

        def together(rows):
            # Small blocks of several keys are compared as one array; only pairs of one key count.
            xs, ys = ([i for row in rows for i in row[side]] for side in (0, 1))
            # Blocks that all meet themselves have their sketches looked at once.
            twice = all(row[2] for row in rows)
            k, m = (np.repeat(np.arange(len(rows)), [len(row[side]) for row in rows]) for side in (0, 1))
            a, b = (np.array([i["id"] for i in side], np.int64) for side in (xs, ys))
            c, d = (np.array([i["component"] for i in side], np.int64) for side in (xs, ys))
            one = np.array([row[2] for row in rows], bool)[k]
            ok = (k[:, None] == m[None, :]) & (c[:, None] != d[None, :]) & (~one[:, None] | (a[:, None] < b[None, :]))
            if may_link is not None:
                ok &= may_link([i["sketch"] for i in xs], [i["sketch"] for i in ys])
            i, j = np.nonzero(ok)
            if may_be is not None:
                near = may_be([i["sketch"] for side in ((xs,) if twice else (xs, ys)) for i in side], i, j if twice else len(xs) + j)
                i, j = i[near], j[near]
            out["a"] += np.minimum(a[i], b[j]).tolist()
            out["b"] += np.maximum(a[i], b[j]).tolist()

        gathered, n = [], 0
        for row in zip(left, right, same, strict=True):
            row = row if row[1] is not None else (row[0], *row[::2])
            size = max(len(row[0]), len(row[1]))
            if gathered and n + size > TOGETHER:
                together(gathered)
                gathered, n = [], 0
            gathered.append(row)
            n += size
        if gathered:
            together(gathered)
        return out

    columns, fields = ["items", "others", "same"], "a bigint, b bigint"
    found = map_texts(alone, columns, compare, fields)
    if most > 1:
        dealt = staged(dealt)
        right = dealt.select("key", F.col("block").alias("with"), F.col("items").alias("others"))
        # Every two blocks of a ring meet within half of it.
        for first in range(0, most // 2 + 1, MEETS):
            steps = F.sequence(F.lit(first), F.lit(min(first + MEETS, most // 2 + 1) - 1))
            left = dealt.select("key", "items", "block", "blocks", F.explode(steps).alias("step")).filter("step <= blocks div 2")
            left = left.withColumn("with", F.pmod(F.col("block") + F.col("step"), F.col("blocks")))
            met = left.join(right, ["key", "with"]).select("items", "others", (F.col("step") == 0).alias("same"))
            found = found.unionByName(staged(map_texts(met, columns, compare, fields, rows=4).distinct()))
        discard(dealt)
    return found.distinct()


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    at = lambda c: label.select(F.col("id").alias(c), F.col("component").alias("c" + c))
    both = pairs.join(at("a"), "a", "left").join(at("b"), "b", "left")
    return both.filter(~F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))).select("a", "b")
