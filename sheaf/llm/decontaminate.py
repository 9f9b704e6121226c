"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark's items.  For all windows of one
length a shift table holds, for every block of two words, how far the search
may jump when that block stands at the end of the current window; blocks that
end a window have shift 0 and select, by that suffix, the windows that may
stand here, which are then compared word by word.  Blocks of no window jump by
the window length less one, so most words of a clean text are never looked at.

Windows that are shorter, since their item is, have machines of their own.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.shared import map_texts, staged

WINDOW = 13
#: Bytes of benchmark text that one pass over the documents searches for.
BLOCK_BYTES = 16_000_000

#: Lower-cases A-Z and blanks every ASCII byte that is neither letter nor digit.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Words of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class WuManber:
    """Search for many windows of ``length`` words each."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.block = min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.windows: dict[bytes, dict[tuple[bytes, ...], set[str]]] = defaultdict(dict)

    def add(self, window: tuple[bytes, ...], item: str) -> None:
        last = self.length - 1
        for end in range(self.block - 1, self.length):
            block = b" ".join(window[end - self.block + 1 : end + 1])
            self.shift[block] = min(self.shift.get(block, self.jump), last - end)
        self.windows[b" ".join(window[-self.block :])].setdefault(window, set()).add(item)

    def find(self, text: list[bytes]) -> list[tuple[int, set[str]]]:
        """Start of every occurrence, with the items that hold the window."""
        found = []
        length, shift, jump, windows = self.length, self.shift, self.jump, self.windows
        pairs = self.block == 2
        at, n = length - 1, len(text)
        while at < n:
            block = text[at - 1] + b" " + text[at] if pairs else text[at]
            step = shift.get(block, jump)
            if step:
                at += step
                continue
            items = windows[block].get(tuple(text[at - length + 1 : at + 1]))
            if items:
                found.append((at - length + 1, items))
            at += 1
        return found


def machines(items: list[tuple[str, str | None]], window: int = WINDOW) -> list[WuManber]:
    """One machine for every length of window that the items have."""
    by_length: dict[int, WuManber] = {}
    for item, text in items:
        own = words(text)
        length = min(window, len(own))
        if not length:
            continue
        machine = by_length.setdefault(length, WuManber(length))
        for start in range(len(own) - length + 1):
            machine.add(tuple(own[start : start + length]), item)
    return list(by_length.values())


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``keep`` columns, ``n_words``, ``hits`` (word spans, end exclusive) and ``items`` (ids as text).

    One row per document, repeated documents included.  Null and empty texts
    have no words and no hits.  A null item text is no pattern; a null item id
    counts as the empty id.  The benchmark is searched in blocks of
    ``block_bytes``: each block is one pass over the documents, written as a
    table before the next block is fetched, so neither the driver nor a task
    holds more than one block's patterns.  An empty benchmark still gives all rows.
    """
    cleaned = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("words"),
    )
    total = cleaned.agg(F.sum(F.octet_length("words") + 100)).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks))
    out = docs.select(
        *keep,
        F.col(text).cast("string").alias("__text"),
        F.lit(None).cast("array<struct<start:int,end:int>>").alias("__hits"),
        F.lit(None).cast("array<string>").alias("__items"),
    )
    for number in range(n_blocks):
        rows = cleaned.filter(block == number).collect() if n_blocks > 1 else cleaned.collect()
        out = _search(out, [(r.item, r.words) for r in rows], keep, window, number == n_blocks - 1)
        if number < n_blocks - 1:
            out = staged(out)
    return out


def _search(df: DataFrame, items: list, keep: tuple[str, ...], window: int, last: bool) -> DataFrame:
    built: list[WuManber] = []

    def work(texts, hits, found):
        if not built:
            built.extend(machines(items, window))
        out = {"n_words": [], "__hits": [], "__items": []}
        for text, spans, known in zip(texts, hits, found, strict=True):
            own = words(text)
            spans, known = [(s["start"], s["end"]) for s in spans or []], set(known or [])
            for machine in built:
                for start, of in machine.find(own):
                    spans.append((start, start + machine.length))
                    known |= of
            out["n_words"].append(len(own))
            out["__hits"].append([{"start": a, "end": b} for a, b in covered(spans)])
            out["__items"].append(sorted(known))
        return out

    fields = "n_words bigint, __hits array<struct<start:int,end:int>>, __items array<string>"
    carried = keep if last else (*keep, "__text")
    done = map_texts(df, ["__text", "__hits", "__items"], work, fields, keep=carried)
    return done.withColumnsRenamed({"__hits": "hits", "__items": "items"}) if last else done.drop("n_words")


def n_hit(hits: Column) -> Column:
    """Words covered by the spans."""
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def contaminated(words: Column, hit: Column, share: int = 20) -> Column:
    """At least one word in ``share`` is part of an occurrence."""
    return (hit > 0) & (hit * share >= words)
