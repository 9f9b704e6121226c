"""Phrase collocations by counts of longest windows and a ROLLUP over their prefixes.

At every word begins one window: the word and those that follow it in its
piece, ``longest`` columns in all, padded behind the end of the piece.  These
windows are the only thing counted.  A phrase of k words occurs as often as it
is the prefix of a window, so Spark's ROLLUP over the columns, which sums
successively shorter prefixes, gives the counts of all phrases of all lengths,
and on its last level the number of words.

Words behind which a phrase cannot be frequent are padded too: a pass over
words and pairs, and one for each longer phrase below the longest, count these
by places of hash tables of fixed size, and only where a place stays below the least count, its phrases
are surely rare.  Each pass leaves out what holds a rare shorter phrase.
Places that are shared make windows longer than they need to be; no frequent
phrase is lost by them and no count is changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sheaf.llm.shared import free_shuffles, staged

#: Places of each table by which rare phrases are told; a power of two.  At most places / 64 longs come to the driver and are sent to the workers.
PLACES = 1 << 27
#: Words that a task holds before it counts them together.
CHUNK = 1_000_000
#: Parts that the candidates of a language are first ranked in, level by level.
PARTS = (1024, 16, 1)

#: What ends a piece, and what stands between words.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_END = bytes.maketrans(_ENDS, b"\xff" * len(_ENDS))
_K = tuple(np.random.default_rng(11).integers(0, 1 << 63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1))


class _Numbers(dict):
    """Numbers of words in the order of their coming; 0 ends a piece."""

    def __init__(self) -> None:
        super().__init__({b"\xff": 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, words by number, numbers with 0 behind each piece) of some texts at a time."""
    held: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
    n = 0

    def flushed():
        for lang, (numbers, parts) in held.items():
            yield lang, list(numbers), np.concatenate(parts)
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            # No byte of UTF-8 is 255, so it may stand for the end of a piece.
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            for part in _cut(raw.lower().translate(_TO_END)):
                words = part.replace(b"\xff", b" \xff ").split()
                words.append(b"\xff")
                numbers, parts = held.setdefault(lang, (_Numbers(), []))
                parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                n += len(words)
                if n >= CHUNK:
                    yield from flushed()
                    n = 0
    yield from flushed()


def _cut(text: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """A long text in parts that end where a piece does."""
    at = 0
    while (end := text.find(b"\xff", at + size)) >= 0:
        yield text[at:end]
        at = end + 1
    yield text[at:]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _K[0]
    return x ^ (x >> np.uint64(29))


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _place(codes: np.ndarray, places: int) -> np.ndarray:
    return (_mixed(codes * _K[1]) & np.uint64(places - 1)).astype(np.int64)


def _behind(x: np.ndarray) -> np.ndarray:
    """What stands one word further."""
    return np.append(x[1:], x.dtype.type(0))


class Places:
    """A bit for each of ``n`` places; only the longs with any are sent to the workers."""

    def __init__(self, n: int, at: np.ndarray, bits: np.ndarray) -> None:
        self.n, self.at, self.bits, self.table = n, at, bits, None

    def __getstate__(self) -> tuple:
        return self.n, self.at, self.bits, None

    def __setstate__(self, state: tuple) -> None:
        self.n, self.at, self.bits, self.table = state

    def __getitem__(self, place: np.ndarray) -> np.ndarray:
        if self.table is None:
            self.table = np.zeros(self.n >> 6, np.int64)
            self.table[self.at] = self.bits
        return (self.table[place >> 6] >> (place & 63) & 1).astype(bool)


def _levels(
    lang: str, words: list[bytes], numbers: np.ndarray, tables: list[Places | None], places: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For phrases of 1, 2 ... words: where those begin that may be frequent, and the places of what had to be looked up.

    The tables have a bit per place for phrases of 1, 2 ... words, or are not
    known; of phrases one word longer only the parts are looked up.
    """
    word = _hashes(lang, words)[numbers]
    code, may = word, numbers > 0
    for k in range(1, len(tables) + 2):
        at = np.flatnonzero(may)
        place = _place(code[at], places)
        if k <= len(tables) and tables[k - 1] is not None:
            may = np.zeros(len(numbers), bool)
            may[at] = tables[k - 1][place]
        yield may, place
        # One word longer: both parts must be frequent.
        may = may & _behind(may)
        word = _behind(word)
        code = _mixed(code * _K[2]) + word


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), F.col(text).cast("string").cast("binary"))


def _mapped(texts: DataFrame, fields: str, work) -> DataFrame:
    schema = StructType.fromDDL(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, numbers in _chunks(batches):
            columns = work(lang, words, numbers)
            for at in range(0, len(columns[0]), 65_536):
                cut = [c[at : at + 65_536] for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(cut, arrow, strict=True)], schema=arrow
                )

    return texts.mapInArrow(run, schema)


def frequent_places(texts: DataFrame, least: int, places: int, tables: list) -> Places:
    """A bit per place: whether the phrases there occur ``least`` times together.

    Without ``tables`` words and pairs are counted; with the broadcast bits of
    phrases of 1 to k words those of k + 1 words, of which both parts may be
    frequent.
    """

    def work(lang, words, numbers):
        known = [t.value for t in tables]
        levels = [at for _, at in _levels(lang, words, numbers, known or [None], places)]
        at, n = np.unique(levels[-1] if known else np.concatenate(levels), return_counts=True)
        return [at.astype(np.int32), n.astype(np.int64)]

    counted = _mapped(texts, "place int, n bigint", work)
    frequent = counted.groupBy("place").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    # Bits of 64 places in a long: what comes to the driver has at most places / 64 rows.
    bits = frequent.groupBy(F.shiftright("place", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, place & 63)")).alias("bits")
    )
    found = bits.toArrow()
    free_shuffles(texts.sparkSession)
    return Places(places, found.column("at").to_numpy(), found.column("bits").to_numpy())


def windows(docs: DataFrame, *, longest: int, least: int, lang: str = "lang", text: str = "text", places: int = PLACES) -> DataFrame:
    """(lang, window, n): counts of the longest windows, a row per window and chunk of a task; its words are joined by blanks, without the padding."""
    if places & (places - 1) or places > 1 << 31 or places < 64:
        raise ValueError("places is a power of two from 64 to 2**31")
    texts = _texts(docs, lang, text)
    send = docs.sparkSession.sparkContext.broadcast
    # Words and pairs share a table; longer phrases have one for each length.
    tables = [send(frequent_places(texts, least, places, []))] * 2
    while len(tables) < longest - 1:
        tables.append(send(frequent_places(texts, least, places, tables)))
    tables = tables[: longest - 1]

    def work(lang, words, numbers):
        begins = np.flatnonzero(numbers > 0)
        lead, code, padded = [], np.zeros(len(begins), np.int64), numbers
        for may, _ in _levels(lang, words, numbers, [t.value for t in tables], places):
            # A rare word counts as a word and nothing more; a window ends where no longer phrase can be frequent.
            column = np.where(may[begins], padded[begins], 0)
            # Windows so far get dense numbers, so that numbers of longer ones stay small.
            _, code = np.unique(code, return_inverse=True)
            code = code * len(words) + column
            lead.append(column)
            padded = _behind(padded)
        _, one, n = np.unique(code, return_index=True, return_counts=True)
        spelt = pa.array([b"", *words[1:]], pa.binary()).cast(pa.string(), safe=False)
        columns = [spelt.take(pa.array(column[one])) for column in lead]
        window = pc.utf8_rtrim(pc.binary_join_element_wise(*columns, " "), characters=" ")
        return [pa.array([lang] * len(one), pa.string()), window, n.astype(np.int64)]

    return _mapped(texts, "lang string, window string, n bigint", work)


def phrase_counts(docs: DataFrame, *, longest: int = 4, least: int = 30, **columns) -> DataFrame:
    """(lang, words, n): all phrases of up to ``longest`` words that occur ``least`` times, and without words a language's number of words.

    ``lang`` null is ``und``; a null text is the empty one.
    """
    names = [f"w{i + 1}" for i in range(longest)]
    # Tasks send each window some times; the prefixes are taken of the sums.
    counted = windows(docs, longest=longest, least=least, **columns).groupBy("lang", "window").agg(F.sum("n").alias("n"))
    word = F.split("window", " ")
    padded = [F.coalesce(F.get(word, F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(names)]
    rolled = counted.select("lang", *padded, "n").rollup("lang", *names).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    # Of a level all columns behind some are summed over; a prefix that ends in padding is no phrase.
    level = lambda k: (1 << (longest - k)) - 1
    real = F.col("level") == level(0)
    for k, name in enumerate(names, 1):
        real |= (F.col("level") == level(k)) & (F.col(name) != "") & (F.col("n") >= least)
    return rolled.filter(real).select("lang", F.filter(F.array(*names), lambda w: w.isNotNull()).alias("words"), "n")


def collocations(
    docs: DataFrame,
    *,
    longest: int = 4,
    least: int = 30,
    top: int = 2000,
    covered: tuple[int, int] = (80, 100),
    lang: str = "lang",
    text: str = "text",
    places: int = PLACES,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are runs without blank and tab in pieces that end at ``.,;:!?`` and
    line ends, A-Z in lower case.  A phrase of two words and more that occurs
    ``a`` >= ``least`` times is cut where floor(2,000,000 a / (l + r)) is least,
    l and r being the counts of its two parts, and has that score; the first
    such cut counts.  Phrases within a longer candidate that occurs at least
    ``covered`` times as often are left out.  All counts are exact.

    A null language is ``und``, a null text the empty one.  Repeated rows count
    each; an empty table gives no row; of other columns nothing is used.
    """
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    counts = staged(phrase_counts(docs, longest=longest, least=least, lang=lang, text=text, places=places))
    phrases = counts.filter(F.size("words") > 0).select("lang", "words", F.array_join("words", " ").alias("phrase"), "n")
    candidates = phrases.filter(F.size("words") > 1).withColumnRenamed("n", "a")
    part = lambda begin, n: F.array_join(F.slice("words", begin, n), " ")

    cuts = candidates.select(
        "lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.size("words")).alias("rest"))
    of = lambda name, n: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    both = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    cut = F.struct(F.expr("(2000000BD * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r)").alias("score"), "k", "l", "r")
    scored = both.groupBy("lang", "phrase", "a").agg(F.min(cut).alias("cut"))

    within = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.size("words") - 1),
                lambda n: F.transform(
                    F.sequence(F.lit(1), F.size("words") - n + 1),
                    lambda begin: F.array_join(F.slice("words", begin, n), " "),
                ),
            )
        )
    )
    held = (
        candidates.filter(F.size("words") > 2)
        .select("lang", "a", within.alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    is_covered = F.lit(covered[1]) * wide("longer") >= F.lit(covered[0]) * wide("a")
    left = scored.join(held, ["lang", "phrase"], "left").filter(~F.coalesce(is_covered, F.lit(False)))
    rows = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = best(rows, top)
    words = counts.filter(F.size("words") == 0).select("lang", "n")
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def best(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their rank, chosen part by part so that no task gets all rows of one."""
    order: list[Column] = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    for parts in PARTS:
        part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
        rows = rows.filter(F.col("rank") <= top)
    return rows.withColumn("rank", F.col("rank").cast("bigint"))
