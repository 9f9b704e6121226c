"""Sequences for training, packed by the dot-product heuristic of vector bin packing.

An example has a size in three dimensions: tokens, segments (one) and tokens
that bear loss.  A sequence has a limit in each.  It is filled by taking, again
and again, the example that fits and whose size, as shares of the limits, has
the largest dot product with the shares that are still free.  Examples that may
be cut fill what is left, and what remains at the end of a task goes to
sequences of a power of two tokens, which need no padding.

Each task packs the examples of its own partition, which are distributed like
any: no shuffle, no group, and a lost task is packed again from its rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from sheaf.llm.shared import SLICE
from sheaf.llm.tokens import OTHER, PATTERN, byte_alphabet


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most."""

    tokens: int = 2048
    segments: int = 512
    loss: int = 2048

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits are 1 or more")


#: Examples that are open at once in a task.
OPEN = 1024


@dataclass
class Example:
    """A run of tokens that is still to be placed; ``bears`` tells which bear loss, None for all."""

    key: object
    start: int
    end: int
    bears: np.ndarray | None = field(default=None, repr=False)  # running sums, one more than tokens

    def loss(self, start: int, end: int) -> int:
        return end - start if self.bears is None else int(self.bears[end] - self.bears[start])

    def reach(self, loss: int, tokens: int) -> int:
        """Tokens from the start within both bounds."""
        most = min(tokens, self.end - self.start)
        if self.bears is None:
            return min(most, loss)
        return min(most, int(np.searchsorted(self.bears, self.bears[self.start] + loss, "right")) - 1 - self.start)


class Packer:
    """Packs the examples of one task; yields (key, start, length, sequence, offset)."""

    def __init__(self, limits: Limits, cut: bool, first: int = 0, open_: int = OPEN) -> None:
        self.limits, self.cut, self.next, self.open = limits, cut, first, open_
        self.caps = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.waiting: list[Example] = []
        #: A row for each waiting example: its tokens, segments and tokens that bear loss.
        self.size = np.empty((open_, 3))

    def add(self, example: Example) -> Iterator[tuple]:
        if not self.cut and (
            example.end - example.start > self.limits.tokens or example.loss(example.start, example.end) > self.limits.loss
        ):
            raise ValueError(f"example {example.key!r} is beyond the limits of a sequence and may not be cut")
        # Of what is longer than a sequence, whole sequences go first.
        while self.cut and (n := example.reach(self.limits.loss, self.limits.tokens)) == self.limits.tokens:
            yield from self.emitted([(example, example.start, n)])
            example.start += n
            if example.start == example.end:
                return
        self.size[len(self.waiting)] = example.end - example.start, 1, example.loss(example.start, example.end)
        self.waiting.append(example)
        if len(self.waiting) >= self.open:
            while len(self.waiting) > self.open // 2:
                yield from self.filled()

    def finish(self) -> Iterator[tuple]:
        while self.waiting:
            yield from self.filled()

    def filled(self) -> Iterator[tuple]:
        """One sequence of the waiting examples."""
        waiting, size = self.waiting, self.size[: len(self.waiting)]
        shares = size / self.caps
        free = self.caps.copy()
        there = np.ones(len(waiting), bool)
        taken: list[tuple[Example, int, int]] = []
        while free[0] and free[1]:
            fits = there & (size <= free).all(axis=1)
            if not fits.any():
                break
            at = int(np.argmax(np.where(fits, shares @ (free / self.caps), -1.0)))
            there[at] = False
            free -= size[at]
            taken.append((waiting[at], waiting[at].start, int(size[at, 0])))
        if self.cut and free[0] and free[1] and there.any():
            # None fits whole: the longest gives what fills the sequence.
            at = int(np.argmax(np.where(there, size[:, 0], -1.0)))
            longest = waiting[at]
            if n := longest.reach(int(free[2]), int(free[0])):
                taken.append((longest, longest.start, n))
                longest.start += n
                size[at] = longest.end - longest.start, 1, longest.loss(longest.start, longest.end)
        self.size[: there.sum()] = size[there]
        self.waiting = [waiting[i] for i in np.flatnonzero(there)]
        yield from self.emitted(taken)

    def emitted(self, taken: list[tuple[Example, int, int]]) -> Iterator[tuple]:
        """The segments of one sequence; a short one is cut into sequences of powers of two, where that is allowed."""
        total = sum(n for _, _, n in taken)
        sizes = [total]
        if self.cut and total < self.limits.tokens:
            sizes = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        pieces = iter(taken)
        example, start, n = None, 0, 0
        for size in sizes:
            offset = 0
            while offset < size:
                if not n:
                    example, start, n = next(pieces)
                length = min(n, size - offset)
                yield example.key, start, length, self.next, offset
                start, n, offset = start + length, n - length, offset + length
            self.next += 1


@dataclass
class Source:
    """A document's ids from the place ``base`` on, as bytes."""

    doc: object
    ids: bytes
    total: int
    base: int = 0

    def crc32(self, start: int, n: int) -> int:
        at = 4 * (start - self.base)
        return zlib.crc32(memoryview(self.ids)[at : at + 4 * n])

    def forget(self, before: int) -> None:
        self.ids, self.base = self.ids[4 * (before - self.base) :], before


def sequence_base(partition: int) -> int:
    """The first sequence number of a task: each has 2**36 of its own."""
    return partition << 36


class Ids:
    """Token ids of whole texts by a byte-level BPE file, as bytes, four to an id, little-endian.

    Where the file's merges are in the order of their ids, tiktoken finds the
    same ids several times faster; texts with characters in whose classes the
    two libraries may differ are left to the file's own library.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # Ids of whole texts, as truncation and padding of the file would change them.
        self.library.no_truncation()
        self.library.no_padding()
        self.fast = self._ranked(path)

    @staticmethod
    def _ranked(path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind, cut = spec["model"], spec["pre_tokenizer"]
        if kind["type"] != "BPE" or spec.get("normalizer") or cut["type"] != "ByteLevel" or cut["add_prefix_space"]:
            return None
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in spec["added_tokens"]):
            return None
        alphabet, vocab = byte_alphabet(), kind["vocab"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in kind["merges"]]
        singles = [i for token, i in vocab.items() if len(token) == 1]
        if len(singles) != 256 or made != sorted(set(made)) or max(singles) > min(made, default=256):
            return None
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if token not in added}
        return tiktoken.Encoding(path, pat_str=PATTERN.pattern, mergeable_ranks=ranks, special_tokens=added)

    def of(self, text: str) -> bytes:
        if self.fast is not None and not OTHER.search(text):
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=4)
def ids_of(path: str) -> Ids:
    """One per worker process and file."""
    return Ids(path)


def pack_texts(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    *,
    limits: Limits = Limits(),
    doc_id: str = "doc_id",
    text: str = "text",
    open_: int = OPEN,
) -> DataFrame:
    """Pieces of the token ids of whole texts, ``end_id`` behind each, packed into sequences.

    A row per piece: ``doc_id``, ``start`` (ids of the document before it),
    ``length``, ``ids_crc32`` (of its ids as little-endian unsigned 32-bit
    integers), ``doc_tokens``, ``sequence_id`` and ``offset`` therein.  Every id
    bears loss.  Documents may be cut; each id is in exactly one piece.  All
    sequences have ``limits.tokens`` ids or a power of two.

    ``tokenizer`` is the path of a byte-level BPE ``.json`` file, present on
    every node.  A null text is the empty one, whose only id is ``end_id``.
    Repeated rows are packed each; an empty table gives no piece; of other
    columns nothing is used.
    """
    kind = docs.schema[doc_id].dataType
    fields = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    schema = StructType([StructField("doc_id", kind), *StructType.fromDDL(fields).fields])
    arrow = to_arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, True, sequence_base(TaskContext.get().partitionId()), open_)

        def rows(placed) -> list[tuple]:
            return [
                (source.doc, start, n, source.crc32(start, n), source.total, number, offset)
                for source, start, n, number, offset in placed
            ]

        def batch(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, type=f.type) for column, f in zip(zip(*made), arrow, strict=True)], schema=arrow
            )

        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                docs, texts = (whole.column(i).slice(at, SLICE).to_pylist() for i in range(2))
                made: list[tuple] = []
                for doc, value in zip(docs, texts, strict=True):
                    ids = ids_of(tokenizer).of(value or "")
                    source = Source(doc, ids + end, len(ids) // 4 + 1)
                    example = Example(source, 0, source.total)
                    made += rows(packer.add(example))
                    if example.start:
                        # Only what still waits is held, however long the document is.
                        source.forget(example.start)
                if made:
                    yield batch(made)
        if made := rows(packer.finish()):
            yield batch(made)

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, schema)


def pack_examples(
    examples: DataFrame,
    *,
    example_id: str = "example_id",
    bears_loss: str = "bears_loss",
    limits: Limits = Limits(),
    cut: bool = False,
    open_: int = OPEN,
) -> DataFrame:
    """Examples packed into sequences: ``example_id``, ``start``, ``length``, ``sequence_id``, ``offset``.

    ``bears_loss`` is an array with a boolean per token: whether it bears loss,
    as those of an answer do and those of a prompt do not.  A null flag does not.
    Examples are kept whole unless ``cut`` is set; then one beyond the limits
    is an error.  A null or empty array has no tokens and no piece.  Repeated
    rows are packed each; an empty table gives no piece.
    """
    kind = examples.schema[example_id].dataType
    fields = "start bigint, length bigint, sequence_id bigint, offset bigint"
    schema = StructType([StructField("example_id", kind), *StructType.fromDDL(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, cut, sequence_base(TaskContext.get().partitionId()), open_)

        def batch(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, type=f.type) for column, f in zip(zip(*made), arrow, strict=True)], schema=arrow
            )

        for whole in batches:
            made: list[tuple] = []
            for key, flags in zip(whole.column(0).to_pylist(), whole.column(1).to_pylist(), strict=True):
                if flags:
                    bears = np.concatenate([[0], np.cumsum([f is True for f in flags])])
                    made += packer.add(Example(key, 0, len(flags), bears))
            if made:
                yield batch(made)
        if made := list(packer.finish()):
            yield batch(made)

    return examples.select(F.col(example_id), F.col(bears_loss).cast("array<boolean>")).mapInArrow(run, schema)
