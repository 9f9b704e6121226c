"""Unigram encoding and decoding over the pieces of a SentencePiece model file.

Pieces are held in a double-array trie over their UTF-8 bytes.  A text's white
space is marked, and the segmentation of largest total log score is found by
the Viterbi algorithm; characters that no piece covers become byte pieces.
Decoding joins the pieces, bytes included, and turns marks into blanks.

The log scores are the file's where it is a unigram model.  A file of merge
pieces holds ranks instead; a piece's log score is then that of its rank in a
Zipf-Mandelbrot law, rounded to 1/1024 so that sums are exact.
"""

from __future__ import annotations

import math
import re
import struct
from array import array
from functools import lru_cache
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame

from sheaf.llm.shared import map_texts

MARK = "▁"
#: Piece types of the file format, and what an unknown character costs below the worst piece.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM = 1
UNKNOWN_PENALTY = 10.0
#: Offset of the rank in the Zipf-Mandelbrot law.
RANK_OFFSET = 2.7
#: Segments a worker remembers, and their length.
REMEMBERED, REMEMBERED_LENGTH = 400_000, 32


def fields(raw: bytes):
    """(number, value) of every field of an encoded message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return out

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(kind)
            if n is None:
                if kind != 2:
                    raise ValueError("not a model file")
                n = varint()
            yield tag >> 3, raw[at : at + n]
            at += n


class DoubleArrayTrie:
    """Byte strings to numbers.

    ``base[s] + c`` is the state after byte ``c`` in state ``s``, if ``check``
    of it is ``s``; code 0 ends a string, and the state there holds its number.
    """

    def __init__(self, entries: dict[bytes, int]) -> None:
        self.base, self.check = array("i", [1]), array("i", [0])
        self._free = 1
        self._reserve(1 << 16)
        self._build(sorted(entries.items()))

    def _reserve(self, size: int) -> None:
        more = size - len(self.base)
        if more > 0:
            self.base.extend([0] * more)
            self.check.extend([-1] * more)

    def _build(self, items: list[tuple[bytes, int]]) -> None:
        stack = [(0, 0, len(items), 0)]
        while stack:
            state, lo, hi, depth = stack.pop()
            groups: list[tuple[int, int, int]] = []
            i = lo
            while i < hi:
                key = items[i][0]
                code = key[depth] + 1 if depth < len(key) else 0
                j = i + 1
                while j < hi and (items[j][0][depth] + 1 if depth < len(items[j][0]) else 0) == code:
                    j += 1
                groups.append((code, i, j))
                i = j
            base = self._place([g[0] for g in groups])
            self.base[state] = base
            for code, _, _ in groups:
                self.check[base + code] = state
            for code, i, j in groups:
                if code:
                    stack.append((base + code, i, j, depth + 1))
                else:
                    self.base[base] = -items[i][1] - 1

    def _place(self, codes: list[int]) -> int:
        """Smallest base, from the first free state on, at which all codes are free."""
        check = self.check
        while self._free < len(check) and check[self._free] != -1:
            self._free += 1
        base = max(1, self._free - codes[0])
        while True:
            self._reserve(base + 258)
            if all(check[base + c] == -1 for c in codes):
                return base
            base += 1

    def prefixes(self, raw: bytes, start: int) -> list[tuple[int, int]]:
        """(end, number) of every string that begins at ``start``."""
        base, check, state, found = self.base, self.check, 0, []
        at, n = start, len(raw)
        while True:
            end = base[state]
            if at > start and check[end] == state and base[end] < 0:
                found.append((at, -base[end] - 1))
            if at == n:
                return found
            after = end + raw[at] + 1
            if check[after] != state:
                return found
            state = after
            at += 1


class Pieces:
    """The pieces of one model file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            raw = file.read()
        self.strings: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        self.prefix, self.squeeze, model_type = True, True, UNIGRAM
        for number, value in fields(raw):
            if number == 1:
                own = dict(fields(value))
                self.strings.append(own[1].decode("utf-8"))
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                model_type = dict(fields(value)).get(3, UNIGRAM)
            elif number == 3:
                own = dict(fields(value))
                if own.get(2):
                    raise ValueError("a model without a character map is needed")
                self.prefix, self.squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
        if model_type != UNIGRAM:
            ranked = sorted((i for i, k in enumerate(self.kinds) if k == NORMAL), key=lambda i: (-scores[i], i))
            total = math.log(sum(1 / (r + RANK_OFFSET) for r in range(1, len(ranked) + 1)))
            for r, i in enumerate(ranked, 1):
                scores[i] = round((-math.log(r + RANK_OFFSET) - total) * 1024) / 1024
        self.scores = scores
        usable = {s.encode("utf-8"): i for i, s in enumerate(self.strings) if self.kinds[i] in (NORMAL, USER_DEFINED) and s}
        self.trie = DoubleArrayTrie(usable)
        self.single = {raw for raw in usable if len(raw.decode("utf-8")) == 1}
        self.bytes = {int(s[3:5], 16): i for i, s in enumerate(self.strings) if self.kinds[i] == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else -1
        self.worst = min((scores[i] for i in usable.values()), default=0.0) - UNKNOWN_PENALTY
        # A text may be cut before a mark where no piece holds a mark behind another character.
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", s) for s in self.strings)
        self.seen: dict[str, tuple[int, ...]] = {}
        # What each piece is in a decoded text.
        odd = {UNKNOWN: " ⁇ ".encode(), CONTROL: b""}
        self.spelled = [
            bytes([self.byte_of[i]]) if k == BYTE else odd[k] if k in odd else t.encode("utf-8")
            for i, (t, k) in enumerate(zip(self.strings, self.kinds, strict=True))
        ]
        # The trie as lists, with the piece that ends in each state.
        self.base, self.check = self.trie.base.tolist(), self.trie.check.tolist()
        self.ends = [-1] * len(self.base)
        for state, base in enumerate(self.base):
            if base > 0 and self.check[state] >= 0 and self.check[base] == state and self.base[base] < 0:
                self.ends[state] = -self.base[base] - 1
        self.gain = [0.0 if k == USER_DEFINED else s for k, s in zip(self.kinds, scores, strict=True)]
        self.parts = Parts(self)

    def marked(self, text: str) -> str:
        """The text as the model sees it."""
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix and text else text

    def encode(self, text: str) -> list[int]:
        return self.encode_marked(self.marked(text))

    def encode_marked(self, text: str) -> list[int]:
        if not self.cuts:
            return list(self.viterbi(text))
        out: list[int] = []
        seen = self.seen
        for part in _SEGMENT.findall(text):
            ids = seen.get(part)
            if ids is None:
                ids = self.viterbi(part)
                if len(part) <= REMEMBERED_LENGTH:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[part] = ids
            out += ids
        return out

    def encode_and_decode(self, text: str) -> tuple[np.ndarray, str]:
        """Pieces of a text and the text that they give, both by parts that are known from earlier texts."""
        text = self.marked(text)
        if not self.cuts or MARK + MARK in text:
            ids = self.encode_marked(text)
            return np.array(ids, np.int32), self.decode(ids)
        first, *rest = text.split(MARK)
        parts = [self.parts.found(first)] if first else []
        parts += itemgetter(*rest)(self.parts) if len(rest) > 1 else [self.parts[p] for p in rest]
        ids, raw = zip(*parts) if parts else ((), ())
        return np.frombuffer(b"".join(ids), np.int32), self.read(b"".join(raw))

    def viterbi(self, text: str) -> tuple[int, ...]:
        """Pieces of the segmentation of largest score; of equal ones, the longest last piece."""
        raw = text.encode("utf-8", "surrogatepass")
        n = len(raw)
        best = [0.0] + [-math.inf] * n
        start, piece = [0] * (n + 1), [-1] * (n + 1)
        base, check, ends, gain, single = self.base, self.check, self.ends, self.gain, self.single
        at = 0
        while at < n:
            value = best[at]
            lead = raw[at]
            after = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            # Walk the trie; pieces end at ends of characters.
            state, end = 0, at
            while end < n:
                to = base[state] + raw[end] + 1
                if check[to] != state:
                    break
                state = to
                end += 1
                found = ends[state]
                if found >= 0:
                    score = value + gain[found]
                    if score > best[end]:
                        best[end], start[end], piece[end] = score, at, found
            if (start[after] != at or piece[after] < 0) and raw[at:after] not in single:
                score = value + self.worst
                if score > best[after]:
                    best[after], start[after], piece[after] = score, at, -1
            at = after
        out: list[int] = []
        at = n
        while at:
            before = start[at]
            if piece[at] >= 0:
                out.append(piece[at])
            elif self.bytes:
                out += [self.bytes[b] for b in reversed(raw[before:at])]
            else:
                out.append(self.unknown)
            at = before
        out.reverse()
        return tuple(out)

    def decode(self, ids: list[int]) -> str:
        """The text of the pieces; control pieces have none, broken bytes become U+FFFD."""
        return self.read(b"".join([self.spelled[i] for i in ids]))

    def read(self, raw: bytes) -> str:
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


class Parts(dict):
    """Pieces, as bytes, and spelling of parts behind a mark, remembered within bounds."""

    def __init__(self, own: Pieces) -> None:
        super().__init__()
        self.own = own

    def found(self, part: str) -> tuple[bytes, bytes]:
        ids = self.own.viterbi(part)
        return array("i", ids).tobytes(), b"".join([self.own.spelled[i] for i in ids])

    def __missing__(self, part: str) -> tuple[bytes, bytes]:
        found = self.found(MARK + part)
        if len(part) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[part] = found
        return found


_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """One set of pieces per worker process and file."""
    return Pieces(path)


def encode(
    docs: DataFrame, model: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns and ``ids``, the pieces of every whole text.

    ``model`` is the path of a model file, present on every node.  Null and
    empty texts have no pieces.  One row per input row, repeated ones included.
    """

    def work(texts):
        own = pieces(model)
        return {"ids": [own.encode(t) if t else [] for t in texts]}

    return map_texts(docs, [text], work, "ids array<int>", keep=keep)


def round_trip(
    docs: DataFrame, model: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns, ``ids`` as :func:`encode` gives them, and ``restored``: whether :func:`decode` of them gives the text.

    Both are done in one pass, so the pieces leave the worker once.  A null
    text counts as the empty one.
    """

    def work(texts):
        own = pieces(model)
        out = {"ids": [], "restored": []}
        for value in texts:
            ids, back = own.encode_and_decode(value) if value else ([], "")
            out["ids"].append(ids)
            out["restored"].append(back == (value or ""))
        return out

    return map_texts(docs, [text], work, "ids array<int>, restored boolean", keep=keep)


def decode(
    encoded: DataFrame, model: str, *, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns and ``text`` of the pieces; null and empty lists give the empty text.

    ``decode`` of ``encode`` gives the text back, but for marks in the text
    itself, which come back as blanks.
    """

    def work(lists):
        own = pieces(model)
        return {"text": [own.decode(i) if i else "" for i in lists]}

    return map_texts(encoded, [ids], work, "text string", keep=keep)
