"""Token counts of a byte-level BPE tokenizer, by the whole-token shortcut.

A string of the vocabulary that encodes alone as one token counts one wherever
it stands as a pre-token.  This is proved once per vocabulary by merging every
entry's bytes; at run time the pre-tokens of a text are counted, the proved
ones are taken directly, and only the rest are merged.  Texts are cut where
pre-tokens end anyway, and what such a part counts is remembered.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from sheaf.llm.chunks import Memory, parts_of
from sheaf.llm.shared import map_texts

#: Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Blocks in which the character classes of ``regex`` and of the tokenizer library agree (tested);
#: texts with other characters are cut by the library's own pre-tokenizer.
OTHER = regex.compile(
    "[^\u0000-՗Ḁ-῿ -⁤⁰-ⁱ₠-₹℀-⅏←-⏰"
    "─-❵　-〿ぁ-ゖ゠-ヿ一-鿌가-힣"
    "！-～\U0001f300-\U0001f5ff\U0001f600-\U0001f64f]"
)
#: Pre-tokens a worker remembers; beyond it the memory starts anew.
REMEMBERED = 200_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte, as byte-level vocabularies are written."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Counts:
    """Counts for one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind, cut = spec["model"], spec["pre_tokenizer"]
        if kind["type"] != "BPE" or kind.get("ignore_merges") or spec.get("normalizer") or cut["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE without normalizer is needed")
        if cut["add_prefix_space"] or not cut.get("use_regex", True):
            raise ValueError("the default pre-tokenizer is needed")
        self.path = path
        self.bytes_of = byte_alphabet()
        decode = lambda s: bytes(self.bytes_of[c] for c in s)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in kind["merges"]]
        self.ranks = {(decode(a), decode(b)): i for i, (a, b) in enumerate(pairs)}
        added = [a for a in spec["added_tokens"] if a["content"]]
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added):
            raise ValueError("plain added tokens are needed")
        strings = sorted((a["content"] for a in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, strings))) if strings else None
        self.whole = set()
        for entry in kind["vocab"]:
            raw = decode(entry)
            try:
                string = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue  # part of a character: never a pre-token
            if self.merged(raw) == 1:
                self.whole.add(string)
        self.seen: dict[str, int] = {}
        self.memory = Memory(self.count_all, self.count_parts)
        self._library = None

    def merged(self, raw: bytes) -> int:
        """Tokens left when no pair of neighbours has a rank."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        ranks, none = self.ranks, len(self.ranks)
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: ranks.get(p, none))
            if best not in ranks:
                break
            left, right = best
            out, i, last = [], 0, len(parts) - 1
            while i <= last:
                if i < last and parts[i] == left and parts[i + 1] == right:
                    out.append(left + right)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return len(parts)

    def pretokens(self, text: str) -> list[str]:
        if not OTHER.search(text):
            return PATTERN.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text: sums over parts that a worker knows from earlier texts."""
        cut = [parts_of(text) for text in texts]
        self.memory.learn([rest for _, rest in cut])
        return [self.count_all(first) + sum(self.memory.of(rest)) for first, rest in cut]

    def count_parts(self, parts: list[str]) -> list[int]:
        """Tokens of each part: one of those proved whole, and of the rest, which the library merges in one call."""
        rest = [p for p in parts if p not in self.whole]
        merged = iter(self.library.encode_batch_fast(rest, add_special_tokens=False))
        return [1 if p in self.whole else len(next(merged)) for p in parts]

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def count_all(self, text: str) -> int:
        parts = [text]
        total = 0
        if self.added is not None:
            parts = self.added.split(text)
            total = len(parts) - 1
        whole, seen = self.whole, self.seen
        for part in parts:
            for token, times in Counter(self.pretokens(part)).items():
                if token in whole:
                    total += times
                    continue
                n = seen.get(token)
                if n is None:
                    n = self.merged_long(token)
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    if len(token) <= 64:
                        seen[token] = n
                total += times * n
        return total

    def merged_long(self, token: str) -> int:
        """As :meth:`merged`; very long pre-tokens are merged by a heap of pairs."""
        raw = token.encode("utf-8", "surrogatepass")
        return self.merged(raw) if len(raw) <= 200 else self.merged_by_heap(raw)

    def merged_by_heap(self, raw: bytes) -> int:
        import heapq

        parts: list[bytes | None] = [raw[i : i + 1] for i in range(len(raw))]
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        ranks = self.ranks
        heap = [(r, i, p, q) for i, (p, q) in enumerate(zip(parts, parts[1:])) if (r := ranks.get((p, q))) is not None]
        heapq.heapify(heap)
        left = len(parts)
        while heap:
            _, i, p, q = heapq.heappop(heap)
            j = after[i]
            if parts[i] != p or j < 0 or parts[j] != q:
                continue
            parts[i], parts[j] = p + q, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            left -= 1
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := ranks.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))
        return left


@lru_cache(maxsize=4)
def counts(path: str) -> Counts:
    """One table per worker process and file."""
    return Counts(path)


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    *,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text.

    ``tokenizer`` is the path of a byte-level BPE ``.json`` file, present on
    every node.  A null text counts as the empty one: no bytes, no tokens.
    Strings of added tokens inside a text count as those tokens.  One row per
    input row, repeated ones included; an empty table gives an empty result.
    """

    def work(texts):
        texts = [value or "" for value in texts]
        sizes = [len(value.encode("utf-8", "surrogatepass")) for value in texts]
        return {"n_bytes": sizes, "n_tokens": counts(tokenizer).counts(texts)}

    return map_texts(docs, [text], work, "n_bytes bigint, n_tokens bigint", keep=keep)
