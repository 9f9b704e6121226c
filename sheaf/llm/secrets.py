"""Secret scan by dictionary-primed zstandard novelty.

Strings that could be a secret stand near a word that speaks of one.  Each is
compressed with a dictionary made of common identifiers and the code around it
(the string itself taken out); the bytes of its frame beyond an empty one are
its marginal size.  Names, words and values that occur nearby cost next to
nothing, random strings nearly their full information.  Candidates that stay
incompressible are reported as kind ``novel``, beside the fixed patterns.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import zstandard
from pyspark.sql import DataFrame

from sheaf.llm.shared import map_texts

KINDS = ("assign", "access", "hex", "novel")
#: The base patterns, with the least length of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_HEX_RUN = re.compile(r"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Words after which a string is a candidate.
CONTEXT = re.compile(
    r"passw|passphrase|pwd|secret|token|api.?key|apikey|private.?key|access.?key|credential|bearer|auth|"
    r"client.?id|signature|session.?id|cookie|webhook|connection.?string",
    re.I | re.A,
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{16,}", re.A)
#: Characters before a candidate in which the context word must stand.
NEAR = 48
#: Characters whose novelty is measured at once; longer candidates are measured in pieces.
PIECE = 256
#: A line of an encoded block, and what stands between two of them: line ends, plain or escaped, with indents, quotes and comment signs.
BLOCK_LINE = re.compile(r"[A-Za-z0-9+/_=-]+", re.A)
BESIDE = re.compile(r"""[\x20\t"',;+]*(?:\r?\n|\\[rn]|$)""")
LINE_END = re.compile(r"""[\x20\t"',;+]*(?:\r?\n|\\r\\n|\\n)[\x20\t"'#*>]*""")
#: Characters of surrounding text on either side that prime the dictionary.
AROUND = 1024
#: Least marginal bytes for each character, and in all.
RATE, BYTES = 0.7, 11

#: Identifiers and words of code that prime every dictionary.
IDENTIFIERS = (
    "self this super class struct interface import export from return function def async await public private "
    "protected static final const let var void string number boolean integer float double true false null None "
    "True False undefined exception Exception error Error handler listener callback request response context "
    "config configuration settings options parameters arguments username user_name user_id email address account "
    "password passwd secret token access_token refresh_token api_key apikey private_key public_key credentials "
    "authorization authentication Authorization Bearer Basic session session_id cookie client client_id "
    "client_secret connection connection_string database host hostname localhost port protocol http:// https:// "
    "www. .com .org .net .example example.com example test testing sample placeholder changeme change_me your_ "
    "YOUR_API_KEY_HERE xxxxxxxxxxxxxxxx XXXXXXXXXXXXXXXX 0000000000000000 1234567890 123456789012 abcdefghijklmnop "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 0123456789abcdef qwertyuiop get_ set_ is_ has_ "
    "create_ delete_ update_ process.env. os.environ getenv environment variable value values index length count "
    "buffer encode decode base64 sha256 md5 hash digest signature encrypt decrypt generate validate verify version "
    "file filename path directory folder /usr/local/bin /etc/ /home/ /var/log/ .json .yaml .xml .html .txt .py .js "
)


@lru_cache(maxsize=1)
def _plain_size() -> int:
    """Bytes of an empty frame, which every measured frame also has."""
    return len(zstandard.ZstdCompressor(level=19, write_content_size=False).compress(b""))


def novelty(candidate: str, before: str, after: str, identifiers: str = IDENTIFIERS) -> int:
    """Marginal compressed bytes of ``candidate`` against its surroundings."""
    prime = (identifiers + "\n" + after + "\n" + before).encode("utf-8", "surrogatepass")
    words = zstandard.ZstdCompressionDict(prime, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=9, dict_data=words, write_content_size=False, write_dict_id=False)
    return len(packer.compress(candidate.encode("utf-8", "surrogatepass"))) - _plain_size()


def information(candidate: str) -> float:
    """Bytes that a random string over the classes of characters in ``candidate`` would hold."""
    bits = 4.0 if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", candidate) else 6.0
    return len(candidate) * bits / 8


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, each kind for itself."""
    out = []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                out.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # A run of hexadecimal digits is a match of [0-9a-f]+; those of 16 and more are the ones kept.
    out += [(m.start(), m.end(), "hex") for m in _HEX_RUN.finditer(text)]
    return out


def is_novel(value: str, before: str, after: str, identifiers: str = IDENTIFIERS) -> bool:
    """Whether the value, or a piece of a long one, stays incompressible."""
    n = -(-len(value) // PIECE)
    edges = [len(value) * k // n for k in range(n + 1)]
    for lo, hi in zip(edges, edges[1:]):
        part = value[lo:hi]
        around = (before + value[:lo])[-AROUND:], (value[hi : hi + AROUND] + after)[:AROUND]
        size = novelty(part, *around, identifiers)
        if size >= BYTES and size >= RATE * information(part):
            return True
    return False


def _value(text: str, start: int, stop: int) -> tuple[int, int]:
    """A run without the signs at its ends."""
    value = text[start:stop].strip("=.-_/+")
    if value:
        start = text.index(value, start, stop)
    return start, start + len(value)


def _mixed(value: str) -> bool:
    return len(value) >= 16 and bool(re.search("[0-9]", value)) and bool(re.search("[A-Za-z]", value))


def block_lines(text: str, at: int, to: int) -> list[tuple[int, int]]:
    """The line at a candidate and those that go on behind it: as wide, and at last a shorter one, with nothing beside them."""
    lines, width = [(at, to)], to - at
    while (between := LINE_END.match(text, to)) and (line := BLOCK_LINE.match(text, between.end())):
        n = len(line[0])
        if n > width or line[0].startswith("-") or (line.end() < len(text) and not BESIDE.match(text, line.end())):
            break
        if n < width and len(lines) < 2 and not _mixed(line[0]):
            break
        lines.append((line.start(), line.end()))
        to = line.end()
        if n < width:
            break
    return lines


def novel_spans(text: str, known: list[tuple[int, int, str]], identifiers: str = IDENTIFIERS) -> list:
    """Incompressible strings in sensitive context that no base span touches, whole.

    Lines of one width that follow the one in context are a block with it, to
    their last and shorter one: if one of the full lines is novel, all are reported.
    """
    out = []
    end = 0

    taken: list[list[int]] = []  # what base spans cover, without overlaps
    for s, e, _ in sorted(known):
        if taken and s <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])

    def free(start: int, stop: int) -> bool:
        # The last one that begins before the end is the only one that may reach in.
        at = bisect_left(taken, [stop]) - 1
        return start < stop and (at < 0 or taken[at][1] <= start)

    def candidates(lo: int, hi: int) -> Iterator[re.Match]:
        """Whole candidates that begin from ``lo`` to ``hi``; nothing behind those is looked at."""
        while m := CANDIDATE.search(text, lo, hi + 16):
            yield (m := CANDIDATE.match(text, m.start()))
            lo = m.end()

    def judged(at: int, to: int) -> bool:
        start, stop = _value(text, at, to)
        if not _mixed(text[start:stop]) or not free(start, stop):
            return False
        return is_novel(text[start:stop], text[max(0, start - AROUND) : start], text[stop : stop + AROUND], identifiers)

    for word in CONTEXT.finditer(text):
        lo, hi = max(word.end(), end), word.end() + NEAR
        for m in candidates(lo, hi):
            if m.start() and lo == m.start() and re.match(r"[A-Za-z0-9+/_=.-]", text[m.start() - 1]) and lo != word.end():
                continue
            end = m.end()
            lines = block_lines(text, m.start(), m.end())
            # Two lines may be of one width by chance: then each is judged for itself.
            if len(lines) < 3:
                found = [line for line in lines if judged(*line)]
            else:
                found = lines if any(judged(*line) for line in lines) else []
                # Of a plain block only the last and shorter line may begin another one.
                end = max(end, lines[-2][1])
            for line in found:
                start, stop = _value(text, *line)
                if free(start, stop):
                    out.append((start, stop, "novel"))
                end = max(end, line[1])
    return out


def find(text: str | None, identifiers: str = IDENTIFIERS) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind in the order of ``KINDS``."""
    if not text:
        return []
    known = base_spans(text)
    spans = known + novel_spans(text, known, identifiers)
    return sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan_secrets(
    docs: DataFrame,
    *,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    identifiers: str = IDENTIFIERS,
) -> DataFrame:
    """``keep`` columns and ``found``: array of (start, end, kind, value), code points, end exclusive.

    Whole texts are scanned; null and empty ones have no spans.  Spans are in
    order of start, then kind.  One row per input row, repeated ones included;
    other columns of the input play no part.
    """

    def work(texts):
        return {
            "found": [
                [{"start": a, "end": b, "kind": k, "value": value[a:b]} for a, b, k in find(value, identifiers)]
                for value in texts
            ]
        }

    fields = "found array<struct<start:int,end:int,kind:string,value:string>>"
    return map_texts(docs, [text], work, fields, keep=keep)
