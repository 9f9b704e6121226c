"""Personal data by fixed patterns and a semi-Markov conditional random field.

Only tokens with a digit or an at-sign can be part of an entity, so the field
is laid over islands: such tokens and what stands between and beside them.  A
segment of up to ``LONGEST`` tokens is scored as a whole - its shape, digits,
separators, checks such as Luhn's, and the words beside it - for each type,
and the dynamic programme chooses boundaries and types of an island jointly.
The weights are fitted to islands whose entities the fixed patterns name.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.shared import map_texts, smallest_hashes

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

#: Tokens of a segment, at most.
LONGEST = 14
#: Probability from which a segment that no base span touches is reported.
SURE = 0.95
#: Documents that the weights are fitted on, at most, and islands taken of them.
SAMPLE, ISLANDS = 4000, 240
EPOCHS = 12
#: Tokens of an island that is learned from, at most.
TAUGHT = 40

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_")
TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the pattern around each at-sign, leftmost first, without rescanning words."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by kind, then start."""
    out = [(a, b, "email") for a, b in emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return out


def islands(text: str, around: int = 3) -> list[list[tuple[int, int]]]:
    """Token spans near each other that hold a digit or an at-sign, with the tokens beside them."""
    if not TRIGGER.search(text):
        return []
    marks = [m.start() for m in TRIGGER.finditer(text)]
    regions: list[list[int]] = []
    for at in marks:
        if regions and at - regions[-1][1] <= 24:
            regions[-1][1] = at + 1
        else:
            regions.append([at, at + 1])
    out = []
    for a, b in regions:
        lo, hi = max(0, a - 48), min(len(text), b + 48)
        # Whole tokens: the cut edges grow to the next white space.
        while lo > 0 and not text[lo - 1].isspace() and a - lo < 96:
            lo -= 1
        while hi < len(text) and not text[hi].isspace() and hi - b < 96:
            hi += 1
        tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, lo, hi)]
        inside = [i for i, (s, e) in enumerate(tokens) if TRIGGER.search(text, s, e)]
        if not inside:
            continue
        tokens = tokens[max(0, inside[0] - around * 4) : inside[-1] + 1 + around * 4]
        out.append(tokens)
    return out


def shape(part: str) -> str:
    """Runs of letters, digits and blanks as one sign each; other signs stay."""
    out = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", part))
    return re.sub(r"\s+", " ", out)[:24]


def span_features(text: str, start: int, end: int) -> list[str]:
    """What is known of a whole candidate segment."""
    part = text[start:end]
    digits = re.sub("[^0-9]", "", part)
    n = len(digits)
    found = [
        "bias",
        "shape=" + shape(part),
        f"digits={min(n, 20)}",
        "head=" + ("9" if part[0].isdigit() else "a" if part[0].isalpha() else part[0]),
        "tail=" + ("9" if part[-1].isdigit() else "a" if part[-1].isalpha() else part[-1]),
        "signs=" + "".join(sorted(set(re.sub(r"[\w\s]", "", part)))),
        "blanks" if re.search(r"\s", part) else "solid",
        "open" if end < len(text) and not text[end].isspace() and text[end] not in ".,;:!?)" else "shut",
        "joined" if start and not text[start - 1].isspace() and text[start - 1] not in "(\"'" else "free",
    ]
    if 12 <= n <= 19 and re.fullmatch(r"[0-9][0-9 -]*", part):
        found.append("luhn" if luhn(digits) else "no luhn")
    if re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", part):
        found.append("octets" if all(int(p) <= 255 for p in part.split(".")) else "large octets")
    if "@" in part:
        found.append("address" if part.count("@") == 1 and "." in part.split("@")[1] else "bare at")
    return found


@dataclass
class Field:
    """Weights of the semi-Markov field: (type, feature) and (type before, type)."""

    weights: dict
    sure: float = SURE

    def segments(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, list[str]]]:
        """Candidate segments (first token, behind the last, features) of an island."""
        return list(self.candidates(text, tokens))

    def candidates(self, text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[str]]]:
        """As :meth:`segments`, one after the other: by first token, then by length."""
        for i, (start, _) in enumerate(tokens):
            head = text[start]
            if not (head.isalnum() or head == "+" or head == "("):
                continue
            for j in range(i, min(len(tokens), i + LONGEST)):
                if j > i and (gap := tokens[j][0] - tokens[j - 1][1]) and (
                    gap > 1 or text[tokens[j - 1][1]] == "\n" or text[tokens[j - 1][1] - 1].isalpha() or text[tokens[j][0]].isalpha()
                ):
                    break  # words apart belong to no entity of these types
                end = tokens[j][1]
                if text[end - 1].isalnum() and TRIGGER.search(text, start, end) and end - start >= 6:
                    yield i, j + 1, span_features(text, start, end)

    def potential(self, kind: str, found: list[str]) -> float:
        return sum(self.weights.get((kind, f), 0.0) for f in found)

    def lattice(self, n: int, segments):
        """Log sums from the left and from the right, by token and last type."""
        ends, starts = defaultdict(list), defaultdict(list)
        for i, j, found in segments:
            for kind in KINDS:
                edge = (i, j, kind, self.potential(kind, found))
                ends[j].append(edge)
                starts[i].append(edge)
        return ends, starts

    def transition(self, before: str, kind: str) -> float:
        return self.weights.get(("after " + before, kind), 0.0)

    def forward(self, n: int, ends) -> list[dict[str, float]]:
        states = ("O", *KINDS)
        alpha = [{"O": 0.0}] + [{} for _ in range(n)]
        for j in range(1, n + 1):
            into = defaultdict(list)
            into["O"] = [alpha[j - 1][s] for s in states if s in alpha[j - 1]]
            for i, _, kind, value in ends[j]:
                into[kind] += [alpha[i][s] + self.transition(s, kind) + value for s in states if s in alpha[i]]
            alpha[j] = {k: _log_sum(v) for k, v in into.items() if v}
        return alpha

    def backward(self, n: int, starts) -> list[dict[str, float]]:
        states = ("O", *KINDS)
        beta = [{} for _ in range(n)] + [dict.fromkeys(states, 0.0)]
        for i in range(n - 1, -1, -1):
            for s in states:
                out = [beta[i + 1]["O"]]
                out += [self.transition(s, kind) + value + beta[j][kind] for _, j, kind, value in starts[i]]
                beta[i][s] = _log_sum(out)
        return beta

    def marginals(self, n: int, segments) -> list[tuple[int, int, str, float]]:
        """Probability of every (segment, type)."""
        ends, starts = self.lattice(n, segments)
        alpha, beta = self.forward(n, ends), self.backward(n, starts)
        total = _log_sum(list(alpha[n].values()))
        out = []
        for i, edges in starts.items():
            for _, j, kind, value in edges:
                into = _log_sum([a + self.transition(s, kind) for s, a in alpha[i].items()])
                out.append((i, j, kind, math.exp(min(0.0, into + value + beta[j][kind] - total))))
        return out

    def best(self, n: int, segments) -> list[tuple[int, int, str]]:
        """The most probable segmentation of an island."""
        ends, _ = self.lattice(n, segments)
        states = ("O", *KINDS)
        score = [{"O": (0.0, None)}] + [{} for _ in range(n)]
        for j in range(1, n + 1):
            before = max((score[j - 1][s][0], s) for s in states if s in score[j - 1])
            score[j]["O"] = (before[0], (j - 1, before[1]))
            for i, _, kind, value in ends[j]:
                value, s = max((score[i][s][0] + self.transition(s, kind) + value, s) for s in states if s in score[i])
                if kind not in score[j] or value > score[j][kind][0]:
                    score[j][kind] = (value, (i, s))
        j, s = n, max((v[0], k) for k, v in score[n].items())[1]
        out = []
        while j > 0:
            i, before = score[j][s][1]
            if s != "O":
                out.append((i, j, s))
            j, s = i, before
        return out[::-1]

    def find(self, text: str) -> list[tuple[int, int, str]]:
        """Segments of the best segmentation that are sure enough."""
        out = []
        for tokens in islands(text):
            chosen = self.decode(text, tokens)
            out += [(tokens[i][0], tokens[j - 1][1], k) for i, j, k, p in chosen if p >= self.sure]
        return out

    def decode(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, str, float]]:
        """The best segmentation of an island of any length, with the probability of each segment.

        Of a segment only its potentials are held, and of a token its sums and
        back pointers, all as arrays.
        """
        n, kinds, states = len(tokens), len(KINDS), 1 + len(KINDS)
        none = -math.inf
        value = array("d", [none]) * (n * LONGEST * kinds)
        any_segment = False
        for i, j, found in self.candidates(text, tokens):
            at = (i * LONGEST + j - i - 1) * kinds
            for k, kind in enumerate(KINDS):
                value[at + k] = self.potential(kind, found)
            any_segment = True
        if not any_segment:
            return []
        names = ("O", *KINDS)
        turn = [[self.transition(s, kind) for kind in KINDS] for s in names]
        alpha, score = array("d", [none]) * ((n + 1) * states), array("d", [none]) * ((n + 1) * states)
        back = array("q", [-1]) * ((n + 1) * states)
        alpha[0] = score[0] = 0.0
        for j in range(1, n + 1):
            here, last = j * states, (j - 1) * states
            alpha[here] = _log_sum(alpha[last : last + states])
            # Of equal ones the last name counts, as in best().
            score[here], _, back[here] = max((score[last + s], names[s], last + s) for s in range(states))
            for i in range(max(0, j - LONGEST), j):
                at, from_ = (i * LONGEST + j - i - 1) * kinds, i * states
                if value[at] == none:
                    continue
                for k in range(kinds):
                    gain = value[at + k]
                    into = [alpha[from_ + s] + turn[s][k] + gain for s in range(states)]
                    alpha[here + 1 + k] = _log_sum([alpha[here + 1 + k], *into])
                    top, _, s = max((score[from_ + s] + turn[s][k] + gain, names[s], s) for s in range(states))
                    if top > score[here + 1 + k]:
                        score[here + 1 + k], back[here + 1 + k] = top, from_ + s
        beta = array("d", [none]) * ((n + 1) * states)
        for s in range(states):
            beta[n * states + s] = 0.0
        for i in range(n - 1, -1, -1):
            further = beta[(i + 1) * states]
            edges = [
                (k, value[at + k] + beta[j * states + 1 + k])
                for j in range(i + 1, min(n, i + LONGEST) + 1)
                if value[at := (i * LONGEST + j - i - 1) * kinds] != none
                for k in range(kinds)
            ]
            for s in range(states):
                beta[i * states + s] = _log_sum([further, *(turn[s][k] + v for k, v in edges)])
        total = _log_sum(alpha[n * states :])
        out = []
        node = max(range(n * states, (n + 1) * states), key=lambda x: (score[x], names[x % states]))
        while node >= states:
            j, s = divmod(node, states)
            i = back[node] // states
            if s:
                at = (i * LONGEST + j - i - 1) * kinds + s - 1
                into = _log_sum([alpha[i * states + r] + turn[r][s - 1] for r in range(states)])
                out.append((i, j, names[s], math.exp(min(0.0, into + value[at] + beta[node] - total))))
            node = back[node]
        return out[::-1]


def _log_sum(values) -> float:
    most = max(values)
    if most == -math.inf:
        return most
    return most + math.log(sum(math.exp(v - most) for v in values))


def learn(texts: list[tuple[str, list[tuple[int, int]]]], epochs: int = EPOCHS, rate: float = 0.5) -> Field:
    """Fit the field to islands whose entities the base patterns name, by gradient steps."""
    model = Field({})
    prepared = []
    for text, tokens in texts:
        segments = model.segments(text, tokens)
        known = {(a, b): k for a, b, k in base_spans(text)}
        gold = {(i, j): known[span] for i, j, _ in segments if (span := (tokens[i][0], tokens[j - 1][1])) in known}
        prepared.append((len(tokens), segments, gold))
    weights = model.weights
    for epoch in range(epochs):
        step = rate / (1 + 0.3 * epoch)
        for n, segments, gold in prepared:
            if not segments:
                continue
            found = {(i, j): f for i, j, f in segments}
            for i, j, kind, p in model.marginals(n, segments):
                slope = (gold.get((i, j)) == kind) - p
                if abs(slope) > 1e-3:
                    for f in found[i, j]:
                        weights[kind, f] = weights.get((kind, f), 0.0) + step * slope
        for key in weights:
            weights[key] *= 1 - 1e-3
    return model


def fit(
    docs: DataFrame,
    *,
    text: str = "text",
    sample: int = SAMPLE,
    n_islands: int = ISLANDS,
) -> Field:
    """A field fitted to at most ``n_islands`` islands of ``sample`` documents.

    The documents are those of the smallest hashes of text among those with
    digits or at-signs, so the choice depends on nothing else.  Where none has
    any, the field is empty and finds nothing.
    """
    marked = docs.select(F.col(text).cast("string").alias("t")).filter(F.col("t").rlike("[0-9@]"))
    picked = smallest_hashes(marked, "t", sample).dropDuplicates(["t"])

    def cut(texts):
        # Only what is learned from is cut; what is searched is decoded whole.
        parts = []
        for value in texts:
            own = [ts[i : i + TAUGHT] for ts in islands(value) for i in range(0, len(ts), TAUGHT)]
            parts += [(value, ts) for ts in own]
        return {"part": [value[max(0, ts[0][0] - 1) : ts[-1][1] + 1] for value, ts in parts]}

    parts = (
        map_texts(picked, ["t"], cut, "part string")
        .dropDuplicates(["part"])
        .orderBy(F.xxhash64("part"), "part")
        .limit(n_islands)
        .collect()
    )
    return learn([(r.part, ts[i : i + TAUGHT]) for r in parts for ts in islands(r.part) for i in range(0, len(ts), TAUGHT)])


def find(text: str | None, model: Field) -> list[tuple[int, int, str]]:
    """Base spans and sure segments that touch none of them, by kind, then start."""
    if not text:
        return []
    base = base_spans(text)
    more = [s for s in model.find(text) if not any(a < s[1] and s[0] < b for a, b, _ in base)]
    return sorted({*base, *more}, key=lambda s: (KINDS.index(s[2]), s[0], s[1]))


def scan(
    docs: DataFrame,
    model: Field,
    *,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns and ``found``: array of (start, end, kind, value, base), code points, end exclusive.

    Spans are by kind in the order of ``KINDS``, then start; ``base`` tells
    those of the fixed patterns.  Null and empty texts have none.  One row per
    input row; other columns play no part.
    """

    def work(texts):
        out = []
        for value in texts:
            base = set(base_spans(value)) if value else set()
            out.append(
                [
                    {"start": a, "end": b, "kind": k, "value": value[a:b], "base": (a, b, k) in base}
                    for a, b, k in find(value, model)
                ]
            )
        return {"found": out}

    fields = "found array<struct<start:int,end:int,kind:string,value:string,base:boolean>>"
    return map_texts(docs, [text], work, fields, keep=keep)
