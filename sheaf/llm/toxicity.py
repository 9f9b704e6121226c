"""Toxicity by Levenshtein automata over a lexicon trie, with context-window scores.

The lexicon is learned: whole words and stems (prefixes that stand for all
their inflections, some only if a text has two words of them) that occur in toxic but hardly in clean labelled texts,
chosen one after another by how many toxic texts they explain that the terms
before them do not.  At run time every word is looked up in the trie of the
lexicon; for long terms the Levenshtein automaton of the word walks the trie,
so that misspelled forms are found without comparing the word with each term.
The window around each hit tells whether it is quoted, reported or addressed
to somebody; a logistic regression over these hits gives the score.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.shared import map_texts, staged

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 8000
#: Score from which a text is rejected.
REJECT = 0.7
#: Lengths of stems that are tried.
STEMS = range(3, 9)
#: Clean texts with a term for each toxic one, at most.
CLEAN = 0.08
#: Words, and runs without white space, that a worker remembers, and the longest of these.
REMEMBERED, LONGEST_RUN = 300_000, 64
#: Words before and after a hit that are its context.
BEFORE, AFTER = 8, 4

#: What a worker knows, by lexicon.
_KNOWN: dict[str, tuple[dict, set]] = {}

WORD = re.compile(r"[^\W\d_]+")
#: Two words with one digit or sign between them, which may be one word.
JOINED = re.compile(r"(?<![^\W\d_])(?=([^\W\d_]+(?:[\d_]|[^\w\s])[^\W\d_]+))")
QUOTES = frozenset("\"“”„«»‟〝〞")
REPORTING = frozenset(
    "said says say wrote writes called calls calling quoted quotes quote quoting word words term terms slur slurs "
    "insult insults phrase alleged allegedly reported reports definition means meaning comment comments "
    "dit dites écrit appelé mot mots terme sagte schrieb nannte wort wörter begriff dijo escribió llamó palabra término".split()
)
ADDRESSED = frozenset("you your you're youre u ur yourself du dich dein deine ihr tu toi ton ta vous votre tú tu usted eres".split())

#: Terms of the regression: constant, hits, quoted or reported, misspelled, addressed.
FEATURES = ("direct", "quoted", "misspelled", "addressed")
PRIOR_MEAN = (3.0, 0.8, 1.0, 0.3)
PRIOR_WEIGHT = 1.0


class Trie:
    """Terms as nested dictionaries; the empty key holds the term that ends there."""

    def __init__(self, terms) -> None:
        self.root: dict = {}
        for term in terms:
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = term


class LevenshteinAutomaton:
    """States are the row of edit distances, cut off at ``limit`` + 1."""

    def __init__(self, word: str, limit: int) -> None:
        self.word, self.limit = word, limit

    def start(self) -> tuple[int, ...]:
        return tuple(min(i, self.limit + 1) for i in range(len(self.word) + 1))

    def step(self, row: tuple[int, ...], c: str) -> tuple[int, ...]:
        most = self.limit + 1
        out = [min(row[0] + 1, most)]
        for i, own in enumerate(self.word):
            out.append(min(out[i] + 1, row[i] + (own != c), row[i + 1] + 1, most))
        return tuple(out)

    def alive(self, row: tuple[int, ...]) -> bool:
        return min(row) <= self.limit

    def accepts(self, row: tuple[int, ...]) -> bool:
        return row[-1] <= self.limit


class OneEdit:
    """The automaton of all strings within one edit of a word, by table.

    Of the row of distances behind k letters only the three places about k can
    be one or less.  So a state is these three, and the next one depends on
    which of the word's letters there equal the letter read, and on how many
    of the places are still in the word: a table of a few hundred entries, made
    once for all words as entries are met.
    """

    START = (2, 0, 1)
    table: dict = {}

    @classmethod
    def step(cls, word: str, k: int, state: tuple[int, int, int], c: str) -> tuple[int, int, int]:
        """The state behind k + 1 letters, of which ``c`` is the last."""
        there = word[k - 1 : k + 2] if k else " " + word[:2]
        key = state, tuple([x == c for x in there]), min(len(word) - k, 4), k == 0
        found = cls.table.get(key)
        if found is None:
            if len(cls.table) > 100_000:
                cls.table.clear()
            # By the automaton over whole rows.
            row = [2] * (len(word) + 1)
            for place, value in zip(range(k - 1, k + 2), state):
                if 0 <= place <= len(word):
                    row[place] = value
            after = LevenshteinAutomaton(word, 1).step(tuple(row), c)
            found = tuple([after[p] if 0 <= p <= len(word) else 2 for p in range(k, k + 3)])
            cls.table[key] = found
        return found


def intersect(word: str, trie: Trie, limit: int = 1, prefixes: frozenset[str] = frozenset()) -> list[tuple[str, int]]:
    """Terms of the trie within ``limit`` edits of the word, or ``prefixes`` of one that it begins with, with the distance."""
    found = _within_one(word, trie, prefixes) if limit == 1 else _within(word, trie, limit, prefixes)
    return sorted(found, key=lambda f: (f[1], f[0]))


def _within(word: str, trie: Trie, limit: int, prefixes: frozenset[str]) -> list[tuple[str, int]]:
    automaton = LevenshteinAutomaton(word, limit)
    found, stack = [], [(trie.root, automaton.start())]
    while stack:
        node, row = stack.pop()
        if "" in node:
            if automaton.accepts(row):
                found.append((node[""], row[-1]))
            elif node[""] in prefixes and automaton.alive(row):
                found.append((node[""], min(row)))
        for c, below in node.items():
            if c and automaton.alive(after := automaton.step(row, c)):
                stack.append((below, after))
    return found


def _within_one(word: str, trie: Trie, prefixes: frozenset[str]) -> list[tuple[str, int]]:
    n, step = len(word), OneEdit.step
    found, stack = [], [(trie.root, OneEdit.START if n else (2, 0, 2), 0)]
    while stack:
        node, state, k = stack.pop()
        if "" in node:
            last = state[n - k + 1] if -1 <= n - k <= 1 else 2
            if last <= 1:
                found.append((node[""], last))
            elif node[""] in prefixes and min(state) <= 1:
                found.append((node[""], min(state)))
        for c, below in node.items():
            if c and min(after := step(word, k, state, c)) <= 1:
                stack.append((below, after, k + 1))
    return found


@dataclass
class Lexicon:
    """Whole terms, stems, and stems of which a text needs two words.

    Terms of ``fuzzy_from`` letters and more may be misspelled.
    """

    words: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()
    paired: frozenset[str] = frozenset()
    benign: frozenset[str] = frozenset()
    fuzzy_from: int = 4
    _seen: dict = field(default_factory=dict, repr=False)
    _none: set = field(default_factory=set, repr=False)

    def __post_init__(self) -> None:
        terms = [sorted(part) for part in (self.words, self.stems, self.paired, self.benign)]
        self.key = hashlib.sha256(repr((terms, self.fuzzy_from)).encode("utf-8", "surrogatepass")).hexdigest()
        self.open = self.stems | self.paired
        long = [w for w in self.words | self.open if len(w) >= self.fuzzy_from]
        self.trie = Trie(long)
        self.stem_lengths = sorted({len(s) for s in self.stems | self.paired})
        # With one edit, the first two letters of a term are untouched, or those behind them, which may move by one.
        self.heads, self.nexts = {w[:2] for w in long}, {w[2:4] for w in long}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_seen", "_none")}

    def __setstate__(self, state):
        # What a worker knows of words stays from task to task, for the lexicon it used last.
        if state["key"] not in _KNOWN:
            _KNOWN.clear()
            _KNOWN[state["key"]] = {}, set()
        seen, none = _KNOWN[state["key"]]
        self.__dict__.update(state, _seen=seen, _none=none)

    def match(self, word: str) -> tuple[str, int] | None:
        """The term that a lower-case word stands for, and the edits."""
        seen = self._seen
        if word in seen:
            return seen[word]
        if len(seen) >= REMEMBERED:
            seen.clear()
        seen[word] = found = self._look_up(word)
        return found

    def meets(self, lower: str) -> bool:
        """Whether any word of a text stands for a term.

        No word holds white space, so runs without it that hold none are
        remembered, and only others are looked into.
        """
        none = self._none
        for run in set(lower.split()).difference(none):
            if any(self.match(w) for w in spellings(run)):
                return True
            if len(run) <= LONGEST_RUN:
                if len(none) >= REMEMBERED:
                    none.clear()
                none.add(run)
        return False

    def _look_up(self, word: str) -> tuple[str, int] | None:
        if word in self.words:
            return word, 0
        for n in self.stem_lengths:
            if len(word) > n and (word[:n] in self.stems or word[:n] in self.paired):
                return word[:n], 0
        if len(word) >= self.fuzzy_from - 1 and word not in self.benign and (
            word[:2] in self.heads or any(word[k : k + 2] in self.nexts for k in (1, 2, 3))
        ):
            near = intersect(word, self.trie, prefixes=self.open)
            if near:
                return near[0]
        return None


def spellings(lower: str) -> set[str]:
    """Words of a text, also those with one digit or sign between their letters."""
    return {*WORD.findall(lower), *(m[1] for m in JOINED.finditer(lower))}


def hits(text: str, lexicon: Lexicon) -> list[dict]:
    """Every word that stands for a term, with what its context says."""
    lower = text.lower()
    if not lexicon.meets(lower):
        return []
    spans = [(m.start(), m.end()) for m in WORD.finditer(lower)]
    words = [lower[a:b] for a, b in spans]
    joined = {m.start(1): m[1] for m in JOINED.finditer(lower)}
    found = []
    for i, word in enumerate(words):
        term = lexicon.match(word)
        if not term and (whole := joined.get(spans[i][0])) and not lexicon.match(words[i + 1]):
            term = lexicon.match(whole)
        if not term:
            continue
        lo, hi = max(0, i - BEFORE), min(len(words), i + AFTER + 1)
        left, right = lower[spans[lo][0] : spans[i][0]], lower[spans[i][1] : spans[hi - 1][1] + 1]
        opened = sum(c in QUOTES for c in left)
        quoted = opened > 0 and any(c in QUOTES for c in right) and opened % 2 == 1
        near = words[lo:i] + words[i + 1 : hi]
        found.append(
            {
                "term": term[0],
                "edits": term[1],
                "quoted": quoted or any(w in REPORTING for w in words[max(0, i - 3) : i]),
                "addressed": any(w in ADDRESSED for w in near),
                "at": i,
            }
        )
    times = Counter(h["term"] for h in found)
    return [h for h in found if h["term"] not in lexicon.paired or times[h["term"]] > 1]


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    found = hits(text or "", lexicon)
    n = Counter()
    for h in found:
        if h["edits"]:
            n["misspelled"] += 1
        elif h["quoted"]:
            n["quoted"] += 1
        else:
            n["direct"] += 1
        n["addressed"] += h["addressed"] and not h["quoted"]
    return [math.log1p(n[f]) for f in FEATURES]


@dataclass
class Model:
    lexicon: Lexicon
    bias: float
    weights: tuple[float, ...]

    def score(self, text: str | None) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, features(text, self.lexicon), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def terms_of(text: str) -> set[str]:
    """Whole words, stems and paired stems of a text; a last ``.`` or ``+`` marks the first and the last."""
    out, once, twice = set(), set(), set()
    for w, times in Counter(WORD.findall(text.lower())).items():
        if len(w) >= 3:
            out.add(w + ".")
            stems = {w[:n] for n in STEMS if n < len(w)}
            twice |= stems if times > 1 else once & stems
            once |= stems
    out |= once
    out.update(s + "+" for s in twice)
    return out


def choose(candidates: dict[str, tuple[int, int]], toxic: list[set[str]], clean_rate: float = CLEAN) -> list[str]:
    """Terms that explain toxic texts which the terms before them do not.

    A text counts 0.4 to the power of the terms that it already has, so that
    several terms of one text are all found, but words that only come along
    with them (as in copies of one text) are not.
    """
    weight = [1.0] * len(toxic)
    holds: dict[str, list[int]] = {}
    for i, terms in enumerate(toxic):
        for t in terms:
            if t in candidates:
                holds.setdefault(t, []).append(i)
    chosen: list[str] = []
    left = {t for t, at in holds.items() if candidates[t][1] <= clean_rate * candidates[t][0]}
    least = max(1.5, 0.003 * len(toxic))
    while left:
        gains = {t: sum(weight[i] for i in holds[t]) - 4 * candidates[t][1] for t in left}
        # Whole words, then longer stems, win ties: they claim less.
        best = max(left, key=lambda t: (round(gains[t], 6), t.endswith("."), len(t), t))
        if gains[best] < least:
            break
        chosen.append(best)
        for i in holds[best]:
            weight[i] *= 0.4
        stem = best.rstrip("+")
        left = {t for t in left if t != best and gains[t] >= least and not t.startswith(stem)}
    return chosen


def regression(x: np.ndarray, y: np.ndarray) -> tuple[float, tuple[float, ...]]:
    """Logistic regression with a normal prior on the weights, by Newton steps."""
    mean = np.array([math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), *PRIOR_MEAN])
    mean[0] -= 3.0
    precision = np.diag([0.05, *[PRIOR_WEIGHT] * len(PRIOR_MEAN)])
    design = np.hstack([np.ones((len(x), 1)), x])
    w = mean.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (y - p) - precision @ (w - mean)
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + precision, slope)
        w = w + step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), tuple(float(max(0.0, v)) for v in w[1:])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """Learn lexicon and weights from at most ``sample`` labelled rows that are not held out.

    The rows are those of the smallest hash of their id, so the choice depends
    on nothing else; each distinct text of them counts once.  A document with several labels counts as toxic if one of
    them says so; null labels are left out.  Without toxic rows the lexicon is
    empty and every text gets the same low score.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("__id"))
        .agg(F.max(F.col(label).cast("int")).alias("__y"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample)
    )
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).cast("string").alias("__text")).join(
        F.broadcast(chosen), "__id"
    )
    # Copies of a text are one; it is toxic if one of them is.
    rows = staged(rows.groupBy("__text").agg(F.max("__y").alias("__y")))

    def count(texts, ys):
        toxic, clean = Counter(), Counter()
        for value, y in zip(texts, ys, strict=True):
            (toxic if y else clean).update(terms_of(value or ""))
        terms = list(toxic | clean)
        return {"term": terms, "toxic": [toxic[t] for t in terms], "clean": [clean[t] for t in terms]}

    counted = map_texts(rows, ["__text", "__y"], count, "term string, toxic bigint, clean bigint")
    best = (
        counted.groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= 2) & (F.col("clean") <= CLEAN * F.col("toxic")))
        .collect()
    )
    candidates = {r.term: (r.toxic, r.clean) for r in best}

    def held(texts):
        return {"terms": [[t for t in terms_of(v or "") if t in candidates] for v in texts]}

    toxic = [set(r.terms) for r in map_texts(rows.filter("__y = 1"), ["__text"], held, "terms array<string>").collect()]
    chosen_terms = choose(candidates, toxic)
    words = frozenset(t[:-1] for t in chosen_terms if t.endswith("."))
    paired = frozenset(t[:-1] for t in chosen_terms if t.endswith("+"))
    stems = frozenset(t for t in chosen_terms if t[-1] not in ".+")
    lexicon = Lexicon(words, stems, paired)

    def meet(texts):
        near = {w for v in texts for w in spellings((v or "").lower()) if (m := lexicon.match(w)) and m[1]}
        return {"word": list(near)}

    # Words that look like a misspelled term, but stand in clean texts.
    met = map_texts(rows.filter("__y = 0"), ["__text"], meet, "word string").distinct().collect()
    learned = Lexicon(words, stems, paired, frozenset(r.word for r in met))

    def measure(texts, ys):
        return {"y": list(ys), "x": [features(v, learned) for v in texts]}

    measured = map_texts(rows, ["__text", "__y"], measure, "y int, x array<double>").collect()
    if not measured:
        return Model(lexicon, -6.0, PRIOR_MEAN)
    x, y = np.array([r.x for r in measured]), np.array([float(r.y) for r in measured])
    bias, weights = regression(x, y)
    return Model(learned, bias, weights)


def score(
    docs: DataFrame,
    model: Model,
    *,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns and ``score``, 0 to 1, of every whole text.

    Null and empty texts score as texts without hits.  One row per input row.
    """
    return map_texts(docs, [text], lambda texts: {"score": [model.score(v) for v in texts]}, "score double", keep=keep)
