"""Texts cut at single blanks and line ends, where byte-level pre-tokens always end.

A blank or line end between two characters that are no white space begins a
pre-token of byte-level BPE, or is one: the part from it up to the next such
place is tokenised alike wherever it stands.  So counts and ids of such parts
can be remembered.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import filterfalse
from operator import itemgetter

#: White space of Python contains all white space of the tokenizer libraries.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")

#: Parts a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 700_000, 64
#: Signs that may stand behind a word; a run of them is a pre-token of its own there.
SIGNS = ".,;:!?"


def parts_of(text: str) -> tuple[str, list[str]]:
    """The part up to the first cut, and the later ones: those behind a blank without it, those behind a line end with it."""
    first, *rest = text.replace("\n", " \n").split(" ")
    # Only white space that is a single blank or line end is cut at; other white space is not printable.
    if "" in rest or "\n" in rest or not text.replace("\n", "").isprintable():
        first, *cut = _CUT.split(text)
        rest = [part[1:] if part[0] == " " else part for part in cut]
    return first, rest


def whole(part: str) -> str:
    """A later part with the blank or line end that it begins with."""
    return part if part[:1] == "\n" else " " + part


class Memory(dict):
    """What ``find`` gives for later parts of texts, remembered within bounds; results of pieces of a part add up to that of the whole."""

    def __init__(self, find: Callable[[str], object], find_all: Callable[[list[str]], list], most: int = REMEMBERED) -> None:
        super().__init__()
        self.find, self.find_all, self.most, self.signs = find, find_all, most, {}

    def __missing__(self, part: str):
        return self.find(whole(part))

    def learn(self, parts: list[list[str]]) -> None:
        """Look up all parts but very long ones that are not known, at once."""
        unknown: set[str] = set()
        for rest in parts:
            unknown.update(filterfalse(self.__contains__, rest))
        unknown = {p for p in unknown if len(p) <= LONGEST}
        if len(self) + 2 * len(unknown) > self.most:
            self.clear()
            unknown = {p for rest in parts for p in rest if len(p) <= LONGEST}
        # A word and the signs behind it are different pre-tokens, and a word is known more often than both.
        stems = {}
        for part in unknown:
            stem = part.rstrip(SIGNS)
            if len(stem) < len(part) and stem and stem[-1].isalnum():
                stems[part] = stem
        fresh = [p for p in unknown.difference(stems).union(stems.values()) if p not in self]
        self.update(zip(fresh, self.find_all([whole(p) for p in fresh]), strict=True))
        for part, stem in stems.items():
            signs = part[len(stem) :]
            if signs not in self.signs:
                if len(self.signs) >= LONGEST:
                    self.signs.clear()
                self.signs[signs] = self.find(signs)
            self[part] = self[stem] + self.signs[signs]

    def of(self, rest: list[str]) -> tuple:
        """What was found for each part."""
        return itemgetter(*rest)(self) if len(rest) > 1 else tuple(self[p] for p in rest)
