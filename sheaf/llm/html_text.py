"""Main text of web pages as the maximum-scoring run of words and tags.

A page is a list of words and tags.  Every word and tag has a weight - the log
odds, over labelled pages, of standing inside the article rather than outside,
by the block it stands in - words in the open being positive and tags
negative.  One scan finds the run of largest sum; within it, blocks that are
no article text by their element (menus, forms, notices, comments) are left
out, and the rest are joined.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.shared import map_texts, smallest_hashes

#: Labelled pages that the weights are learned from, at most.
SAMPLE = 2000

#: Elements of HTML by what they do to the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
#: Elements whose text is never part of the article.
APART = frozenset(
    "nav footer aside form script style noscript template iframe noembed noframes svg math button select option "
    "textarea dialog menu head title object canvas audio video datalist label fieldset search".split()
)
#: Words of class, id and role that mark such elements.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner "
    "comment comments respond replies reply disqus discussion sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer header masthead topbar toolbar cookie cookies consent notice notices notification alert gdpr privacy modal "
    "popup overlay share sharing social related recommended recommendations newsletter subscribe subscription signup "
    "login widget pagination pager skip toc copyright complementary contentinfo search".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset("article main".split())
#: Blocks that an opening tag of one of the same kind closes.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TAG = re.compile(
    # A tag ends at the next opening sign outside quotes, so that one left open costs no look to the end.
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S
)
_COMMENT = re.compile(r"<!--.*", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAMES = re.compile(r"[A-Za-z]+")

#: Weights of what no labelled page has, and the bounds of the learned ones.
WORD, OPEN_TAG, LEAST, MOST = 1.0, -1.5, -6.0, 3.0
#: Tags before a block, and blocks that are left out anyway, cost no more: an article goes on behind them.
BETWEEN = -4.0


class Piece:
    """A block of text with the elements it stands in."""

    __slots__ = ("apart", "article", "key", "tags", "text")

    def __init__(self, text: str, key: str, apart: bool, article: bool, tags: list[str]) -> None:
        self.text, self.key, self.apart, self.article, self.tags = text, key, apart, article, tags


def marks(attributes: str) -> str:
    """The first word of class, id or role that marks an element as no article text."""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "hidden"
        for word in _NAMES.findall(value.replace("_", " ").replace("-", " ")):
            if word.lower() in MARKS:
                return word.lower()
    return ""


def pieces(page: str) -> list[Piece]:
    """The blocks of a page in order; text of raw elements is skipped."""
    out: list[Piece] = []
    # Open elements: name; first mark, nearest block, whether it is article text, whether any mark is no header, each with what is around it.
    stack: list[tuple[str, str, str, bool, bool]] = []
    names: Counter = Counter()
    text: list[str] = []
    tags: list[str] = []

    def flush() -> None:
        joined = " ".join(html.unescape("".join(text)).split()) if text else ""
        text.clear()
        if not joined:
            return
        _, apart, block, article, other = stack[-1] if stack else ("", "", "body", False, False)
        if apart == "header" and article and block in HEADINGS and not other:
            inside = [e for e, *_ in stack]
            if any(e in ARTICLE for e in inside[: inside.index("header")] if "header" in inside):
                apart = ""  # the heading of the article itself
        out.append(Piece(joined, apart or block, bool(apart), article, tags.copy()))
        tags.clear()

    def close(to: int) -> None:
        for name, *_ in stack[to:]:
            names[name] -= 1
        del stack[to:]

    at, n, last = 0, len(page), page.rfind(">")
    while at < n:
        # Behind the last sign that ends a tag there can only be a comment.
        m = TAG.search(page, at) if at <= last else _COMMENT.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at : m.start()])
        at = m.end()
        if m.re is _COMMENT or not m[2]:
            continue
        name = m[2].lower()
        if name == "br":
            text.append(" ")
        if name in BLOCKS:
            flush()
        if m[1]:
            tags.append("/" + name)
            for i in range(len(stack) - 1, -1, -1) if names[name] else ():
                if stack[i][0] == name:
                    close(i)
                    break
                if name == "p" and stack[i][0] in BLOCKS:
                    break
            continue
        tags.append(name)
        if name in VOID or m[3].endswith("/") and name not in BLOCKS:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            at = end.start() if end else n
            if end:
                at = page.find(">", end.start()) + 1 or n
            continue
        closes = IMPLIED.get(name)
        if name in BLOCKS and names["p"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        if closes:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closes:
                    close(i)
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table", "select", "menu"):
                    break
        mark = name if name in APART else marks(m[3]) if m[3] else ""
        if name in ("html", "body", "article", "main"):
            mark = ""
        elif name == "header":
            mark = "header"
        _, apart, block, article, other = stack[-1] if stack else ("", "", "body", False, False)
        stack.append(
            (name, apart or mark, name if name in BLOCKS else block, article or name in ARTICLE, other or mark not in ("", "header"))
        )
        names[name] += 1
    flush()
    return out


def observed(found: list[Piece]) -> tuple[Counter, Counter]:
    """Words by block and tags by name, within and outside the article."""
    inside, outside = Counter(), Counter()
    for piece in found:
        into = inside if piece.article and not piece.apart else outside
        into["word " + piece.key] += len(piece.text.split())
        for tag in piece.tags:
            into["tag " + tag] += 1
    return inside, outside


def weights_of(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log odds of within against outside; tags are kept from being positive."""
    words = [sum(c[i] for k, c in counts.items() if k.startswith("word ")) + 1 for i in (0, 1)]
    out = {}
    for key, (inside, outside) in counts.items():
        value = math.log((inside + 0.5) / words[0]) - math.log((outside + 0.5) / words[1])
        out[key] = max(LEAST, min(MOST, value)) if key.startswith("word ") else max(LEAST, min(-0.1, value))
    return out


def region(found: list[Piece], weights: dict[str, float]) -> tuple[int, int]:
    """First block of the best run and the one behind its last, by one scan."""
    best, best_at = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, piece in enumerate(found):
        cost = sum(weights.get("tag " + t, OPEN_TAG if t[0] != "/" else 0.0) for t in piece.tags)
        total += max(cost, BETWEEN)
        if total <= 0:
            total, start = 0.0, i
        default = -WORD if piece.apart else WORD
        value = weights.get("word " + piece.key, default) * len(piece.text.split())
        total += max(value, BETWEEN) if piece.apart else value
        if total > best:
            best, best_at = total, (start, i + 1)
        if total < 0:
            total, start = 0.0, i + 1
    return best_at


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The article's blocks, joined by an empty line."""
    found = pieces(page or "")
    start, end = region(found, weights)
    return "\n\n".join(p.text for p in found[start:end] if not p.apart)


def learn(pages: DataFrame, *, html: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most ``sample`` labelled pages.

    Pages that mark their article by an ``article`` or ``main`` element are the
    labelled ones; the element itself is no feature.  Those of the smallest
    hashes are taken.  Without any, the weights are empty and words and tags
    have their fixed ones.
    """
    labelled = pages.select(F.col(html).cast("string").alias("h")).filter(F.col("h").rlike("(?i)<(article|main)[\\s>]"))
    own = smallest_hashes(labelled, "h", sample)

    def count(values):
        inside, outside = Counter(), Counter()
        for value in values:
            a, b = observed(pieces(value))
            inside, outside = inside + a, outside + b
        keys = [k for k in inside | outside if k.split(" ")[1].lstrip("/") in BLOCKS | APART | MARKS | _INLINE]
        return {"key": keys, "inside": [inside[k] for k in keys], "outside": [outside[k] for k in keys]}

    counted = map_texts(own, ["h"], count, "key string, inside bigint, outside bigint")
    rows = counted.groupBy("key").agg(F.sum("inside").alias("a"), F.sum("outside").alias("b")).collect()
    return weights_of({r.key: (r.a, r.b) for r in rows if r.key.removeprefix("tag ").lstrip("/") not in ARTICLE})


#: Elements within a line; with blocks and marks they bound the keys that are learned.
_INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font hidden i img ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)


def extract(
    pages: DataFrame,
    weights: dict[str, float],
    *,
    html: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """``keep`` columns and ``text``, the main text of every whole page.

    Null and empty pages, and those without article text, give an empty text.
    One row per input row; other columns play no part.
    """
    return map_texts(pages, [html], lambda values: {"text": [main_text(v, weights) for v in values]}, "text string", keep=keep)
