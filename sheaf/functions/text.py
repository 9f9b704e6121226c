"""Titles, abstracts, markup and white space."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

from sheaf import dims
from sheaf.functions.arrays import let

# White space as Unicode knows it, plus the four information separators.
_SPACE = r"[\s\x1c-\x1f]"
_WORD_END = 1 << 20


def clean_whitespace(c: Column) -> Column:
    """Collapse every run of white space to one space and trim the ends."""
    return F.trim(F.regexp_replace(c, rf"(?U){_SPACE}+", " "))


def strip(c: Column) -> Column:
    """Trim Unicode white space from both ends."""
    return F.regexp_replace(c, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def capitalize(word: Column) -> Column:
    return F.concat(
        F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, _WORD_END))
    )


def title_case(c: Column) -> Column:
    """Capitalise each run of letters, also after a hyphen or an apostrophe."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, capitalize), "")


def fix_title_capitalization(c: Column) -> Column:
    """Re-case a title written in one case only; mixed case is left alone."""

    def recase(word: Column, position: Column) -> Column:
        return (
            F.when(position == 0, capitalize(word))
            .when(F.upper(word).isin(*dims.COMMON_ACRONYMS), F.upper(word))
            .when(F.length(word) > 3, capitalize(word))
            .otherwise(F.lower(word))
        )

    words = F.split(c, " +", -1)
    mixed = c.rlike("[A-Z]") & c.rlike("[a-z]")
    return F.when(mixed, c).otherwise(F.array_join(F.transform(words, recase), " "))


def html_scripts_to_latex(c: Column) -> Column:
    """Sub- and superscript tags become LaTeX."""

    def scripts(x: Column) -> Column:
        x = F.regexp_replace(x, r"<sub>([^\n]*?)</sub>", r"\$_{$1}\$")
        x = F.regexp_replace(x, r"<inf>([^\n]*?)</inf>", r"\$_{$1}\$")
        return F.regexp_replace(x, r"<sup>([^\n]*?)</sup>", r"\$^{$1}\$")

    return let(c, lambda x: F.when(x.rlike("</(?:sub|inf|sup)>"), scripts(x)).otherwise(x))


def remove_tags(
    c: Column, which: Iterable[str] = (), keep: Iterable[str] = ()
) -> Column:
    """Drop tags but not what they enclose.

    With ``which`` only those tags go; with ``keep`` all others go.
    """
    which, keep = sorted(which), sorted(keep)
    if which and keep:
        raise ValueError("give either `which` or `keep`")
    guard = ""
    if which:
        guard = rf"(?=(?:{'|'.join(which)})[ >/])"
    elif keep:
        guard = rf"(?!(?:{'|'.join(keep)})[ >/])"
    return F.regexp_replace(c, rf"(?is)</?{guard}[^ >/]+.*?>", "")


def remove_tags_with_content(c: Column, tags: Iterable[str]) -> Column:
    alternatives = "|".join(rf"<{t}\b.*?</{t}>|<{t}\s*/>" for t in tags)
    return F.regexp_replace(c, f"(?is){alternatives}", "")


def strip_attributes(c: Column) -> Column:
    """Reduce markup to bare tags.

    Scripts, comments and processing instructions go with their content, tags
    lose their attributes, and characters that are not part of a tag or an
    entity are escaped.
    """
    x = F.regexp_replace(c, r"(?is)<script\b.*?</script\s*>|<!--.*?-->|<\?.*?>", "")
    x = F.regexp_replace(x, r"<([A-Za-z][^\s<>/]*)\s[^<>]*?(/?)>", "<$1$2>")
    # Park the remaining tags on control characters while the rest is escaped.
    x = F.regexp_replace(x, r"<(/?[A-Za-z][^<>]*)>", "\u0001$1\u0002")
    x = F.regexp_replace(x, r"&(?![A-Za-z][A-Za-z0-9]*;|#\d+;|#[xX][0-9A-Fa-f]+;)", "&amp;")
    x = F.replace(F.replace(x, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.when(c.rlike("[<>&]"), F.translate(x, "\u0001\u0002", "<>")).otherwise(c)


def _without_markup(c: Column) -> Column:
    """Bare text, but for formulas, whose tags lose their attributes."""
    return strip(remove_tags(let(c, strip_attributes), keep=dims.MATHML_ELEMENTS))


def _cleaned(c: Column, *steps: Callable[[Column], Column]) -> Column:
    """Steps over a text with single spaces; what looks at markup is left out where there is none."""

    def chain(x: Column, *of: Callable[[Column], Column]) -> Column:
        for step in of:
            x = let(x, step)
        return x

    return let(
        clean_whitespace(c),
        lambda x: F.when(x.rlike("[<>&]"), _without_markup(chain(html_scripts_to_latex(x), *steps))).otherwise(chain(x, *steps)),
    )


def clean_title(c: Column) -> Column:
    return _cleaned(c, fix_title_capitalization)


def clean_abstract(c: Column) -> Column:
    return _cleaned(c)


def clean_keyword(c: Column) -> Column:
    return remove_tags(html_scripts_to_latex(clean_whitespace(c)))


def clean_affiliation(c: Column) -> Column:
    """Drop label elements altogether, then all tags, then spare white space."""
    bare = let(
        c,
        lambda x: F.when(F.contains(x, F.lit("<")), remove_tags(remove_tags_with_content(x, ["label"]))).otherwise(x),
    )
    return clean_whitespace(bare)


def clean_collaboration(c: Column) -> Column:
    return strip(F.replace(c, F.lit("for the"), F.lit("")))


def has_numbers(c: Column) -> Column:
    # Decimal digits of any script, super- and subscript and circled digits.
    return c.rlike(r"[\p{Nd}²³¹⁰-⁹₀-₉①-⑨]")


def digits(c: Column) -> Column:
    """Only the digits of a text, e.g. the year of a copyright statement."""
    return F.regexp_replace(c, r"\P{Nd}", "")


def unwrap_cdata_instruction(c: Column) -> Column:
    """Replace a ``<?CDATA ... ?>`` instruction by what it carries."""
    return F.regexp_replace(c, r"<\?CDATA([^\n]*?)\?>", "$1")


def drop_math(c: Column) -> Column:
    """Remove formulas together with their content."""
    return F.regexp_replace(c, r"<math>[^\n]*?</math>", "")


def strip_leading_article(c: Column) -> Column:
    return F.regexp_replace(c, r"^The ", "")


def language_name(c: Column) -> Column:
    """Full name of a language code; NULL for English, the default language."""
    code = F.lower(c)
    known = F.try_element_at(dims.as_map(dims.LANGUAGES), code)
    return F.when(~code.isin("en", "eng", "english"), F.coalesce(known, title_case(c)))


def collaboration_and_author(c: Column) -> Column:
    """Split "A. Author for the X Collaboration" into its two parts."""
    body = F.btrim(c, F.lit(".; "))
    parts = F.split(body, r"(?i)\b(?:for|on behalf of|representing)\b", 2)
    lead, trail = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    author = F.when(trail.isNotNull() & lead.rlike(r"\w"), strip(lead))
    name = F.when(trail.rlike(r"\w"), trail).otherwise(body)
    name = F.regexp_replace(name, r"(?i)^ *the ", "")
    name = strip(F.regexp_replace(name, r"(?i) *collaborations? *", ""))
    # An institute "for the development of ..." is not a collaboration.
    untouched = F.contains(F.lower(c), F.lit("for the development"))
    return F.struct(
        F.when(untouched, c).otherwise(name).alias("collaboration"),
        F.when(~untouched, author).alias("author"),
    )


def journal_and_section(c: Column) -> Column:
    """Split a trailing section letter A-E off a journal title."""
    tokens = F.regexp_extract_all(c, F.lit(r"(\w+|\W+)"), F.lit(1))
    last = F.try_element_at(tokens, F.lit(-1))
    has_section = F.coalesce(last.isin("A", "B", "C", "D", "E"), F.lit(False))
    kept = F.when(
        has_section, F.slice(tokens, F.lit(1), F.size(tokens) - 1)
    ).otherwise(tokens)
    words = F.filter(kept, lambda w: ~F.contains(F.lower(w), F.lit("section")))
    return F.struct(
        F.btrim(F.array_join(words, ""), F.lit(", ")).alias("journal_title"),
        F.when(has_section, last).otherwise("").alias("section"),
    )
