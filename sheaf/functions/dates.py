"""Dates of varying precision, kept as ISO text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NAME = (
    "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)


class _Shape:
    """A way to write a date: what it looks like and how it is read.

    ``to`` rearranges the groups of ``regex`` into text for the date pattern.
    Month names are cut to three letters and two-digit years get a century
    before, where the pattern asks for them.
    """

    def __init__(self, regex: str, pattern: str, to: str | None = None, century: str = ""):
        self.regex = rf"(?i)^{regex}\z"
        self.pattern = pattern
        self.to = to
        self.century = century

    def date(self, c: Column) -> Column:
        text = c if self.to is None else F.regexp_replace(c, self.regex, self.to)
        if "MMM" in self.pattern:
            text = F.regexp_replace(text, r"(?i)([a-z]{3})[a-z]+", "$1")
        # 69-99 belong to the 1900s, 00-68 to the 2000s.
        if self.century == "last":
            text = F.regexp_replace(text, r"(?<=\D)(69|[7-9]\d)$", "19$1")
            text = F.regexp_replace(text, r"(?<=\D)([0-6]\d)$", "20$1")
        elif self.century == "first":
            text = F.regexp_replace(text, r"^(69|[7-9]\d)(?!\d)", "19$1")
            text = F.regexp_replace(text, r"^([0-6]\d)(?!\d)", "20$1")
        return F.when(c.rlike(self.regex), F.try_to_date(text, self.pattern))


# Accepted spellings, by precision.  Shapes of one list exclude each other.
_DAY = [
    _Shape(
        r"(\d{4}-\d{1,2}-\d{1,2})(?:T(?:2[0-3]|[01]?\d):[0-5]?\d:(?:6[01]|[0-5]?\d)Z)?",
        "yyyy-M-d", "$1",
    ),
    _Shape(r"(\d{1,2})\s+(\d{1,2})\s+(\d{4})", "d-M-yyyy", "$1-$2-$3"),
    _Shape(r"\d{1,2}/\d{1,2}/\d{2}", "M/d/yyyy", century="last"),
    _Shape(rf"(\d{{1,2}})\s+({_NAME})\s+(\d{{4}})", "d-MMM-yyyy", "$1-$2-$3"),
    _Shape(rf"(\d{{1,2}})\s+({_NAME})\s+(\d{{2}})", "d-MMM-yyyy", "$1-$2-$3", "last"),
    _Shape(r"\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy"),
]
_MONTH = [
    _Shape(r"\d{4}-\d{1,2}", "yyyy-M"),
    _Shape(rf"(\d{{4}})\s+({_NAME})", "yyyy-MMM", "$1-$2"),
    _Shape(rf"({_NAME})\s+(\d{{4}})", "yyyy-MMM", "$2-$1"),
    _Shape(r"\d{2}-\d{1,2}", "yyyy-M", century="first"),
    _Shape(rf"(\d{{2}})\s+({_NAME})", "yyyy-MMM", "$1-$2", "first"),
    _Shape(rf"({_NAME})\s+(\d{{2}})", "yyyy-MMM", "$2-$1", "first"),
]
_YEAR = [_Shape(r"\d{4}", "yyyy"), _Shape(r"\d{2}", "yyyy", century="first")]
# Last resort: further spellings, filled up to a whole date.
_FREE = [
    _Shape(r"\s*(\d{4})[/.](\d{1,2})[/.](\d{1,2})\s*", "yyyy-M-d", "$1-$2-$3"),
    _Shape(r"(\d{1,2})[-/](\d{4})", "yyyy-M", "$2-$1"),
    _Shape(rf"(\d{{4}})\s+({_NAME})\.?\s+(\d{{1,2}})", "yyyy-MMM-d", "$1-$2-$3"),
    _Shape(
        rf"({_NAME})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?(?:,\s*|\s+)(\d{{4}})", "yyyy-MMM-d", "$3-$1-$2"
    ),
    _Shape(rf"(\d{{1,2}})(?:st|nd|rd|th)?\s+({_NAME})\.?,\s*(\d{{4}})", "yyyy-MMM-d", "$3-$2-$1"),
    _Shape(rf"({_NAME})\.?,\s*(\d{{4}})", "yyyy-MMM", "$2-$1"),
    _Shape(
        rf"(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+(\d{{1,2}})\s+({_NAME})\s+(\d{{4}})"
        r"(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?(?:\s*(?:[A-Z]{1,4}|[+-]\d{4}))?",
        "yyyy-MMM-d", "$3-$2-$1",
    ),
    _Shape(r"(\d{4})(\d{2})(\d{2})", "yyyy-M-d", "$1-$2-$3"),
    # The month comes first unless it cannot be one.
    _Shape(r"(?:0?\d|1[0-2])/\d{1,2}/\d{4}", "M/d/yyyy"),
    _Shape(r"(?:1[3-9]|2\d|3[01])/\d{1,2}/\d{4}", "d/M/yyyy"),
]


def _first(shapes: list[_Shape], c: Column) -> Column:
    return F.coalesce(*[shape.date(c) for shape in shapes])


def format_date(raw: Column) -> Column:
    """ISO text of the precision that is given: day, month or year.

    Text with more than one dash is tried as a month by its first two parts
    and as a year by its first.  Text that is not understood is returned
    unchanged.
    """
    text = raw.cast("string")
    is_day = text.rlike(r"^(?!0000)\d{4}-\d{2}-\d{2}\z") & text.try_cast("date").isNotNull()
    return F.coalesce(
        # Most dates are ISO days already.
        F.when(is_day, text),
        F.date_format(_first(_DAY, text), "yyyy-MM-dd"),
        F.date_format(_first(_MONTH, F.substring_index(text, "-", 2)), "yyyy-MM"),
        F.date_format(_first(_YEAR, F.substring_index(text, "-", 1)), "yyyy"),
        F.date_format(_first(_FREE, text), "yyyy-MM-dd"),
        text,
    )


_ISO = r"^(?!0000)\d{4}(?:-\d{2}){0,2}\z"


def precision(formatted: Column) -> Column:
    """``day``, ``month`` or ``year`` of formatted text, ``raw`` for any other."""
    dashes = F.length(formatted) - F.length(F.replace(formatted, F.lit("-"), F.lit("")))
    return F.when(
        formatted.rlike(_ISO), F.element_at(F.array(*map(F.lit, ("year", "month", "day"))), dashes + 1)
    ).otherwise("raw")


def format_year(raw: Column) -> Column:
    """Year of a date in any accepted spelling, 0 if it has none."""
    iso = F.regexp_extract(format_date(raw), _ISO, 0)
    return F.coalesce(F.substring(iso, 1, 4).try_cast("int"), F.lit(0))


def pad_iso_date(iso: Column) -> Column:
    """A whole ISO date from ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD`` text."""
    date = F.coalesce(
        *[
            F.when(iso.rlike(regex), F.try_to_date(iso, pattern))
            for regex, pattern in (
                (r"^\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
                (r"^\d{4}-\d{1,2}\z", "yyyy-M"),
                (r"^(?!0000)\d{4}\z", "yyyy"),
            )
        ]
    )
    return F.date_format(date, "yyyy-MM-dd")


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """A DATE, or NULL where the parts do not name a day of the calendar."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month.cast("string"), day.cast("string"))
    return F.try_to_date(text, "yyyy-M-d")


# Strftime directives and the date patterns that render them.
_DIRECTIVES = {
    "a": "EEE", "A": "EEEE", "b": "MMM", "B": "MMMM", "d": "dd", "m": "MM",
    "y": "yy", "Y": "yyyy", "H": "HH", "I": "hh", "M": "mm", "S": "ss",
    "p": "a", "j": "DDD", "%": "'%'",
}


def strftime(c: Column, fmt: str) -> Column:
    """Format a timestamp by strftime directives, for any year."""
    out, literal, i = [], "", 0

    def flush():
        nonlocal literal
        if literal:
            out.append("'" + literal.replace("'", "''") + "'")
            literal = ""

    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            flush()
            out.append(_DIRECTIVES[fmt[i + 1]])
            i += 2
        else:
            literal += fmt[i]
            i += 1
    flush()
    return F.date_format(c, "".join(out))
