"""Identifiers, pages and file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clean_arxiv(c: Column, mode: str = "prefix") -> Column:
    """arXiv identifiers as each source cleans them.

    ``prefix`` drops the exact ``arXiv:``, ``versioned`` also a trailing
    version digit and any case of the prefix, ``none`` keeps the value.
    """
    if mode == "prefix":
        return F.replace(c, F.lit("arXiv:"), F.lit(""))
    if mode == "versioned":
        return F.regexp_replace(c, r"(?i)(arxiv:|v[0-9]$)", "")
    if mode == "none":
        return c
    raise ValueError(f"unknown mode {mode!r}")


def clean_orcid(c: Column, mode: str = "dashed") -> Column:
    """``dashed`` cuts ``ORCID-``, ``cut`` six characters after ``ORCID``,
    ``label`` puts ``ORCID:`` in front of a bare number."""
    c = F.nullif(c, F.lit(""))
    if mode == "dashed":
        return F.regexp_replace(c, r"^ORCID-", "")
    if mode == "cut":
        return F.when(F.startswith(c, F.lit("ORCID")), F.substring(c, 7, 1 << 20)).otherwise(c)
    if mode == "label":
        return F.concat(F.lit("ORCID:"), c)
    raise ValueError(f"unknown mode {mode!r}")


def page_count(first: Column, last: Column) -> Column:
    """``last - first + 1``, NULL when either is not a whole number."""
    number = r"^\s*[+-]?\d{1,9}\s*$"
    return F.when(
        first.rlike(number) & last.rlike(number),
        F.trim(last).cast("int") - F.trim(first).cast("int") + 1,
    )


def page_range(c: Column) -> Column:
    """First and last page of ``12-15``; a lone page has an empty last page."""
    parts = F.split(c, "-", 2)
    return F.struct(
        F.get(parts, F.lit(0)).alias("fpage"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("lpage"),
    )


def to_int(c: Column) -> Column:
    return F.trim(c).try_cast("int")


def all_ints(arr: Column) -> Column:
    """An array of numbers, NULL as a whole if one value is not a number."""
    numbers = F.transform(arr, to_int)
    return F.when(F.forall(numbers, lambda n: n.isNotNull()), numbers)


def file_type(path: Column) -> Column:
    """Lower-cased extension of a file name."""
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
