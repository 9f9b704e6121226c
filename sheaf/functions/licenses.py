"""Licence names from URLs and from free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheaf import dims
from sheaf.functions.arrays import let

_EMPTY = "array<struct<license:string,url:string>>"


def license_entry(name: Column, url: Column) -> Column:
    return F.struct(name.alias("license"), url.alias("url"))


def license_name(url: Column) -> Column:
    """``CC-BY-3.0`` and the like; an empty string for an unknown licence."""
    name = F.lit("")
    for key, prefix in reversed(dims.LICENSES.items()):
        found = F.regexp_replace(F.btrim(url, F.lit("/")), f"(?i)^.*{key}", prefix)
        name = F.when(F.contains(F.lower(url), F.lit(key)), found).otherwise(name)
    return name


def license_by_url(url: Column) -> Column:
    """One entry for any URL that is given, no entry otherwise."""
    none = F.array().cast(_EMPTY)

    def entry(u: Column) -> Column:
        return F.when(
            F.coalesce(u, F.lit("")) != "", F.array(license_entry(license_name(u), u))
        ).otherwise(none)

    return let(url, entry)


def license_by_text(text: Column) -> Column:
    """Licence whose full name contains the text; the last such name wins."""
    url = F.lit(None).cast("string")
    for name, target in dims.LICENSE_TEXTS.items():
        url = F.when(F.contains(F.lit(name.lower()), F.lower(text)), target).otherwise(url)
    return license_by_url(F.when(F.coalesce(text, F.lit("")) != "", url))


def get_license(url: Column, text: Column | None = None) -> Column:
    """By URL where there is one, else by text."""
    if text is None:
        return license_by_url(url)
    return let(
        F.struct(url.alias("url"), text.alias("text")),
        lambda given: F.when(
            F.coalesce(given["url"], F.lit("")) != "", license_by_url(given["url"])
        ).otherwise(license_by_text(given["text"])),
    )


_VERSION = r"[0-9]+\.[0-9]"


def cc_by_license(url: Column) -> Column:
    """CC-BY with the version named in the URL; NULL for any other licence."""
    version = F.nullif(F.regexp_extract(url, _VERSION, 0), F.lit(""))
    return F.when(
        F.contains(url, F.lit("creativecommons.org/licenses/by/")) & version.isNotNull(),
        license_entry(F.concat(F.lit("CC-BY-"), version), url),
    )
