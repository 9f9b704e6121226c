"""URL domains and canonical URLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_BEFORE_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?"
# Characters a path may hold unescaped.
_PATH_SAFE = r"A-Za-z0-9:/?#\[\]@!$&'()*+,;=\-._~%"


def _scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def _netloc(url: Column) -> Column:
    return F.regexp_extract(url, _NETLOC, 1)


def parse_domain(url: Column) -> Column:
    """``scheme://host/`` of a URL."""
    return F.concat(_scheme(url), F.lit("://"), _netloc(url), F.lit("/"))


def _canonical_path(path: Column) -> Column:
    kept = path
    for code in ("2F", "3F"):
        for written in {code, code.lower()}:
            kept = F.replace(kept, F.lit(f"%{written}"), F.lit(f"%25{code}"))
    plain = F.try_url_decode(F.replace(kept, F.lit("+"), F.lit("%2B")))
    plain = F.when(F.contains(path, F.lit("%")), F.coalesce(plain, path)).otherwise(path)
    runs = F.regexp_extract_all(plain, F.lit(rf"([{_PATH_SAFE}]+|[^{_PATH_SAFE}]+)"), F.lit(1))
    quoted = F.array_join(
        F.transform(
            runs,
            lambda run: F.when(run.rlike(f"^[{_PATH_SAFE}]"), run).otherwise(
                F.replace(F.url_encode(run), F.lit("+"), F.lit("%20"))
            ),
        ),
        "",
    )
    return F.when(plain.rlike(f"[^{_PATH_SAFE}]"), quoted).otherwise(plain)


def _encode(text: Column) -> Column:
    return F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A"))


def _decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def _canonical_query(query: Column) -> Column:
    """Arguments decoded, sorted by name and value, and encoded again."""

    def pair(arg: Column) -> Column:
        parts = F.split(arg, "=", 2)
        value = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
        return F.struct(_decode(F.get(parts, F.lit(0))).alias("k"), _decode(value).alias("v"))

    args = F.filter(F.split(query, "[&;]", -1), lambda arg: arg != "")
    ordered = F.array_sort(F.transform(args, pair))
    return F.array_join(
        F.transform(ordered, lambda kv: F.concat(_encode(kv["k"]), F.lit("="), _encode(kv["v"]))),
        "&",
    )


def canonical_url(url: Column) -> Column:
    """One spelling per address: sorted arguments, no fragment, lower-case
    host, and a path that is never empty."""
    address = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    scheme, netloc = _scheme(address), F.lower(_netloc(address))
    rest = F.regexp_replace(address, _BEFORE_PATH, "")
    path = _canonical_path(F.regexp_extract(rest, r"(?s)^([^?]*)", 1))
    query = _canonical_query(F.regexp_extract(rest, r"(?s)\?(.*)$", 1))
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(netloc != "", F.concat(F.lit("//"), F.rtrim(netloc, F.lit(":")))).otherwise(""),
        F.when(path == "", "/").otherwise(path),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )
