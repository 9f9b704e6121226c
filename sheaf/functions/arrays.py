"""Reducers over multi-valued fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it.

    Inside lambdas Spark does not share common expressions.
    """
    return F.get(F.transform(F.array(value), lambda x: fn(x)), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_nonempty(arr: Column, default=None) -> Column:
    """First value that is neither NULL nor an empty string."""
    value = F.try_element_at(F.filter(arr, lambda x: x.isNotNull() & (x != "")), F.lit(1))
    return value if default is None else F.coalesce(value, F.lit(default))


def first(arr: Column, default=None) -> Column:
    """First element, or the default for an empty or missing array."""
    value = F.try_element_at(arr, F.lit(1))
    return value if default is None else F.coalesce(value, F.lit(default))


def join_all(arr: Column, sep: str = " ") -> Column:
    return F.array_join(arr, sep)


def wrap(arr: Column, key: str = "value", **constants: str) -> Column:
    """Turn each value into a struct holding it under ``key``."""
    fixed = [F.lit(v).alias(k) for k, v in constants.items()]
    return F.transform(arr, lambda x: F.struct(*fixed, x.alias(key)))


def free_keywords(arr: Column, source: str = "author") -> Column:
    return wrap(arr, "value", source=source)


def classification_numbers(arr: Column, standard: str = "PACS") -> Column:
    return wrap(arr, "classification_number", standard=standard)


def map_values(arr: Column, *steps: Callable[[Column], Column]) -> Column:
    """Apply the steps to each value and drop the values that become NULL."""

    def chain(x: Column) -> Column:
        for step in steps:
            x = step(x)
        return x

    return F.array_compact(F.transform(arr, chain))


def flat_map(arr: Column, fn: Callable[[Column], Column]) -> Column:
    return F.flatten(F.array_compact(F.transform(arr, fn)))


def variant_nested(root: Column, *keys: str) -> Column:
    """Value at a path of a VARIANT, an empty string where any step is missing."""
    path = "$" + "".join(f'["{key}"]' for key in keys)
    return F.coalesce(F.try_variant_get(root, path, "string"), F.lit(""))


def empty_to_null(arr: Column) -> Column:
    """An empty list is the same as an absent field."""
    return let(arr, lambda a: F.when(F.size(a) > 0, a))


def eprints(arr: Column) -> Column:
    """arXiv entries of the values; categories are not known to any source."""
    categories = F.lit(None).cast("array<string>").alias("categories")
    return empty_to_null(F.transform(arr, lambda x: F.struct(x.alias("value"), categories)))
