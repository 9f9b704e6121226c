"""Children of records as rows: linking, deduplication and regrouping.

Inside a record, array functions do all this without a shuffle.  These
operators are for children that are already rows, or records so large that
they should be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def explode_list(df: DataFrame, column: str, position: str, item: str) -> DataFrame:
    """One row per element of a list, numbered from 0, in place of the list.

    An outer explode with a filter on the position: for an inner one the
    optimizer would compute the list a second time to filter out empty ones.
    """
    rest = [c for c in df.columns if c != column]
    exploded = df.select(*rest, F.posexplode_outer(column).alias(position, item))
    return exploded.where(F.col(position).isNotNull())


def explode_authors(records: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per author, with ``seq`` for the order."""
    return explode_list(records.select(key, "authors"), "authors", "seq", "author").select(
        key, "seq", "author.*"
    )


def explode_affiliations(records: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per author and affiliation."""
    authors = explode_authors(records, key).select(key, "seq", "full_name", "affiliations")
    return explode_list(authors, "affiliations", "aff_seq", "aff").select(
        key, "seq", "full_name", "aff_seq", "aff.*"
    )


def last_wins(df: DataFrame, keys: Sequence[str], position: Column | str) -> DataFrame:
    """One row per key, the one that comes last."""
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), position).alias("_row"))
    return chosen.select(*keys, "_row.*")


def first_by_priority(df: DataFrame, keys: Sequence[str], priority: Column | str) -> DataFrame:
    """One row per key, the one with the least priority value."""
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), priority).alias("_row"))
    return chosen.select(*keys, "_row.*")


def link_references(
    references: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    ref_id: str,
    target_position: str,
    how: str = "inner",
) -> DataFrame:
    """Join references to what they name within the same record.

    ``targets`` has the keys, ``ref_id`` and its values; of several targets
    with one id the last counts.  As every reference meets at most one target,
    the join splits skewed keys freely.
    """
    on = [*keys, ref_id]
    unique = last_wins(targets, on, target_position).drop(target_position)
    return references.join(unique, on, how)


def distinct_in_order(
    df: DataFrame, keys: Sequence[str], value: str, seq: Column | str
) -> DataFrame:
    """Distinct values per key, each with the place it was first seen."""
    return df.groupBy(*keys, value).agg(F.min(seq).alias("first_seen"))


def regroup(
    children: DataFrame, keys: Sequence[str], seq: str, fields: Sequence[str], chunk: int
) -> DataFrame:
    """Ordered lists of children, at most ``chunk`` of them in a row.

    ``seq`` numbers the children of a key from 0.  A record with more children
    gets several rows, numbered by ``chunk_no``; so no list outgrows a task.
    """
    numbered = children.withColumn("chunk_no", F.floor(F.col(seq) / chunk))
    listed = F.array_sort(F.collect_list(F.struct(seq, *fields)))
    return numbered.groupBy(*keys, "chunk_no").agg(listed.alias("children"))
