"""Joins to look-up tables and between listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def translate_codes(
    df: DataFrame, dimension: DataFrame, code: str, into: str, default: Column | None = None
) -> DataFrame:
    """Add the value of a code from a ``key, value`` table.

    The table may be of any size: Spark broadcasts it only when it is known
    to be small.  Keys are unique after the aggregation, so rows never
    multiply; unknown codes get the default, the code itself if none is given.
    """
    unique = dimension.groupBy("key").agg(F.max("value").alias("_value"))
    fallback = F.col(code) if default is None else default
    return (
        df.join(unique.withColumnRenamed("key", "_key"), F.col(code) == F.col("_key"), "left")
        .withColumn(into, F.coalesce("_value", fallback))
        .drop("_key", "_value")
    )


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Records of several sources in one table."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
