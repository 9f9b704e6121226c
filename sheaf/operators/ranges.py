"""Runs of consecutive whole numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def range_as_string(values: Column) -> Column:
    """``[1981, 1982, 1985]`` as ``1981-1982, 1985``, in the given order."""
    numbers = F.transform(values, lambda v: v.cast("long"))
    size = F.size(numbers)

    def starts(v: Column, i: Column) -> Column:
        return (i == 0) | (F.get(numbers, i - 1) + 1 != v)

    def ends(v: Column, i: Column) -> Column:
        return (i == size - 1) | (F.get(numbers, i + 1) != v + 1)

    pairs = F.zip_with(
        F.filter(numbers, starts),
        F.filter(numbers, ends),
        lambda lo, hi: F.when(lo == hi, lo.cast("string")).otherwise(
            F.concat_ws("-", lo.cast("string"), hi.cast("string"))
        ),
    )
    return F.array_join(pairs, ", ")


def integer_ranges(
    df: DataFrame, keys: Sequence[str], value: str, width: int = 1024
) -> DataFrame:
    """Maximal runs ``lo``..``hi`` of the distinct values of each key.

    The numbers of a bucket, up to 64, are the bits of one number, so equal
    values and buckets come together in one aggregation that needs no order.
    Only runs that touch a bucket's edge go on: they are stitched within
    buckets of ``width`` squared, and what then touches an edge once more, for
    the whole key.  A key that holds most rows is thus spread over its buckets
    at every step but the last, which sees two runs of ``width`` squared
    numbers at most.
    """
    small = max(d for d in range(1, _BITS + 1) if width % d == 0)
    values = df.select(*keys, F.col(value).cast("long").alias("_v"))
    within = F.pmod("_v", F.lit(small)).cast("int")
    buckets = (
        values.withColumn("_first", F.col("_v") - within)
        .groupBy(*keys, "_first")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), within)).alias("_bits"))
    )
    runs = buckets.select(*keys, "_first", F.explode_outer(_runs_of_bits(F.col("_bits"), small)).alias("_run")).select(
        *keys, (F.col("_first") + F.col("_run.lo")).alias("lo"), (F.col("_first") + F.col("_run.hi")).alias("hi")
    )
    wide = width * width
    # Edges of the wider buckets are edges of the smaller ones too, so a run that touches none is whole.
    near = _stitch(runs.where(_touches(small)), keys, F.floor(F.col("lo") / wide))
    far = _stitch(near.where(_touches(wide)), keys, F.lit(0))
    return runs.where(~_touches(small)).unionByName(near.where(~_touches(wide))).unionByName(far)


_BITS = 64


def _runs_of_bits(bits: Column, width: int) -> Column:
    """First and last position of each run of set bits."""

    def run(lo: Column, hi: Column) -> Column:
        return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))

    def positions(marked: Column) -> Column:
        every = F.array(*[F.lit(i) for i in range(width)])
        return F.filter(every, lambda i: F.call_function("shiftrightunsigned", marked, i).bitwiseAND(F.lit(1)) == 1)

    starts = bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1)))
    ends = bits.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(bits, 1)))
    # Most buckets of scattered values hold a single run, of one value.
    last = F.length(F.bin(bits)) - 1
    return (
        F.when(F.bit_count(bits) == 1, F.array(run(last, last)))
        .when(bits.isNotNull(), F.zip_with(positions(starts), positions(ends), run))
    )


def _touches(width: int) -> Column:
    """Whether a run meets an edge of buckets of ``width``."""
    edge = (F.pmod("lo", F.lit(width)) == 0) | (F.pmod(F.col("hi") + 1, F.lit(width)) == 0)
    return F.coalesce(edge, F.lit(False))


def _stitch(runs: DataFrame, keys: Sequence[str], within: Column) -> DataFrame:
    """Join runs that follow each other, each part of a key for itself."""
    along = Window.partitionBy(*keys, "_part").orderBy("lo")
    broken = F.coalesce(F.lag("hi").over(along) + 1 != F.col("lo"), F.lit(True))
    return (
        runs.withColumn("_part", within)
        .withColumn("_break", broken.cast("long"))
        .withColumn("_island", F.sum("_break").over(along))
        .groupBy(*keys, "_part", "_island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select(*keys, "lo", "hi")
    )


def adjacent_ranges(
    df: DataFrame, keys: Sequence[str], position: str, value: str, width: int = 1024
) -> DataFrame:
    """Runs of values that follow each other in position as well.

    Rows of a run share the difference of value and position, so they are the
    ranges of positions for each difference.
    """
    shifted = df.withColumn("_shift", F.col(value).cast("long") - F.col(position))
    runs = integer_ranges(shifted, [*keys, "_shift"], position, width)
    return runs.select(
        *keys,
        F.col("lo").alias("first_position"),
        (F.col("lo") + F.col("_shift")).alias("lo"),
        (F.col("hi") + F.col("_shift")).alias("hi"),
    )


def range_text(lo: Column, hi: Column) -> Column:
    return F.when(lo == hi, lo.cast("string")).otherwise(
        F.concat_ws("-", lo.cast("string"), hi.cast("string"))
    )
