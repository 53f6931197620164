"""Joins of points with the ranges that hold them, by bins of the axis instead of a nested loop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    """A time as whole microseconds, for an axis of times."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def range_join(points: DataFrame, ranges: DataFrame, on: Sequence[str], at: str, low: Column, high: Column, width: int, how: str = "inner", closed: tuple[bool, bool] = (True, True)) -> DataFrame:
    """Each row of ``points`` with each row of ``ranges`` that has equal keys and ``low <= at <= high`` (an end that isn't ``closed`` is left out).

    ``at`` is a whole-numbered column of ``points`` (days, microseconds), ``low`` and ``high`` whole-numbered expressions over ``ranges``; ``width`` is the width of a bin in the same unit, best about as
    long as a usual range.  A range is copied to every bin that it touches and a point stands in one, so no pair comes twice, the join is an equi-join by key and bin, and a hot key is spread over
    its bins.  A range costs ``length / width + 2`` copies at most; nothing else grows with it.  ``how``: ``inner`` or ``left`` (points without a range are kept).  The columns of ``ranges`` must not clash
    with those of ``points`` but for the keys.  Null keys, points and ends match nothing; ranges that end before they begin are empty.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    bin_of = lambda c: F.floor(c / F.lit(width)).cast("bigint")
    copies = ranges.select("*", low.cast("bigint").alias("_low"), high.cast("bigint").alias("_high")).filter("_low <= _high")
    copies = copies.select("*", F.explode(F.sequence(bin_of(F.col("_low")), bin_of(F.col("_high")))).alias("_bin"))
    copies = copies.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(on)), *(c for c in copies.columns if c not in on))
    left = points.withColumn("_at_bin", bin_of(F.col(at).cast("bigint")))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(on)], F.col("_at_bin") == F.col("_bin"))
    begins = F.col(at) >= F.col("_low") if closed[0] else F.col(at) > F.col("_low")
    ends = F.col(at) <= F.col("_high") if closed[1] else F.col(at) < F.col("_high")
    keep = [*points.columns, *(c for c in ranges.columns if c not in on)]
    return left.join(copies, same & begins & ends, how).select(*keep)


def trailing_mean(rows: DataFrame, on: Sequence[str], at: str, value: str, back: int, out: str) -> DataFrame:
    """Each row with the mean of ``value`` over the rows of its key less than ``back`` before it, itself included, as a range join and one aggregation.

    The general form of a correlated subquery over a range; where the frame is a plain trailing one, a window does the same in one sort.  Rows are told apart by all their columns; equal rows share
    a result.
    """
    past = rows.filter(F.col(value).isNotNull()).select(*on, F.col(at).alias("_from"), F.col(value).alias("_value"))
    pairs = range_join(rows.distinct(), past, on, at, F.col("_from"), F.col("_from") + back, max(back, 1), "left", (True, False))
    means = pairs.groupBy(*rows.columns).agg(F.avg("_value").alias(out))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in rows.columns])
    return rows.join(means.select(*(F.col(c).alias(f"_m_{c}") for c in rows.columns), out), same).select(*rows.columns, out)
