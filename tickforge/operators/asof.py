"""As-of joins: each left row with the latest right row of equal keys at or before it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    prefix: str = "r_",
    slice_days: int | None = None,
) -> DataFrame:
    """Left columns, then the right row's other columns and time under ``prefix``; null where nothing comes before.

    Both sides are one union, sorted once per key: linear, one exchange, no range comparison.  Right rows at the same time are taken
    in the order of their columns, the last wins.  Null keys match nothing.

    With ``slice_days`` a key's time is cut into slices that are sorted apart, and each slice is given the last right row of the slices
    before, so a hot key spreads over as many tasks as it has slices.
    """
    keys = [F.col(k) for k in on]
    carried = [c for c in right.columns if c not in on]
    r_row = F.struct(F.col(right_ts).alias("_at"), *(F.col(c).alias(f"{prefix}{c}") for c in carried))
    whole = F.struct(*(F.col(c) for c in left.columns))
    blank = left.select(whole.alias("l")).schema["l"].dataType
    some = reduce(lambda a, b: a & b, [k.isNotNull() for k in keys])
    rights = right.filter(some).select(*on, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), F.lit(None).cast(blank).alias("_l"), r_row.alias("_r"))
    kind = rights.schema["_r"].dataType
    lefts = left.select(*on, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), whole.alias("_l"), F.lit(None).cast(kind).alias("_r"))
    both = lefts.unionByName(rights)
    got = _with_last(both, on, slice_days)
    got = got.filter("_side = 1").withColumn("_m", F.when(some, F.col("_m")))
    return got.select("_l.*", *(F.col(f"_m.{prefix}{c}").alias(f"{prefix}{c}") for c in carried))


def _with_last(both: DataFrame, on: Sequence[str], slice_days: int | None) -> DataFrame:
    """Rows ``on, _ts, _side, _r`` with ``_m``, the last ``_r`` at or before each."""
    parts = [*on]
    if slice_days:
        both = both.withColumn("_slice", F.floor(F.datediff(F.col("_ts").cast("date"), F.lit("1970-01-01").cast("date")) / slice_days))
        parts.append("_slice")
    order = Window.partitionBy(*parts).orderBy("_ts", "_side", "_r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = both.withColumn("_m", F.last("_r", ignorenulls=True).over(order))
    if slice_days:
        ends = both.groupBy(*parts).agg(F.max("_r").alias("_end"))
        earlier = Window.partitionBy(*on).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.withColumn("_before", F.last("_end", ignorenulls=True).over(earlier)).select(*(F.col(p).alias(f"_k{i}") for i, p in enumerate(parts)), "_before")
        same = reduce(lambda a, b: a & b, [F.col(p) == F.col(f"_k{i}") for i, p in enumerate(parts)])
        got = got.join(ends, same, "left").withColumn("_m", F.coalesce("_m", "_before"))
    return got


def asof_within(rows: DataFrame, on: Sequence[str], ts: str, is_right: Column, carried: dict[str, str], slice_days: int | None = None) -> DataFrame:
    """The rows of a table for which ``is_right`` is false, each with columns of the latest row of equal keys at or before it for which it is true.

    As ``asof_join`` of two filters of ``rows``, but the table is evaluated once for both sides (and once more for the ends of slices).  ``carried``: right column to the name
    that it gets.  Rows for which ``is_right`` is null are left out; null keys match nothing.
    """
    whole, right = F.struct(*(F.col(c) for c in rows.columns)), F.struct(F.col(ts).alias("_at"), *(F.col(c).alias(name) for c, name in carried.items()))
    some = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    flagged = rows.withColumn("_right", is_right).filter(F.col("_right").isNotNull() & (some | ~F.col("_right")))
    both = flagged.select(*on, F.col(ts).alias("_ts"), F.when(F.col("_right"), 0).otherwise(1).alias("_side"), F.when(~F.col("_right"), whole).alias("_l"), F.when(F.col("_right"), right).alias("_r"))
    got = _with_last(both, on, slice_days).filter("_side = 1").withColumn("_m", F.when(some, F.col("_m")))
    return got.select("_l.*", *(F.col(f"_m.{name}").alias(name) for name in carried.values()))


def fill_forward(spine: DataFrame, values: DataFrame, on: Sequence[str], day: str, value: str) -> DataFrame:
    """``spine`` (keys and days) with the latest value at or before each day."""
    return asof_join(spine, values, on, day, day).drop(f"r_{day}").withColumnRenamed(f"r_{value}", value)
