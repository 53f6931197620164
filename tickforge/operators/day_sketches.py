"""Figures over any range of days from stored sketches of single days, without the rows they were made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Log2 of a distinct-count sketch's registers (standard error about ``1.04 / sqrt(2 ** LOG_K)``), and the size of a quantile sketch (rank error about 1 %).
LOG_K, QUANTILE_K = 14, 400


def sketch_days(rows: DataFrame, by: Sequence[str], ts: str, value: str, distinct: Sequence[str]) -> DataFrame:
    """``by, day, n, total, low, high, values, keys``: for each group and day the count, sum, least and greatest value, a quantile sketch of the values and a sketch of the distinct
    ``distinct`` columns.  Rows without a value or time are left out.

    Everything combines on the map side, so a group's rows are never brought together; what is stored is a few kilobytes for each group and day.
    """
    v = F.col(value).cast("double")
    return rows.filter(F.col(value).isNotNull() & F.col(ts).isNotNull()).groupBy(*by, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(v).alias("total"),
        F.min(v).alias("low"),
        F.max(v).alias("high"),
        F.kll_sketch_agg_double(v, QUANTILE_K).alias("values"),
        F.hll_sketch_agg(F.to_json(F.struct(*distinct)), LOG_K).alias("keys"),
    )


def replace_days(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored sketches with the days of ``new`` in place of what was there: days are made again as a whole, never added to."""
    return stored.join(new.select("day").distinct(), "day", "left_anti").select(*stored.columns).unionByName(new.select(*stored.columns))


def over_days(stored: DataFrame, by: Sequence[str], since: str | None = None, until: str | None = None, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``by, n, mean, low, high, distinct, q25, ...`` over a range of days (both ends included), from their sketches alone.  Count, mean and ends are exact, the others estimates."""
    days = stored
    if since is not None:
        days = days.filter(F.col("day") >= F.lit(since).cast("date"))
    if until is not None:
        days = days.filter(F.col("day") <= F.lit(until).cast("date"))
    united = days.groupBy(*by).agg(
        F.sum("n").alias("n"),
        (F.sum("total") / F.sum("n")).alias("mean"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("distinct"),
        F.kll_merge_agg_double("values", QUANTILE_K).alias("_values"),
    )
    return united.select("*", *(F.kll_sketch_get_quantile_double("_values", F.lit(float(q))).alias(f"q{round(q * 100):02d}") for q in quantiles)).drop("_values")
