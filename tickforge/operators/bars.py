"""Daily bars, time-weighted averages, rolling averages and latest rows, always inside one money domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ITEM = ("app_id", "market_hash_name")
BAR = (*ITEM, "money_domain", "observation_date")


def micros(later: str, earlier: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {earlier}, {later})")


def daily_bars(obs: DataFrame) -> DataFrame:
    """Open, high, low, close, volume and number of observations by item, money domain and day.

    Observations at the same time are ordered by endpoint, then price.
    """
    order = F.struct("observed_at", "source_endpoint", "lowest_sell")
    return (
        obs.filter(F.col("lowest_sell").isNotNull())
        .withColumn("observation_date", F.to_date("observed_at"))
        .groupBy(*BAR)
        .agg(
            F.min_by("lowest_sell", order).alias("open_price"),
            F.max("lowest_sell").alias("high_price"),
            F.min("lowest_sell").alias("low_price"),
            F.max_by("lowest_sell", order).alias("close_price"),
            F.sum(F.coalesce("volume", F.lit(0))).alias("total_volume"),
            F.count(F.lit(1)).alias("observation_count"),
        )
    )


def twap(rows: DataFrame, keys: Sequence[str], ts: str, value: str, out: str = "twap") -> DataFrame:
    """Average of ``value`` weighted by the seconds to the next row of the same key; null if that is no time at all.

    The last row of a key has no weight.
    """
    order = Window.partitionBy(*keys).orderBy(ts, value)
    spaced = rows.filter(F.col(value).isNotNull()).withColumn("_next", F.lead(ts).over(order))
    seconds = micros("_next", ts) / F.lit(1e6)
    return spaced.groupBy(*keys).agg(F.try_divide(F.sum(F.col(value) * seconds), F.sum(seconds)).alias(out))


def with_spread(obs: DataFrame) -> DataFrame:
    """Order-book rows with ``spread`` and the day."""
    books = obs.filter((F.col("source_endpoint") == "orderbook"))
    return books.withColumn("spread", F.col("lowest_sell") - F.col("highest_buy")).withColumn("observation_date", F.to_date("observed_at"))


def item_daily(obs: DataFrame) -> DataFrame:
    """Daily bars with the day's time-weighted spread of the same item and domain."""
    return daily_bars(obs).join(twap(with_spread(obs), BAR, "observed_at", "spread", "twap_spread"), list(BAR), "left")


def rolling_average(daily: DataFrame, days: int = 7, closed: bool = True) -> DataFrame:
    """Trailing mean of the close by item and domain.  ``closed`` includes the day exactly ``days`` ago."""
    back = days if closed else days - 1
    day = F.datediff("observation_date", F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy(*ITEM, "money_domain").orderBy("_day").rangeBetween(-back, 0)
    return daily.withColumn("_day", day).withColumn("rolling_avg_close", F.avg("close_price").over(frame)).drop("_day")


def latest(rows: DataFrame, keys: Sequence[str], ts: str, *ties: str) -> DataFrame:
    """The latest row of each key; null keys are a group of their own; ``ties`` decide between rows of equal time."""
    newest = F.max_by(F.struct(*rows.columns), F.struct(ts, *ties))  # combines before the shuffle; nothing is sorted
    return rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(newest.alias("_row")).select("_row.*")


def latest_by_self_join(rows: DataFrame, keys: Sequence[str], ts: str, null_safe: bool = False) -> DataFrame:
    """The same by joining each key's latest time.  With plain equality, rows with a null key are lost."""
    newest = rows.groupBy(*keys).agg(F.max(ts).alias("_newest")).select(*(F.col(k).alias(f"_{k}") for k in keys), "_newest")
    same = F.col(ts) == F.col("_newest")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}")) if null_safe else F.col(k) == F.col(f"_{k}")
    return rows.join(newest, same).select(*rows.columns)
