"""Comparing prices across currencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import gap, to_usd
from .asof import asof_within, fill_forward

ITEM = ("app_id", "market_hash_name")


def converted_prices(obs: DataFrame, currencies: DataFrame, rates: DataFrame, prior_date: bool = False) -> DataFrame:
    """Price observations of a controlled currency in US dollars; without a rate for the day they are dropped, or with
    ``prior_date`` take the latest earlier rate.

    ``currencies``: ``currency_code, iso_code``; ``rates``: ``rate_date, currency_iso, rate_to_usd``.
    """
    prices = obs.filter((F.col("source_endpoint") == "priceoverview") & F.col("lowest_sell").isNotNull())
    prices = prices.withColumn("observation_date", F.to_date("observed_at"))
    named = prices.join(currencies.select("currency_code", "iso_code"), prices["currency"] == F.col("currency_code"), "left")
    if prior_date:
        days = named.select(F.col("iso_code").alias("currency_iso"), F.col("observation_date").alias("rate_date")).distinct()
        rates = fill_forward(days, rates, ["currency_iso"], "rate_date", "rate_to_usd")
    rated = named.join(rates, (named["observation_date"] == rates["rate_date"]) & (named["iso_code"] == rates["currency_iso"]), "left")
    return rated.filter(F.col("rate_to_usd").isNotNull()).select(
        *ITEM,
        "observed_at",
        "observation_date",
        "currency",
        "iso_code",
        "lowest_sell",
        (F.col("lowest_sell") / F.lit(100.0)).alias("local_price"),
        "rate_to_usd",
        to_usd(F.col("lowest_sell"), F.col("rate_to_usd")).alias("usd_equivalent"),
    )


def dislocation(converted: DataFrame, slice_days: int | None = 7) -> DataFrame:
    """Each price in another currency beside the latest dollar price of the same item at or before it."""
    carried = {"observed_at": "baseline_at", "usd_equivalent": "baseline_usd_price"}
    joined = asof_within(converted, ITEM, "observed_at", F.col("iso_code") == "USD", carried, slice_days)
    absolute, percent = gap(F.col("usd_equivalent"), F.col("baseline_usd_price"))
    return joined.withColumn("usd_gap", absolute).withColumn("pct_gap", percent)


def day_average_gap(converted: DataFrame) -> DataFrame:
    """The plain form: day averages per currency joined with the dollar's day average."""
    keys = [*ITEM, "observation_date"]
    mean = converted.groupBy(*keys, "iso_code").agg(F.avg("usd_equivalent").alias("avg_usd"))
    usd = mean.filter("iso_code = 'USD'").select(*keys, F.col("avg_usd").alias("usd_baseline"))
    absolute, percent = gap(F.col("avg_usd"), F.col("usd_baseline"))
    return mean.filter("iso_code <> 'USD'").join(usd, keys).withColumn("usd_gap", absolute).withColumn("pct_gap", percent)
