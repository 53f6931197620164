"""The batch run from landed envelopes to marts, with gates between the layers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly, bars, cdc, fx, identity, normalize, quality, scd2
from ..schemas import WATCHED
from ..sources import lake


@dataclass
class Run:
    spark: SparkSession
    root: str
    now: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    log: list[str] = field(default_factory=list)

    def build(self, name: str, make: Callable[[], DataFrame]) -> None:
        self.tables[name] = lake.replace_table(make(), f"{self.root}/{name}")
        self.log.append(f"built {name}")

    def gate(self, name: str, checks: list[quality.Check]) -> None:
        result = quality.run_gate(checks, stop=False)
        self.log.append(f"{name}: {result}")
        if not result.success:
            raise quality.GateFailed(f"{name}: {result}")


#: What the marts must have, as columns that are never null: table -> columns.
DECLARED = {
    "item_daily": ("app_id", "market_hash_name", "money_domain", "observation_date", "open_price", "high_price", "low_price", "close_price", "observation_count"),
    "dislocation": ("app_id", "market_hash_name", "observed_at", "iso_code", "usd_equivalent"),
    "anomalies": ("app_id", "market_hash_name", "anomaly_type", "severity", "observed_at", "computed_at"),
    "orderbook_snapshot": ("app_id", "market_hash_name", "observed_at"),
    "item_bucket_map": ("app_id", "market_hash_name", "market_bucket_id"),
    "dim_item": ("app_id", "market_hash_name", "valid_from"),
}
TRACKED = ["item_name", "item_type", "rarity_color", "commodity"]


def _versions(spark: SparkSession, path: str, attributes: DataFrame, now: str) -> DataFrame:
    """The item dimension: the latest attributes merged into the versions that an earlier run published."""
    newest = bars.latest(attributes, ["app_id", "market_hash_name"], "observed_at", *TRACKED).select("app_id", "market_hash_name", *TRACKED)
    at = F.lit(now).cast("timestamp_ntz")
    past = lake.published(spark, path)
    out = scd2.scd2_first(newest, at) if past is None else scd2.scd2_merge(past, newest, ["app_id", "market_hash_name"], TRACKED, at)
    lake.publish_version(out, path)
    return scd2.with_current_flag(lake.read_current(spark, path))


def run(spark: SparkSession, bronze: str, root: str, now: str, currencies: DataFrame, rates: DataFrame, pages: DataFrame | None = None) -> Run:
    """Gate the landed envelopes, then build observations, items and their buckets, order books, changes, daily bars, the currency
    comparison and anomalies.  ``pages``: ``app_id, market_hash_name, market_bucket_id, observed_at`` read from item pages.

    A failed blocking gate raises and nothing after it is built; the mirror of what was built is made all the same.
    """
    r = Run(spark, root, now)
    raw = lake.read_bronze(spark, bronze)
    try:
        r.gate("bronze", quality.bronze_checks(raw, now))
        messages = raw.select(normalize.message_key(F.col("app_id"), F.get_json_object("request_params", "$.item")).alias("key"), F.to_json(F.struct(*raw.columns)).alias("value"))
        decoded = normalize.decode_envelopes(messages)
        r.build("observations", lambda: normalize.normalize(decoded))
        r.build("item_attributes", lambda: normalize.item_attributes(decoded))
        commodities = identity.buckets_from_commodities(r.tables["item_attributes"])
        r.build("item_bucket_map", lambda: identity.item_bucket_map(commodities, commodities.limit(0) if pages is None else pages))
        r.build("orderbook_snapshot", lambda: normalize.orderbook_snapshots(decoded, r.tables["item_bucket_map"]))
        r.build("dim_item", lambda: _versions(spark, f"{root}/versions/dim_item", r.tables["item_attributes"], now))
        obs = r.tables["observations"]
        r.gate("observations", [
            quality.Check("not_null", "block", quality.not_null(obs, ["app_id", "market_hash_name", "observed_at", "money_domain"])),
            quality.Check("grain", "warn", quality.duplicate_grain(obs, ["app_id", "market_hash_name", "observed_at", "currency", "source_endpoint"])),
            quality.Check("zero_decimal", "block", quality.unparsed_zero_decimal(obs)),
        ])
        r.build("changes", lambda: cdc.detect_changes(obs))
        r.gate("changes", [
            quality.Check("fields", "block", quality.not_accepted(r.tables["changes"], "field", WATCHED)),
            quality.Check("plausible", "warn", quality.implausible(r.tables["changes"])),
        ])
        r.build("item_daily", lambda: bars.item_daily(obs))
        r.build("dislocation", lambda: fx.dislocation(fx.converted_prices(obs, currencies, rates)))
        r.build("anomalies", lambda: anomaly.anomaly_mart(r.tables["item_daily"], obs.filter("source_endpoint = 'orderbook'"), now))
        r.gate("marts", [quality.Check(name, "block", quality.not_null(r.tables[name], columns)) for name, columns in DECLARED.items()])
    finally:
        for name, df in r.tables.items():
            lake.mirror(df, f"{root}/serving/{name}", now)
    return r
