"""Payloads as ``VARIANT``: parsed once when they land, read by paths, with whatever fields they have.

A declared schema reads a field of another type as null and forgets fields that it doesn't name.  A variant keeps both: a number that comes as text is still read as a number, and fields that appear later
are there when somebody asks for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import money_domain, parse_price, parse_volume
from ..sources import lake
from .normalize import _row, _separator, item_of_key


def with_variants(decoded: DataFrame, text: str = "raw_payload_json", out: str = "payload") -> DataFrame:
    """Decoded envelopes with the payload as a variant instead of text.  Text that is no JSON becomes an object with that text as ``unparsed``, so nothing that came is lost; null stays null."""
    parsed = F.coalesce(F.try_parse_json(F.col(text)), F.to_variant_object(F.struct(F.col(text).alias("unparsed"))))
    return decoded.withColumn(out, F.when(F.col(text).isNotNull(), parsed)).drop(text)


def land(decoded: DataFrame, path: str) -> None:
    """Envelopes with variants as Parquet by day, hour, app and endpoint, in new files beside those that are there."""
    rows = lake.with_partitions(decoded)
    rows.hint("rebalance", *lake.BRONZE_PARTITIONS).write.mode("append").partitionBy(*lake.BRONZE_PARTITIONS).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    schema = "kafka_key string, request_currency int, observed_at timestamp_ntz, request_params string, payload variant, app_id int, endpoint string, dt string, hour string"
    return spark.read.schema(schema).parquet(path)


def get(value: Column, path: str, kind: str = "bigint") -> Column:
    """A path of a variant as a type; null where it isn't there or can't be that."""
    return F.try_variant_get(value, f"$.{path}", kind)


def normalize_variants(rows: DataFrame, only_successful_books: bool = True) -> DataFrame:
    """The observations that ``normalize`` makes of text, from variants."""
    payload, endpoint, currency = F.col("payload"), F.col("endpoint"), F.col("request_currency")
    name = item_of_key(F.col("kafka_key"))
    listed = F.try_variant_get(payload, "$.results", "array<variant>")
    results = F.transform(listed, lambda r: _row(market_hash_name=get(r, "hash_name", "string"), lowest_sell=get(r, "sell_price"), sell_listings=get(r, "sell_listings")))
    price = _row(
        market_hash_name=name,
        lowest_sell=parse_price(get(payload, "lowest_price", "string"), _separator(currency, 2), _separator(currency, 3)),
        volume=parse_volume(get(payload, "volume", "string")),
        currency=currency,
    )
    book = lambda field, kind="bigint": get(payload, f"data.data.{field}", kind)
    side = _row(market_hash_name=name, lowest_sell=book("amtMinSellOrder"), highest_buy=book("amtMaxBuyOrder"), sell_listings=book("cSellOrders"), currency=book("eCurrency", "int"))
    good = F.coalesce(get(payload, "data.success", "boolean"), F.lit(False)) if only_successful_books else F.lit(True)
    found = F.when(endpoint == "search_render", results).when(endpoint == "priceoverview", F.array(price)).when((endpoint == "orderbook") & good, F.array(side))
    out = rows.select("app_id", "observed_at", endpoint.alias("source_endpoint"), F.explode(found).alias("r"))
    out = out.select("app_id", "r.market_hash_name", "observed_at", "r.lowest_sell", "r.highest_buy", "r.sell_listings", "r.volume", "r.currency", "source_endpoint")
    out = out.filter(F.col("market_hash_name").isNotNull() & (F.col("market_hash_name") != ""))
    return out.withColumn("money_domain", money_domain(F.col("currency"), F.col("source_endpoint")))


def payload_schemas(rows: DataFrame) -> DataFrame:
    """``endpoint, n, fields``: the schema that all payloads of an endpoint together have, unknown fields and changed types included; schemas merge before the shuffle."""
    return rows.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"), F.schema_of_variant_agg("payload").alias("fields"))
