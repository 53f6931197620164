"""Payloads of three endpoints to one observation schema; the same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import depth
from ..functions.money import CURRENCIES, money_domain, parse_price, parse_volume
from ..functions.times import utc
from ..schemas import ORDER_BOOK, PRICE_OVERVIEW, SEARCH_RENDER

ROW = "struct<market_hash_name:string,lowest_sell:bigint,highest_buy:bigint,sell_listings:bigint,volume:bigint,currency:int>"


def decode_envelopes(messages: DataFrame) -> DataFrame:
    """``key, value`` (string or binary) to the fields of the envelope.  The value is parsed once; broken JSON gives nulls."""
    fields = "endpoint string, app_id int, currency int, observed_at string, request_params string, raw_payload string"
    e = F.from_json(F.col("value").cast("string"), fields, {"mode": "PERMISSIVE"})
    # What explode gives isn't computed again by filters on its fields.
    return messages.select(F.col("key").cast("string").alias("kafka_key"), F.explode(F.array(e)).alias("e")).select(
        "kafka_key",
        F.col("e.endpoint").alias("endpoint"),
        F.col("e.app_id").alias("app_id"),
        F.col("e.currency").alias("request_currency"),
        utc(F.col("e.observed_at")).alias("observed_at"),
        F.col("e.request_params").alias("request_params"),
        F.col("e.raw_payload").alias("raw_payload_json"),
    )


def item_of_key(key: Column) -> Column:
    """What follows the first colon of a message key."""
    return F.substring(key, F.instr(key, ":") + 1, F.length(key))


def message_key(app_id: Column, name: Column) -> Column:
    return F.concat(app_id.cast("string"), F.lit(":"), F.coalesce(name, F.lit("")))


def _separator(currency: Column, at: int) -> Column:
    return F.try_element_at(F.create_map(*(x for c in CURRENCIES for x in (F.lit(c[0]), F.lit(c[at])))), currency)


def _row(**values: Column) -> Column:
    names = ("market_hash_name", "lowest_sell", "highest_buy", "sell_listings", "volume", "currency")
    return F.struct(*(values.get(n, F.lit(None)).alias(n) for n in names)).cast(ROW)


def normalize(decoded: DataFrame, only_successful_books: bool = True) -> DataFrame:
    """Observations of all endpoints from one scan: each row's payload is parsed by its own endpoint's schema only."""
    payload = F.col("raw_payload_json")
    text = lambda endpoint: F.when(F.col("endpoint") == endpoint, payload)
    parsed = (
        decoded.withColumn("_search", F.from_json(text("search_render"), SEARCH_RENDER))
        .withColumn("_price", F.from_json(text("priceoverview"), PRICE_OVERVIEW))
        .withColumn("_book", F.from_json(text("orderbook"), ORDER_BOOK)["data"])
    )
    name = item_of_key(F.col("kafka_key"))
    currency = F.col("request_currency")
    results = F.transform(F.col("_search.results"), lambda r: _row(market_hash_name=r["hash_name"], lowest_sell=r["sell_price"], sell_listings=r["sell_listings"]))
    price = _row(
        market_hash_name=name,
        lowest_sell=parse_price(F.col("_price.lowest_price"), _separator(currency, 2), _separator(currency, 3)),
        volume=parse_volume(F.col("_price.volume")),
        currency=currency,
    )
    book = F.col("_book.data")
    side = _row(market_hash_name=name, lowest_sell=book["amtMinSellOrder"], highest_buy=book["amtMaxBuyOrder"], sell_listings=book["cSellOrders"], currency=book["eCurrency"])
    good = F.coalesce(F.col("_book.success"), F.lit(False)) if only_successful_books else F.lit(True)
    rows = F.when(F.col("endpoint") == "search_render", results).when(F.col("endpoint") == "priceoverview", F.array(price)).when((F.col("endpoint") == "orderbook") & good, F.array(side))
    out = parsed.select("app_id", "observed_at", F.col("endpoint").alias("source_endpoint"), F.explode(rows).alias("r"))
    out = out.select("app_id", "r.market_hash_name", "observed_at", "r.lowest_sell", "r.highest_buy", "r.sell_listings", "r.volume", "r.currency", "source_endpoint")
    out = out.filter(F.col("market_hash_name").isNotNull() & (F.col("market_hash_name") != ""))
    return out.withColumn("money_domain", money_domain(F.col("currency"), F.col("source_endpoint")))


def item_attributes(decoded: DataFrame) -> DataFrame:
    """Item attributes from catalogue pages: one row for each listed item."""
    pages = decoded.filter("endpoint = 'search_render'").withColumn("p", F.from_json("raw_payload_json", SEARCH_RENDER))
    items = pages.select("app_id", "observed_at", F.explode("p.results").alias("i")).filter("i.hash_name is not null")
    return items.select(
        "app_id",
        F.col("i.hash_name").alias("market_hash_name"),
        "observed_at",
        F.col("i.asset_description.name").alias("item_name"),
        F.col("i.asset_description.type").alias("item_type"),
        F.col("i.asset_description.name_color").alias("rarity_color"),
        F.col("i.asset_description.commodity").alias("commodity"),
        F.col("i.asset_description.market_bucket_group_id").alias("group_id"),
    )


def orderbook_snapshots(decoded: DataFrame, mapping: DataFrame, bands: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """Order books with their measures: spread, its basis points and the depth of either side within some percent of the mid.

    The item is that of the requested bucket (``mapping``: ``app_id, market_hash_name, market_bucket_id``), else the key's.
    """
    book = F.col("_book.data")
    # A payload is parsed once: what explode gives isn't computed again for each of its fields.
    parsed = F.explode(F.array(F.from_json("raw_payload_json", ORDER_BOOK)["data"])).alias("_book")
    rows = decoded.filter("endpoint = 'orderbook'").select("*", parsed).filter("_book.success")
    rows = rows.select(
        "app_id",
        "observed_at",
        item_of_key(F.col("kafka_key")).alias("_item"),
        F.get_json_object("request_params", "$.market_bucket_id").alias("market_bucket_id"),
        book["amtMinSellOrder"].alias("lowest_sell"),
        book["amtMaxBuyOrder"].alias("highest_buy"),
        book["cBuyOrders"].alias("buy_orders"),
        book["cSellOrders"].alias("sell_orders"),
        book["eCurrency"].alias("currency"),
        book["rgCompactBuyOrders"].alias("_buy"),
        book["rgCompactSellOrders"].alias("_sell"),
    )
    mid = (F.col("lowest_sell") + F.col("highest_buy")) / F.lit(2.0)
    known = mapping.select(F.col("app_id").alias("_app"), F.col("market_bucket_id").alias("_bucket"), F.col("market_hash_name").alias("_known"))
    # Of a bucket that several items share (see ``identity.shared_buckets``) the first by name.
    known = known.groupBy("_app", "_bucket").agg(F.min("_known").alias("_known"))
    rows = rows.join(known, (F.col("app_id") == F.col("_app")) & (F.col("market_bucket_id") == F.col("_bucket")), "left")
    return rows.select(
        "app_id",
        F.coalesce("_known", "_item").alias("market_hash_name"),
        "market_bucket_id",
        "observed_at",
        "lowest_sell",
        "highest_buy",
        "buy_orders",
        "sell_orders",
        "currency",
        depth.spread(F.col("lowest_sell"), F.col("highest_buy")).alias("spread"),
        depth.spread_bps(F.col("lowest_sell"), F.col("highest_buy")).alias("spread_bps"),
        *(depth.depth_within_pct(F.col(f"_{side}"), mid, pct / 100, side).alias(f"{side}_depth_{pct}") for side in ("buy", "sell") for pct in bands),
        F.col("_known").isNotNull().alias("resolved"),
    )
