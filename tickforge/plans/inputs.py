"""The engine's inputs, derived from the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import CURRENCIES, RATES, money_domain

#: Apps that items belong to, by number.
APPS = (730, 570, 440, 252490, 578080)
#: Currencies of controlled price requests, by number.
REQUESTED = (0, 1, 2, 3)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple, n) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (n + 1).cast("int"))


def observations(spark: SparkSession, sf_dir: str, items: int | None = None) -> DataFrame:
    """``events`` as price observations: clicks and sign-ups are catalogue pages, purchases price requests, the rest order books.

    ``items`` folds users onto so many items.
    """
    e = table(spark, sf_dir, "events").filter("event_id is not null and user_id is not null")
    user = F.col("user_id") % items if items else F.col("user_id")
    k = F.regexp_extract("props", "([0-9]+)", 1).try_cast("bigint")
    endpoint = F.when(F.col("event_type").isin("click", "signup"), "search_render").when(F.col("event_type") == "purchase", "priceoverview").otherwise("orderbook")
    price = F.round(F.col("value") * 100).cast("bigint")
    controlled = _pick((1, 3, 13, 10), F.col("event_id") % 4)
    out = e.select(
        _pick(APPS, user % 5).alias("app_id"),
        F.concat(F.lit("item-"), user.cast("string")).alias("market_hash_name"),
        F.col("ts").alias("observed_at"),
        price.alias("lowest_sell"),
        F.when(endpoint == "orderbook", price + k - 60).alias("highest_buy"),
        F.when(endpoint != "priceoverview", k).alias("sell_listings"),
        F.when(endpoint == "priceoverview", k).alias("volume"),
        F.when(endpoint == "priceoverview", controlled).when(endpoint == "orderbook", 8).cast("int").alias("currency"),
        endpoint.alias("source_endpoint"),
    )
    return out.withColumn("money_domain", money_domain(F.col("currency"), F.col("source_endpoint")))


def currencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CURRENCIES, "currency_code int, iso_code string, thousands_sep string, decimal_sep string")


def rates(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Rates for each day with events, moving a little with the day of the month; with ``gaps`` only for days divisible by 3."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("rate_date")).distinct()
    if gaps:
        days = days.filter(F.dayofmonth("rate_date") % 3 == 0)
    base = spark.createDataFrame(RATES, "currency_iso string, base double")
    return days.crossJoin(F.broadcast(base)).select("rate_date", "currency_iso", (F.col("base") * (F.lit(1.0) + F.dayofmonth("rate_date") / F.lit(1000.0))).alias("rate_to_usd"))


def price_texts(obs: DataFrame) -> DataFrame:
    """Observations with a known currency and their price as text in its format."""
    sep = lambda at: F.try_element_at(F.create_map(*(x for c in CURRENCIES for x in (F.lit(c[0]), F.lit(c[at])))), F.col("currency"))
    rows = obs.filter("currency is not null and lowest_sell >= 0").withColumn("thousands_sep", sep(2)).withColumn("decimal_sep", sep(3))
    units, cents = F.floor(F.col("lowest_sell") / 100).cast("string"), F.lpad((F.col("lowest_sell") % 100).cast("string"), 2, "0")
    grouped = F.when(F.length(units) > 3, F.concat(F.substring(units, F.lit(1), F.length(units) - 3), F.col("thousands_sep"), F.right(units, F.lit(3)))).otherwise(units)
    text = F.when(F.col("decimal_sep") == "", F.concat(F.lit("~ "), grouped)).otherwise(F.concat(F.lit("~ "), grouped, F.col("decimal_sep"), cents))
    return rows.withColumn("price_text", text)


def envelopes(obs: DataFrame) -> DataFrame:
    """Observations as the messages that would have brought them: ``key, value``."""
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    num = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    text = price_texts(obs.filter("source_endpoint = 'priceoverview'"))
    rest = obs.filter("source_endpoint <> 'priceoverview' or lowest_sell is null or lowest_sell < 0 or currency is null").withColumn("price_text", F.lit(None).cast("string"))
    rows = text.select(*obs.columns, "price_text").unionByName(rest)
    # Three levels of a side, each a little further from the mid, as price and quantity.
    levels = lambda best, way: F.concat_ws(",", *(x for i in range(3) for x in ((F.col(best) + way * i * 37).cast("string"), (F.col("sell_listings") + i).cast("string"))))
    name = F.col("market_hash_name")
    group = F.concat(F.lit("G"), F.regexp_replace(name, "item-", ""))
    search = F.concat(
        F.lit('{"success":true,"results":[{"hash_name":'), q(name), F.lit(',"sell_price":'), num(F.col("lowest_sell")), F.lit(',"sell_listings":'), num(F.col("sell_listings")),
        F.lit(',"asset_description":{"name":'), q(name), F.lit(',"type":"t'), num(F.col("lowest_sell") % 3), F.lit('","name_color":"c'), num(F.col("lowest_sell") % 2),
        F.lit('","commodity":'), F.when(F.regexp_replace(name, "item-", "").cast("bigint") % 3 == 0, "0").otherwise("1"),
        F.lit(',"market_bucket_group_id":'), q(group), F.lit("}}]}"),
    )
    price = F.concat(F.lit('{"success":true,"lowest_price":'), F.coalesce(q(F.col("price_text")), F.lit("null")), F.lit(',"volume":"'), num(F.col("volume")), F.lit('"}'))
    book = F.concat(
        F.lit('{"data":{"success":'), F.when(F.col("lowest_sell") % 10 == 0, "false").otherwise("true"), F.lit(',"data":{"amtMaxBuyOrder":'), num(F.col("highest_buy")), F.lit(',"amtMinSellOrder":'),
        num(F.col("lowest_sell")), F.lit(',"eCurrency":8,"cBuyOrders":'), num(F.col("sell_listings") + 1), F.lit(',"cSellOrders":'), num(F.col("sell_listings")),
        F.lit(',"rgCompactBuyOrders":['), levels("highest_buy", -1), F.lit('],"rgCompactSellOrders":['), levels("lowest_sell", 1), F.lit("]}}}"),
    )
    payload = F.when(F.col("source_endpoint") == "search_render", search).when(F.col("source_endpoint") == "priceoverview", price).otherwise(book)
    request = F.when(F.col("source_endpoint") == "priceoverview", F.col("currency"))
    fields = F.struct(
        F.lit("api").alias("source"),
        F.col("source_endpoint").alias("endpoint"),
        "app_id",
        request.alias("currency"),
        F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("observed_at"),
        F.concat(F.lit('{"market_bucket_id":"'), F.regexp_replace(name, "item-", ""), F.lit('"}')).alias("request_params"),
        payload.alias("raw_payload"),
    )
    return rows.select(F.concat(F.col("app_id").cast("string"), F.lit(":"), name).alias("key"), F.to_json(fields).alias("value"))


def compact_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of an order as one side of a book: ``[price, quantity, ...]`` in cents, with the middle of its prices."""
    li = table(spark, sf_dir, "lineitem")
    level = F.struct("l_linenumber", F.round(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("bigint").alias("price"), F.col("l_quantity").cast("bigint").alias("quantity"))
    sides = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(level)).alias("s"))
    flat = F.flatten(F.transform("s", lambda x: F.array(x["price"], x["quantity"])))
    prices = F.transform("s", lambda x: x["price"])
    return sides.select("l_orderkey", flat.alias("levels"), F.array_min(prices).alias("lo"), F.array_max(prices).alias("hi")).withColumn("mid", (F.col("lo") + F.col("hi")) / F.lit(2.0))


def item_snapshot(spark: SparkSession, sf_dir: str, until_day: int) -> DataFrame:
    """Each user's attributes as of the start of a day of the month: last event type, price bucket and number of the last event."""
    e = table(spark, sf_dir, "events").filter(F.dayofmonth("ts") < until_day)
    last = lambda c: F.max_by(c, F.struct("ts", "event_id"))
    rows = e.groupBy("user_id").agg(last("event_type").alias("item_type"), last("value").alias("v"), F.max("event_id").alias("last_event"))
    return rows.select(
        F.concat(F.lit("item-"), F.col("user_id").cast("string")).alias("item_key"), "item_type", F.when(F.col("v") < 20, "low").otherwise("high").alias("rarity_color"), "last_event"
    )
