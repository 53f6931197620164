"""Order-book buckets and the items behind them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A name and a bucket id in JSON that stands escaped inside a page.
BUCKET_PATTERN = r'(?s)market_hash_name\\+":\\+"([^"\\]+)\\+".{0,600}?market_bucket_id\\+":\\+"([^"\\]+)\\+"'
LINK_PATTERN = r'(?s)<a href="([^"]*)">([^<]*)</a>'


def pairs_from_pages(pages: DataFrame, html: str, keep: Sequence[str], pattern: str = BUCKET_PATTERN, names: tuple[str, str] = ("market_hash_name", "market_bucket_id")) -> DataFrame:
    """Every pair that a two-group pattern finds in a page, with its place in the page."""
    groups = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("a"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("b"))
    return pages.select(*keep, F.posexplode(groups).alias("place", "p")).select(*keep, "place", F.col("p.a").alias(names[0]), F.col("p.b").alias(names[1]))


def buckets_from_commodities(attributes: DataFrame) -> DataFrame:
    """Commodities name their bucket themselves: the group id without a leading ``G``."""
    rows = attributes.filter((F.col("commodity") == 1) & (F.col("group_id") != "") & (F.col("market_hash_name") != ""))
    bucket = F.when(F.col("group_id").startswith("G"), F.substring(F.col("group_id"), F.lit(2), F.length("group_id"))).otherwise(F.col("group_id"))
    return rows.select("app_id", "market_hash_name", bucket.alias("market_bucket_id"), "observed_at")


def item_bucket_map(commodities: DataFrame, pages: DataFrame) -> DataFrame:
    """One bucket for each item: the latest that a commodity names, else the first that a page shows.

    ``pages``: ``app_id, market_hash_name, market_bucket_id, observed_at``.
    """
    both = commodities.withColumn("_p", F.lit(0)).unionByName(pages.select(*commodities.columns).withColumn("_p", F.lit(1)))
    time = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', observed_at)")
    # The least of (path, time, bucket) is found on the map side; no item's rows are sorted.
    order = F.struct("_p", F.when(F.col("_p") == 0, -time).otherwise(time), "market_bucket_id")
    return both.groupBy("app_id", "market_hash_name").agg(F.min_by("market_bucket_id", order).alias("market_bucket_id"))


def shared_buckets(mapping: DataFrame) -> DataFrame:
    """Buckets that several items claim, with how many and the first by name, the one that order books are given to."""
    return mapping.groupBy("app_id", "market_bucket_id").agg(F.countDistinct("market_hash_name").alias("items"), F.min("market_hash_name").alias("first_item")).filter("items > 1")


def resolve(books: DataFrame, mapping: DataFrame) -> DataFrame:
    """Books with the item of their bucket; books of unknown buckets are left out (see ``unresolved``)."""
    return books.join(mapping.withColumn("app_id", F.col("app_id").try_cast("int")), ["app_id", "market_bucket_id"])


def unresolved(books: DataFrame, mapping: DataFrame) -> DataFrame:
    return books.join(mapping, ["app_id", "market_bucket_id"], "left_anti")


def coverage_gaps(items: DataFrame, currencies: DataFrame, seen: DataFrame) -> DataFrame:
    """Pairs of a watched item and a currency without an observation.  Both inputs are short lists; their product is the report."""
    return items.crossJoin(F.broadcast(currencies)).join(seen, [*items.columns, *currencies.columns], "left_anti")
