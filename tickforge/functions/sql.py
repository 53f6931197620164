"""The money and order-book expressions as functions of SQL text, for queries that are written as such."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name -> (parameters, result, body).  The bodies say what ``money`` and ``depth`` say as columns; tests hold the two against each other.
FUNCTIONS = {
    "money_domain": ("currency INT, endpoint STRING", "STRING", "coalesce('currency:' || CAST(currency AS STRING), 'endpoint:' || endpoint)"),
    "parse_price": (
        "price STRING, thousands STRING, point STRING",
        "BIGINT",
        r"""CASE WHEN coalesce(point, '') = '' THEN try_cast(replace(regexp_replace(price, '[^0-9' || thousands || ']', ''), thousands, '') AS BIGINT) * 100
        ELSE CAST(round(try_cast(replace(replace(regexp_replace(price, '[^0-9' || thousands || point || ']', ''), thousands, ''), point, '.') AS DECIMAL(20, 4)) * 100) AS BIGINT) END""",
    ),
    "parse_volume": ("volume STRING", "BIGINT", "try_cast(regexp_replace(volume, '[^0-9]', '') AS BIGINT)"),
    "spread_bps": ("lowest_sell BIGINT, highest_buy BIGINT", "DOUBLE", "try_divide(CAST(lowest_sell - highest_buy AS DOUBLE), (lowest_sell + highest_buy) / 2.0D) * 10000"),
    "depth_within_pct": (
        "levels ARRAY<BIGINT>, mid DOUBLE, pct DOUBLE, side STRING",
        "BIGINT",
        """CASE WHEN size(levels) > 0 AND mid > 0 THEN aggregate(
          filter(transform(sequence(0, greatest(size(levels) - 2, 0), 2), i -> struct(get(levels, i) AS price, get(levels, i + 1) AS quantity)),
            p -> p.quantity IS NOT NULL AND CASE side WHEN 'buy' THEN p.price >= mid * (1 - pct) WHEN 'sell' THEN p.price <= mid * (1 + pct) ELSE CAST(raise_error('side must be buy or sell') AS BOOLEAN) END),
          0L, (total, p) -> total + p.quantity) END""",
    ),
}


def register(spark: SparkSession) -> None:
    """Make the functions known to this session."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")


def run(spark: SparkSession, text: str, tables: dict[str, DataFrame], **parameters) -> DataFrame:
    """A query over named tables, with the functions above and named parameters (``:name``), which are values and never become part of the text."""
    register(spark)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=parameters)
