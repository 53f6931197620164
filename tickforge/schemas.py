"""Declared schemas; nothing is inferred from data."""

ENVELOPE = (
    "source string, endpoint string, app_id int, currency int, observed_at string, request_params string, raw_payload string, ingest_id string"
)
DECODED = "kafka_key string, endpoint string, app_id int, request_currency int, observed_at timestamp_ntz, request_params string, raw_payload_json string"
OBSERVATION = (
    "app_id int, market_hash_name string, observed_at timestamp_ntz, lowest_sell bigint, highest_buy bigint, sell_listings bigint, "
    "volume bigint, currency int, source_endpoint string, money_domain string"
)
CHANGE = (
    "app_id int, market_hash_name string, field string, previous double, current double, delta double, pct_change double, observed_at timestamp_ntz"
)
ANOMALY_COLUMNS = ("app_id", "market_hash_name", "anomaly_type", "severity", "explanation", "observed_at", "computed_at")

SEARCH_RENDER = (
    "success boolean, start int, pagesize int, total_count int, results array<struct<hash_name:string,sell_price:bigint,sell_listings:bigint,"
    "asset_description:struct<name:string,type:string,name_color:string,commodity:bigint,market_bucket_group_id:string>>>"
)
PRICE_OVERVIEW = "success boolean, lowest_price string, median_price string, volume string"
ORDER_BOOK = (
    "data struct<success:boolean,data:struct<amtMaxBuyOrder:bigint,amtMinSellOrder:bigint,eCurrency:int,cBuyOrders:bigint,cSellOrders:bigint,"
    "rgCompactBuyOrders:array<bigint>,rgCompactSellOrders:array<bigint>>>"
)
WATCHED = ("lowest_sell", "highest_buy", "sell_listings", "volume")
