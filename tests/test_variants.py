import json

from pyspark.sql import functions as F

from tickforge.operators import normalize, variants
from tickforge.plans import inputs
from tickforge.schemas import DECODED

T = "2024-03-01 00:00:00"


def decoded(spark, rows):
    """rows: (key, endpoint, currency, payload)"""
    full = [(k, e, 730, c, None, "{}", p if p is None or isinstance(p, str) else json.dumps(p)) for k, e, c, p in rows]
    return spark.createDataFrame(full, DECODED).withColumn("observed_at", F.lit(T).cast("timestamp_ntz"))


def test_variants_give_the_observations_of_text(spark, sf_dir, tmp_path):
    plain = normalize.decode_envelopes(inputs.envelopes(inputs.observations(spark, sf_dir)))
    variants.land(variants.with_variants(plain), f"{tmp_path}/bronze")
    got = variants.normalize_variants(variants.read(spark, f"{tmp_path}/bronze"))
    want = normalize.normalize(plain)
    assert got.columns == want.columns and want.count() > 100
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_drifting_types_and_broken_payloads(spark):
    book = lambda **x: {"data": {"success": True, "data": x}}
    rows = [
        ("730:a", "orderbook", None, book(amtMinSellOrder="120", amtMaxBuyOrder=100.0, cSellOrders=3, eCurrency=8, later={"x": 1})),
        ("730:b", "orderbook", None, book(amtMinSellOrder="soon", amtMaxBuyOrder=None, cSellOrders=[1], eCurrency="8")),
        ("730:c", "orderbook", None, {"data": {"success": "yes", "data": 5}}),
        ("730:d", "priceoverview", 1, {"success": True, "lowest_price": "$4.20", "volume": 1234}),
        ("730:e", "priceoverview", 1, "not json"),
        ("730:f", "search_render", None, {"results": [{"hash_name": "f", "sell_price": "77", "sell_listings": 2}, {"hash_name": ""}, 5, None]}),
        ("730:g", "search_render", None, {"results": "none"}),
        ("730:h", "orderbook", None, None),
    ]
    got = {r["market_hash_name"]: r for r in variants.normalize_variants(variants.with_variants(decoded(spark, rows))).collect()}
    assert set(got) == {"a", "b", "c", "d", "e", "f"}  # "yes" is read as true
    assert (got["a"]["lowest_sell"], got["a"]["highest_buy"], got["a"]["money_domain"]) == (120, 100, "currency:8")
    assert (got["b"]["lowest_sell"], got["b"]["highest_buy"], got["b"]["sell_listings"], got["b"]["currency"]) == (None, None, None, 8)
    assert (got["d"]["lowest_sell"], got["d"]["volume"]) == (420, 1234)
    assert got["e"]["lowest_sell"] is None and got["f"]["lowest_sell"] == 77


def test_unknown_fields_are_kept_and_reported(spark):
    rows = [("730:a", "priceoverview", 1, {"lowest_price": "$1", "later": {"x": 1}}), ("730:b", "priceoverview", 1, {"lowest_price": 3}), ("730:c", "orderbook", None, "oops")]
    held = variants.with_variants(decoded(spark, rows))
    assert held.select(variants.get(F.col("payload"), "later.x").alias("x")).filter("x = 1").count() == 1
    assert held.filter(variants.get(F.col("payload"), "unparsed", "string") == "oops").count() == 1
    fields = {r["endpoint"]: (r["n"], r["fields"]) for r in variants.payload_schemas(held).collect()}
    assert fields["priceoverview"][0] == 2 and "later" in fields["priceoverview"][1] and "lowest_price" in fields["priceoverview"][1]
