import pytest
from pyspark.sql import functions as F

from tickforge.functions import depth, money, sql
from tickforge.functions.times import utc
from tickforge.plans import inputs

PRICES = [
    ("$7.05", 1, 705), ("£1,204.60", 2, 120460), ("1.080,15€", 3, 108015), ("CHF 0.90", 4, 90), ("12,07 руб.", 5, 1207), ("R$ 4,50", 7, 450), ("¥ 12,400", 8, 1240000),
    ("Rp 15 000", 10, 1500000), ("S$88.10", 13, 8810), ("96₴", 18, 9600), ("CDN$ 1,000.00", 20, 100000), ("¥ 0.03", 23, 3), ("₹ 64", 24, 6400), ("₹ 12,34,567.08", 24, 123456708),
    ("$5", 998, None), (None, 3, None), ("$5", None, None), ("sold out", 2, None), ("", 10, None), ("₹", 24, None),
]
LENIENT = [("¥ 1,999.50", 8, 199950, 19995000), ("Rp 10 020.75", 10, 1002075, 100207500), ("4 001,10₴", 18, 400110, 40011000), ("¥ 12,400", 8, 1240000, 1240000)]


def parsed(spark, rows, lenient=False):
    df = spark.createDataFrame([(i, t, c) for i, (t, c, *_) in enumerate(rows)], "i int, t string, c int")
    df = df.join(inputs.currencies(spark), F.col("c") == F.col("currency_code"), "left")
    got = df.select("i", money.parse_price(F.col("t"), F.col("thousands_sep"), F.col("decimal_sep"), lenient).alias("v")).orderBy("i").collect()
    return [r["v"] for r in got]


def test_prices(spark):
    assert parsed(spark, PRICES) == [p[2] for p in PRICES]
    df = spark.createDataFrame([(i, t, c) for i, (t, c, *_) in enumerate(PRICES + LENIENT)], "i int, t string, c int")
    text = "SELECT parse_price(t, thousands_sep, decimal_sep) AS v FROM d LEFT JOIN k ON c = currency_code ORDER BY i"
    assert [r["v"] for r in sql.run(spark, text, {"d": df, "k": inputs.currencies(spark)}).collect()] == [p[2] for p in PRICES] + [p[3] for p in LENIENT]
    assert parsed(spark, LENIENT) == [p[3] for p in LENIENT]
    assert parsed(spark, LENIENT, lenient=True) == [p[2] for p in LENIENT]


def test_volume_domain_and_gap(spark):
    df = spark.createDataFrame([("1,234", 1, "a"), ("none", None, "b"), (None, None, None)], "v string, c int, e string")
    got = df.select(money.parse_volume(F.col("v")), money.money_domain(F.col("c"), F.col("e"))).collect()
    assert [tuple(r) for r in got] == [(1234, "currency:1"), (None, "endpoint:b"), (None, None)]
    row = spark.range(1).select(*money.gap(F.lit(3.0), F.lit(2.0)), *money.gap(F.lit(3.0), F.lit(0.0)), *money.gap(F.lit(3.0), F.lit(None).cast("double"))).first()
    assert tuple(row) == (1.0, 50.0, 3.0, None, None, None)


@pytest.mark.parametrize(
    ("levels", "mid", "pct", "side", "want"),
    [([200, 4, 150, 6, 90, 1], 200, 0.25, "buy", 10), ([200, 4, 150, 6, 90, 1], 200, 0.1, "buy", 4), ([200, 4, 230, 6, 300, 1], 200, 0.25, "sell", 10), ([200, 4, 230, 6, 300, 1], 200, 0.1, "sell", 4),
     (None, 200, 0.2, "sell", None), ([], 200, 0.2, "sell", None), ([200, 4], None, 0.2, "buy", None), ([200, 4], 0, 0.2, "sell", None), ([90, 1], 200, 0.1, "buy", 0), ([200, 4, 190], 200, 0.2, "buy", 4)],
)
def test_depth(spark, levels, mid, pct, side, want):
    df = spark.createDataFrame([(levels, mid)], "l array<bigint>, m bigint")
    assert df.select(depth.depth_within_pct(F.col("l"), F.col("m"), pct, side)).first()[0] == want
    assert sql.run(spark, "SELECT depth_within_pct(l, m, :pct, :side) FROM d", {"d": df}, pct=pct, side=side).first()[0] == want


def test_spread(spark):
    df = spark.createDataFrame([(260, 240), (0, 0), (None, 5), (70, None)], "s bigint, b bigint")
    got = df.select(depth.spread(F.col("s"), F.col("b")), F.round(depth.spread_bps(F.col("s"), F.col("b")), 2)).collect()
    assert [tuple(r) for r in got] == [(20, 800.0), (0, None), (None, None), (None, None)]
    with pytest.raises(ValueError):
        depth.depth_within_pct(F.col("l"), F.col("m"), 0.1, "both")


def test_times_with_an_offset_are_instants(spark):
    texts = ["2024-01-01T00:00:00+03:00", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00.5", "2024-01-01", "2023-12-31T19:00:00.250-05:00", "noon", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = ["2023-12-31 21:00:00", "2024-01-01 00:00:00", "2024-01-01 00:00:00.500000", "2024-01-01 00:00:00", "2024-01-01 00:00:00.250000", "None", "None"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert [str(r["v"]) for r in df.select("i", utc(F.col("t")).alias("v")).orderBy("i").collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
