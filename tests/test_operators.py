import datetime
import json
import random
import statistics

import duckdb
import pytest
from pyspark.sql import functions as F

from tickforge.operators import anomaly, asof, bars, cdc, identity, normalize, quality, scd2
from tickforge.plans import inputs, pipeline, serving
from tickforge.schemas import OBSERVATION, WATCHED
from tickforge.sources import lake
from tickforge.streaming import change_stream

T0 = datetime.datetime(2024, 3, 1)


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


def obs(spark, rows):
    """rows: (item, minutes, sell, buy, listings, volume, currency, endpoint)"""
    full = [(730, i, at(m), s, b, n, v, c, e, f"currency:{c}" if c is not None else f"endpoint:{e}") for i, m, s, b, n, v, c, e in rows]
    return spark.createDataFrame(full, OBSERVATION)


def random_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for m in rng.sample(range(10 * n), n):
        e = rng.choice(["search_render", "priceoverview", "orderbook"])
        pick = lambda: rng.choice([None, *range(5)])
        out.append((f"i{rng.randrange(4)}", m, pick(), pick(), pick(), pick(), rng.choice([None, 1, 3]) if e != "orderbook" else 8, e))
    return out


def follow(rows, strict=False):
    """The rules, one row after another."""
    state, out = {}, []
    for i, m, *values, c, e in sorted(rows, key=lambda r: r[1]):
        domain = f"currency:{c}" if c is not None else f"endpoint:{e}"
        known, last = state.setdefault((i, domain) if strict else i, ({}, [None]))
        same = last[0] is None or last[0] == domain
        for f, v in zip(WATCHED, values, strict=True):
            if v is None:
                continue
            if same and f in known and known[f] != v:
                out.append((i, f, float(known[f]), float(v), at(m)))
            known[f] = v
        last[0] = domain
    return sorted(out)


def events(df):
    return sorted((r["market_hash_name"], r["field"], r["previous"], r["current"], r["observed_at"]) for r in df.collect())


@pytest.mark.parametrize("strict", [False, True])
def test_changes_follow_the_rules(spark, strict):
    rows = random_rows(300, 1)
    want = follow(rows, strict)
    assert len(want) > 20 and events(cdc.detect_changes(obs(spark, rows), strict_domain=strict)) == want


def run_stream(spark, tmp_path, df_parts, **options):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for k, part in enumerate(df_parts):
        part.coalesce(1).write.mode("append").parquet(f"{source}/{k:03d}")
        stream = spark.readStream.schema(part.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(source)
        q = change_stream.detect_changes_stream(stream, **options).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
    return spark.read.parquet(out)


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    rows = sorted(random_rows(120, 2), key=lambda r: r[1])
    parts = [obs(spark, rows[:50]), obs(spark, rows[50:90]), obs(spark, rows[90:])]
    got = run_stream(spark, tmp_path, parts)
    assert events(got) == follow(rows)
    nulls = got.filter("previous = 0 and pct_change is not null").count()
    assert nulls == 0


def test_late_rows(spark, tmp_path):
    first = [("a", 10, 100, None, None, None, 1, "priceoverview"), ("a", 20, 110, None, None, None, 1, "priceoverview")]
    late = [("a", 15, 105, None, None, None, 1, "priceoverview")]
    kept = run_stream(spark, tmp_path / "keep", [obs(spark, first), obs(spark, late)])
    assert [(e[2], e[3]) for e in events(kept)] == [(100.0, 110.0), (110.0, 105.0)]
    dropped = run_stream(spark, tmp_path / "drop", [obs(spark, first), obs(spark, late)], late="drop")
    assert [(e[2], e[3]) for e in events(dropped)] == [(100.0, 110.0)]


@pytest.mark.parametrize("slice_days", [None, 1])
def test_asof(spark, slice_days):
    rng = random.Random(4)
    left = [(rng.choice(["a", "b", None]), at(rng.randrange(9000)), i) for i in range(150)]
    right = [(rng.choice(["a", "b", None]), at(m), m) for m in rng.sample(range(3000, 9000), 40)]
    got = asof.asof_join(spark.createDataFrame(left, "k string, t timestamp_ntz, i int"), spark.createDataFrame(right, "k string, at timestamp_ntz, v int"), ["k"], "t", "at", slice_days=slice_days)
    assert got.columns == ["k", "t", "i", "r_at", "r_v"] and got.count() == len(left)
    for r in got.collect():
        before = [x for x in right if x[0] is not None and x[0] == r["k"] and x[1] <= r["t"]]
        assert r["r_v"] == (max(before, key=lambda x: x[1])[2] if before else None)


@pytest.mark.parametrize("slice_days", [None, 1])
def test_asof_within_a_table_equals_the_join_of_its_parts(spark, slice_days):
    rng = random.Random(8)
    rows = spark.createDataFrame([(rng.choice(["a", "b", None]), at(rng.randrange(9000)), rng.choice(["USD", "EUR", None]), float(i)) for i in range(250)], "k string, t timestamp_ntz, iso string, v double")
    one = asof.asof_within(rows, ["k"], "t", F.col("iso") == "USD", {"t": "at", "v": "usd"}, slice_days)
    usd = rows.filter("iso = 'USD'").select("k", F.col("t").alias("at"), F.col("v").alias("usd"))
    two = asof.asof_join(rows.filter("iso <> 'USD'"), usd, ["k"], "t", "at", prefix="")
    assert one.count() > 50 and sorted(map(str, one.collect())) == sorted(map(str, two.select(*one.columns).collect()))


def test_buckets_that_items_share(spark):
    schema = "app_id int, market_hash_name string, market_bucket_id string, observed_at timestamp_ntz"
    rows = [(1, "b", "x", at(0)), (1, "a", "x", at(1)), (1, "c", "y", at(2)), (1, "c", "z", at(3))]
    mapping = identity.item_bucket_map(spark.createDataFrame(rows, schema), spark.createDataFrame([], schema))
    assert sorted(tuple(r) for r in mapping.select("app_id", "market_hash_name", "market_bucket_id").collect()) == [(1, "a", "x"), (1, "b", "x"), (1, "c", "z")]
    assert [tuple(r) for r in identity.shared_buckets(mapping).collect()] == [(1, "x", 2, "a")]


def test_twap_and_bars_keep_domains_apart(spark):
    rows = [("a", 0, 110, 100, None, 1, 8, "orderbook"), ("a", 10, 130, 100, None, None, 8, "orderbook"), ("a", 40, 999, 100, None, 2, 8, "orderbook"), ("a", 20, 50, None, None, 7, 1, "priceoverview")]
    got = {r["money_domain"]: r for r in bars.item_daily(obs(spark, rows)).collect()}
    book = got["currency:8"]
    assert (book["open_price"], book["high_price"], book["low_price"], book["close_price"], book["total_volume"], book["observation_count"]) == (110, 999, 110, 999, 3, 3)
    assert book["twap_spread"] == pytest.approx((10 * 10 + 30 * 30) / 40)
    assert got["currency:1"]["twap_spread"] is None


def test_latest_forms(spark):
    rows = [("a", 0, 1, None, None, None, None, "search_render"), ("a", 5, 2, None, None, None, None, "search_render"), ("a", 3, 3, None, None, None, 1, "priceoverview")]
    keys = ["app_id", "market_hash_name", "currency"]
    df = obs(spark, rows)
    assert sorted(r["lowest_sell"] for r in bars.latest(df, keys, "observed_at").collect()) == [2, 3]
    assert [r["lowest_sell"] for r in bars.latest_by_self_join(df, keys, "observed_at").collect()] == [3]
    assert sorted(r["lowest_sell"] for r in bars.latest_by_self_join(df, keys, "observed_at", null_safe=True).collect()) == [2, 3]


def test_scd2(spark):
    cols = "k string, a string, b int"
    day = lambda d: F.lit(f"2024-01-{d:02d} 00:00:00").cast("timestamp_ntz")
    one = scd2.scd2_first(spark.createDataFrame([("x", "1", 1), ("y", None, 1), ("z", "1", 1)], cols), day(1))
    two = scd2.scd2_merge(one, spark.createDataFrame([("x", "2", 2), ("y", None, 9), ("n", "1", 1)], cols), ["k"], ["a"], day(2))
    three = scd2.scd2_merge(two, spark.createDataFrame([("x", "2", 5), ("y", "v", 9), ("n", "1", 1)], cols), ["k"], ["a"], day(3))
    got = sorted((r["k"], r["a"] or "", r["b"], r["valid_from"].day, r["valid_to"].day if r["valid_to"] else 0) for r in three.collect())
    assert got == [("n", "1", 1, 2, 0), ("x", "1", 1, 1, 2), ("x", "2", 2, 2, 0), ("y", "", 1, 1, 3), ("y", "v", 9, 3, 0), ("z", "1", 1, 1, 0)]


def daily(spark, values, column="close_price"):
    rows = [(1, "a", "currency:1", (T0 + datetime.timedelta(days=i)).date(), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"app_id int, market_hash_name string, money_domain string, observation_date date, {column} bigint")


def test_detectors(spark):
    calm = [1000, 1010, 1000, 1012, 1001, 1011, 1000, 1010]
    assert anomaly.price_zscore(daily(spark, calm)).count() == 0
    found = anomaly.price_zscore(daily(spark, [*calm, 3000])).collect()
    assert len(found) == 1 and found[0]["severity"] == 1.0 and found[0]["pct_move"] == pytest.approx(100 * (3000 / 1010 - 1))
    assert anomaly.price_zscore(daily(spark, [1000, 1010, 5000])).count() == 0
    assert anomaly.price_zscore(daily(spark, [0, 0, -5, 1, 2, 3, 0, 9])).count() == 0
    weeks = [100 if i % 7 else [50, 60, 55, 400][i // 7] for i in range(22)]
    assert [r["total_volume"] for r in anomaly.volume_spike(daily(spark, weeks, "total_volume")).collect()] == [400]
    books = obs(spark, [("a", m, 1000 + (m % 3), 990, None, None, 8, "orderbook") for m in range(30)] + [("a", 31, 1400, 990, None, None, 8, "orderbook")])
    wide = anomaly.spread_widening(books).collect()
    assert [r["observed_at"] for r in wide] == [at(31)]
    crossed = anomaly.crossed_book(obs(spark, [("a", 0, 100, 110, None, None, 8, "orderbook"), ("a", 1, 110, 100, None, None, 8, "orderbook"), ("a", 2, -5, 5, None, None, 8, "orderbook")])).collect()
    assert sorted(r["severity"] for r in crossed) == [0.5, pytest.approx(952.38 / 1000, abs=1e-4)]


def test_sentences_round_as_the_sql(spark):
    """Moves that end in a 5, where the last bit of the logarithm decides, and a spread that rounds to a zero with a sign."""
    says = lambda text, *values: duckdb.execute(f"SELECT printf({text})", values).fetchone()[0]
    books = obs(spark, [("a", m, 100 + (m % 3), 110, None, None, 8, "orderbook") for m in range(30)] + [("a", 31, 30000, 30001, None, None, 8, "orderbook")])
    for before, after in ((16, 101), (16, 107), (16, 145), (16, 347), (2000, 2521), (2000, 2557)):
        days = daily(spark, [before, before + 1] * 5 + [before, after]).withColumn("total_volume", F.lit(1).cast("bigint"))
        got = {r["anomaly_type"]: r["explanation"] for r in anomaly.anomaly_mart(days, books).filter("severity > 0").collect() if r["anomaly_type"] != "crossed_book"}
        want = says("'a moved up %.1f%%', round((exp(ln(? / CAST(? AS DOUBLE))) - 1) * 100, 1)", after, before)
        assert got["price_zscore"].partition(" (")[0] == want
        assert got["spread_widening"].partition(" bps")[0] == says("'a spread widened to %.0f', round(-1 / CAST(30000.5 AS DOUBLE) * 10000, 0)")


@pytest.mark.parametrize(("span", "n"), [(20, 1500), (500, 6000), (2, 80)])
def test_ewm_against_pandas(spark, span, n):
    """Over many blocks, with nulls, far from zero, and for spans in which old rows still weigh."""
    import numpy as np
    import pandas as pd

    rng = random.Random(span)
    values = [None if rng.random() < 0.05 else 5000 + rng.random() * 100 for _ in range(n)]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)] + [("other", i, 1.0) for i in range(12)], "k string, i int, v double")
    got = [r for r in anomaly.ewm_prior(df, ["k"], ["i"], "v", span=span).filter("k = 'k'").orderBy("i").collect()]
    e = pd.Series(values, dtype=float).ewm(span=span, min_periods=10, ignore_na=True)
    for r, m, d in zip(got, e.mean().shift(1), e.std().shift(1), strict=True):
        assert (r["ewm_mean"] is None) == bool(np.isnan(m))
        if not np.isnan(m):
            assert r["ewm_mean"] == pytest.approx(m) and r["ewm_std"] == pytest.approx(d, rel=1e-6)
    flat = anomaly.ewm_prior(df, ["k"], ["i"], "v", span=span).filter("k = 'other' and ewm_mean is not null").collect()
    assert len(flat) == 2 and all(r["ewm_std"] == 0 for r in flat)


def test_gates_fail_on_bad_data(spark):
    good = spark.createDataFrame([("api", "orderbook", 1, None, "2024-03-01T00:00:00", "{}", "{}", "x")], "source string, endpoint string, app_id int, currency int, observed_at string, request_params string, raw_payload string, ingest_id string")
    now = "2024-03-01 01:00:00"
    assert quality.run_gate(quality.bronze_checks(good, now)).success
    bad = {
        "columns_exist": good.drop("ingest_id"),
        "not_null": good.withColumn("raw_payload", F.lit(None).cast("string")),
        "fresh": good.withColumn("observed_at", F.lit("2024-02-01T00:00:00")),
    }
    for name, df in bad.items():
        with pytest.raises(quality.GateFailed, match=name):
            quality.run_gate(quality.bronze_checks(df, now))
    assert not quality.run_gate(quality.bronze_checks(good.limit(0), now), stop=False).success
    future = quality.stale(good.withColumn("observed_at", F.lit("2024-03-02 00:00:00").cast("timestamp_ntz")), "observed_at", now)
    assert future.count() == 1
    warn = quality.run_gate([quality.Check("w", "warn", good)])
    assert warn.success and warn.warned == ["w"]


def test_identity(spark):
    page = r'x market_hash_name\":\"A | 1\" .. market_bucket_id\":\"77\" y market_hash_name\\\":\\\"B\\\",\\\"market_bucket_id\\\":\\\"88\\\" "market_hash_name":"C","market_bucket_id":"99"'
    pages = spark.createDataFrame([(1, page), (2, None)], "app_id int, html string")
    got = identity.pairs_from_pages(pages, "html", ["app_id"]).collect()
    assert [(r["place"], r["market_hash_name"], r["market_bucket_id"]) for r in got] == [(0, "A | 1", "77"), (1, "B", "88")]
    com = spark.createDataFrame([(1, "A", "old", at(0)), (1, "A", "new", at(5))], "app_id int, market_hash_name string, market_bucket_id string, observed_at timestamp_ntz")
    seen = spark.createDataFrame([(1, "A", "page", at(0)), (1, "B", "first", at(1)), (1, "B", "later", at(9))], com.schema)
    assert sorted(tuple(r) for r in identity.item_bucket_map(com, seen).collect()) == [(1, "A", "new"), (1, "B", "first")]


def test_normalize_odd_payloads(spark):
    rows = [
        ("730:A:B", "priceoverview", {"success": True, "lowest_price": "$39.25", "volume": "1,105"}, 1),
        ("730:A", "search_render", {"results": [{"hash_name": None}, {"hash_name": "X", "sell_price": 167}]}, None),
        ("730:A", "search_render", {"results": []}, None),
        ("730:A", "orderbook", {"data": {"success": False, "data": {"amtMinSellOrder": 1}}}, None),
        ("730:A", "orderbook", {"data": {"success": True, "data": {"amtMinSellOrder": 26100, "amtMaxBuyOrder": 26000, "eCurrency": 8}}}, None),
        ("730:", "priceoverview", {"success": True, "lowest_price": "$1.00"}, 1),
        ("730:Z", "priceoverview", "not json", 1),
    ]
    messages = [(k, json.dumps({"endpoint": e, "app_id": 730, "currency": c, "observed_at": "2024-03-01T00:00:00", "raw_payload": p if isinstance(p, str) else json.dumps(p)})) for k, e, p, c in rows]
    messages.append(("730:Q", "broken"))
    got = normalize.normalize(normalize.decode_envelopes(spark.createDataFrame(messages, "key string, value string"))).collect()
    assert sorted((r["market_hash_name"], r["source_endpoint"], r["lowest_sell"], r["highest_buy"], r["volume"], r["money_domain"]) for r in got if r["market_hash_name"] != "Z") == [
        ("A", "orderbook", 26100, 26000, None, "currency:8"),
        ("A:B", "priceoverview", 3925, None, 1105, "currency:1"),
        ("X", "search_render", 167, None, None, "endpoint:search_render"),
    ]


def test_lake_and_pipeline(spark, tmp_path, sf_dir):
    df = inputs.observations(spark, sf_dir).filter("lowest_sell > 0")
    e = F.from_json("value", "source string, endpoint string, app_id int, currency int, observed_at string, request_params string, raw_payload string")
    raw = inputs.envelopes(df).select("key", e.alias("e")).select("e.*", F.sha2("key", 256).alias("ingest_id"), normalize.item_of_key(F.col("key")).alias("item"))
    bucket = F.get_json_object("request_params", "$.market_bucket_id").alias("market_bucket_id")
    raw = raw.withColumn("request_params", F.to_json(F.struct("item", bucket))).drop("item")
    lake.write_bronze(raw, f"{tmp_path}/bronze")
    assert lake.read_bronze(spark, f"{tmp_path}/bronze").count() == df.count()
    newest = raw.agg(F.max("observed_at")).first()[0].replace("T", " ")
    run = pipeline.run(spark, f"{tmp_path}/bronze", f"{tmp_path}/marts", newest, inputs.currencies(spark), inputs.rates(spark, sf_dir))
    assert {"observations", "changes", "item_daily", "dislocation", "anomalies", "orderbook_snapshot", "dim_item", "item_bucket_map"} <= set(run.tables)
    books = run.tables["orderbook_snapshot"]
    assert books.filter("resolved and buy_depth_10 > 0 and sell_depth_10 > 0").count() > 0 and books.filter("not resolved").count() > 0
    assert run.tables["anomalies"].filter("computed_at is null or explanation is null").count() == 0
    first = run.tables["dim_item"].count()
    again = pipeline._versions(spark, f"{tmp_path}/marts/versions/dim_item", run.tables["item_attributes"].withColumn("item_type", F.lit("new")), "2030-01-01 00:00:00")
    assert again.count() == 2 * first and again.filter("is_current").count() == first
    assert run.tables["changes"].count() > 0
    assert "synced_at" in lake.read_current(spark, f"{tmp_path}/marts/serving/changes").columns
    with pytest.raises(quality.GateFailed):
        pipeline.run(spark, f"{tmp_path}/bronze", f"{tmp_path}/again", "2030-01-01 00:00:00", inputs.currencies(spark), inputs.rates(spark, sf_dir))
    assert lake.published(spark, f"{tmp_path}/published") is None
    lake.publish_version(run.tables["changes"].limit(1), f"{tmp_path}/published")
    version = lake.publish_version(run.tables["changes"], f"{tmp_path}/published")
    assert version and lake.read_current(spark, f"{tmp_path}/published").count() == run.tables["changes"].count()
    assert lake.keep_versions(spark, f"{tmp_path}/published", keep=1) == 1 and lake.read_current(spark, f"{tmp_path}/published").count() == run.tables["changes"].count()
    assert json.loads(lake.to_messages(run.tables["changes"].withColumn("pct_change", F.lit(None).cast("double"))).first()["value"])["pct_change"] is None


def test_landing_stream(spark, tmp_path, sf_dir):
    inputs.envelopes(inputs.observations(spark, sf_dir)).write.json(f"{tmp_path}/bus")
    decoded = normalize.decode_envelopes(lake.read_message_files(spark, f"{tmp_path}/bus"))
    for _ in range(2):  # the second run finds nothing new
        lake.land(decoded, f"{tmp_path}/bronze", f"{tmp_path}/state", lake.BRONZE_PARTITIONS, every=None).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == inputs.observations(spark, sf_dir).count()


def test_plans(spark, sf_dir):
    """Filters reach the scan, no Python and no nested loops in the main paths."""
    from tickforge.plans.queries import QUERIES

    for name in ("ohlc_daily", "item_daily", "change_events", "cross_currency_dislocation", "anomaly_spread_widening", "orderbook_measures", "scd2_items", "parse_price"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan, name
        assert "props" not in plan or name not in ("scd2_items",), name
    plan = QUERIES["ohlc_daily"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_seeds_silver_and_missing_tables(spark, tmp_path, sf_dir):
    (tmp_path / "seed.csv").write_text("currency_code,iso_code,thousands_sep\n1,USD,\",\"\n18,UAH,\n")
    rows = lake.read_seed(spark, f"{tmp_path}/seed.csv", "currency_code int, iso_code string, thousands_sep string").orderBy("currency_code").collect()
    assert [tuple(r) for r in rows] == [(1, "USD", ","), (18, "UAH", None)]
    events = cdc.detect_changes(inputs.observations(spark, sf_dir))
    events.write.parquet(f"{tmp_path}/events")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/events")
    lake.land(stream, f"{tmp_path}/silver", f"{tmp_path}/state", lake.SILVER_PARTITIONS, every=None).awaitTermination()
    silver = lake.read_silver(spark, f"{tmp_path}/silver")
    assert silver.count() == events.count() > 0 and silver.filter("dt is null or hour is null").count() == 0
    spark.range(3).createOrReplaceTempView("mart_here")
    assert set(lake.existing_tables(spark, ["mart_here", "mart_gone"])) == {"mart_here"}
    spark.catalog.dropTempView("mart_here")


def test_streaming_bars(spark, tmp_path):
    """A day's bar is final once the watermark is past it; the day that is still open isn't written."""
    days = [obs(spark, [("a", 1440 * d + m, 100 + m, None, None, None, 1, "priceoverview") for m in (1, 500, 900)]) for d in range(3)]
    for k, part in enumerate(days):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(days[0].schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    bars_of = change_stream.streaming_bars(stream)
    q = bars_of.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r["observation_date"].day, r["open_price"], r["high_price"], r["low_price"], r["close_price"], r["observation_count"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, 101, 1000, 101, 1000, 3), (2, 101, 1000, 101, 1000, 3)]


def test_paths_that_disagree(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "app_id int, market_hash_name string")
    got = quality.differences(a, spark.createDataFrame([(1, "a"), (3, "c")], a.schema)).collect()
    assert sorted((r["app_id"], r["side"]) for r in got) == [(1, "left"), (2, "left"), (3, "right")]


def test_exact_median(spark):
    rng = random.Random(4)
    rows = [(k, round(rng.gauss(0, s), 6)) for k, s, n in (("a", 3, 501), ("b", 1e-6, 400), (None, 900, 7), ("d", 1, 1)) for _ in range(n)]
    rows += [("a", None), ("e", None), ("f", -0.0), ("f", 0.0), ("f", 5.0), ("g", -2.0), ("g", 7.0)] + [("h", 1.5)] * 300 + [("h", -80.0)] * 300
    want = {k: statistics.median(v for q, v in rows if q == k and v is not None) for k in {q for q, v in rows if v is not None}}
    got = {r["k"]: r["m"] for r in serving.exact_median(spark.createDataFrame(rows, "k string, v double"), "k", "v", "m").collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_replayed_versions_equal_repeated_merges(spark):
    rng = random.Random(11)
    days = [datetime.datetime(2024, 1, d) for d in range(1, 13)]
    pick = lambda xs: rng.choice(xs)
    rows = [(f"k{k}", d, pick(["a", "b", None]), pick([1, 2]), rng.randrange(9)) for k in range(9) for d in days if rng.random() < 0.7]
    rows += [(None, days[0], "a", 1, 0), (None, days[4], "b", 1, 0), ("late", None, "a", 1, 1)]
    schema = "k string, seen timestamp_ntz, a string, b int, other int"
    history = spark.createDataFrame(rows, schema)
    merged = None
    for d in days:
        today = spark.createDataFrame([r for r in rows if r[1] == d], schema).drop("seen")
        as_of = F.lit(d).cast("timestamp_ntz")
        merged = scd2.scd2_first(today, as_of) if merged is None else scd2.scd2_merge(merged, today, ["k"], ["a", "b"], as_of)
        merged = spark.createDataFrame(merged.collect(), merged.schema)  # what a run would have published
    flat = lambda df: sorted(map(str, (tuple(r[c] for c in ("k", "a", "b", "other", "valid_from", "valid_to")) for r in df.collect())))
    once = scd2.scd2_replay(history, ["k"], ["a", "b"], "seen")
    assert flat(once) == flat(merged) and once.filter("valid_to is not null").count() > 20
    half = scd2.scd2_replay(history.filter("seen < '2024-01-07'"), ["k"], ["a", "b"], "seen")
    both = scd2.scd2_continue(half, history.filter("seen >= '2024-01-07'"), ["k"], ["a", "b"], "seen")
    assert flat(both) == flat(merged)
    plan = scd2.scd2_replay(history, ["k"], ["a", "b"], "seen")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    again = history.unionByName(history)
    assert flat(scd2.scd2_replay(again, ["k"], ["a", "b"], "seen")) == flat(merged)
    assert scd2.scd2_replay(history.limit(0), ["k"], ["a", "b"], "seen").count() == 0
