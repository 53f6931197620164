"""Every registered query: an operator of the package over the standard tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import depth, money
from ..functions import sql as sql_functions
from ..operators import anomaly, asof, bars, cdc, day_sketches, fx, identity, normalize, quality, range_join, scd2, variants
from ..schemas import CHANGE, OBSERVATION
from ..sources import bus, database, lake
from ..streaming import change_stream
from . import inputs, serving

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CUTS = (11, 21)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})


def _books(obs: DataFrame) -> DataFrame:
    return obs.filter("source_endpoint = 'orderbook'")


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.decode_envelopes(inputs.envelopes(inputs.observations(spark, sf_dir)))


@query
def observations_from_variants(spark, sf_dir):
    """The payloads landed as variants, read back and taken apart by paths."""
    path = lake.work_folder(spark, "variants")
    variants.land(variants.with_variants(_decoded(spark, sf_dir)), path)
    return variants.normalize_variants(variants.read(spark, path))


def _normalized(spark: SparkSession, sf_dir: str, endpoint: str) -> DataFrame:
    return normalize.normalize(_decoded(spark, sf_dir).filter(F.col("endpoint") == endpoint))


def _converted(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    return fx.converted_prices(inputs.observations(spark, sf_dir), inputs.currencies(spark), inputs.rates(spark, sf_dir, gaps), prior_date=gaps)


@query
def unified_observations(spark, sf_dir):
    """The payloads of all endpoints as observations, from one scan."""
    return normalize.normalize(_decoded(spark, sf_dir))


@query
def decode_envelopes(spark, sf_dir):
    return _decoded(spark, sf_dir).select("kafka_key", normalize.item_of_key(F.col("kafka_key")).alias("item"), "endpoint", "app_id", "request_currency", "observed_at")


@query
def normalize_search_render(spark, sf_dir):
    return _normalized(spark, sf_dir, "search_render")


@query
def normalize_priceoverview(spark, sf_dir):
    return _normalized(spark, sf_dir, "priceoverview")


@query
def normalize_orderbook(spark, sf_dir):
    return _normalized(spark, sf_dir, "orderbook")


@query
def parse_price(spark, sf_dir):
    rows = inputs.price_texts(inputs.observations(spark, sf_dir))
    named = rows.drop("thousands_sep", "decimal_sep").join(F.broadcast(inputs.currencies(spark)), F.col("currency") == F.col("currency_code"), "left")
    return named.select("app_id", "market_hash_name", "observed_at", "currency", money.parse_price(F.col("price_text"), F.col("thousands_sep"), F.col("decimal_sep")).alias("minor_units"))


@query
def prices_by_sql(spark, sf_dir):
    """The prices of two apps in a range of time, parsed and placed in their money domain by SQL functions, with named parameters."""
    tables = {"price_texts": inputs.price_texts(inputs.observations(spark, sf_dir)).drop("thousands_sep", "decimal_sep", "lowest_sell", "money_domain"), "currencies": inputs.currencies(spark)}
    text = """SELECT app_id, market_hash_name, observed_at, money_domain(currency, source_endpoint) AS money_domain, parse_price(price_text, thousands_sep, decimal_sep) AS minor_units
        FROM price_texts LEFT JOIN currencies ON currency = currency_code WHERE array_contains(:apps, app_id) AND observed_at BETWEEN CAST(:since AS TIMESTAMP_NTZ) AND CAST(:until AS TIMESTAMP_NTZ)"""
    return sql_functions.run(spark, text, tables, apps=F.array(F.lit(440), F.lit(570)), since="2024-01-05 00:00:00", until="2024-01-25 00:00:00")


@query
def books_by_sql(spark, sf_dir):
    """Order-book measures by SQL functions; the same figures as those of the column expressions."""
    bands = ", ".join(f"depth_within_pct(levels, mid, {pct / 100}D, '{side}') AS {side}_depth_{pct}" for side in ("buy", "sell") for pct in (1, 5, 10))
    text = f"SELECT l_orderkey, CAST(size(levels) div 2 AS INT) AS n_levels, hi - lo AS spread, spread_bps(hi, lo) AS spread_bps, {bands} FROM books"
    return _rounded(sql_functions.run(spark, text, {"books": inputs.compact_books(spark, sf_dir)}), "spread_bps")


@query
def parse_volume(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select("event_id", money.parse_volume(F.col("props")).alias("volume"))


@query
def item_attributes(spark, sf_dir):
    return normalize.item_attributes(_decoded(spark, sf_dir)).drop("group_id")


@query
def bucket_pairs_from_pages(spark, sf_dir):
    return identity.pairs_from_pages(inputs.table(spark, sf_dir, "pages"), "html", ["page_id"], identity.LINK_PATTERN, ("href", "label"))


@query
def bucket_pairs_of_items(spark, sf_dir):
    """Names and buckets of items in pages with escaped JSON, a page for each observation."""
    part = lambda key, value: F.concat(F.lit(key + r'\":\"'), value, F.lit(r'\"'))
    name = F.col("market_hash_name")
    html = F.concat(F.lit("<script> "), part("market_hash_name", name), F.lit(", "), part("market_bucket_id", F.regexp_replace(name, "item-", "b")), F.lit(" </script>"))
    pages = inputs.observations(spark, sf_dir).select("app_id", "observed_at", F.concat(html, F.lit(" "), html).alias("html"))
    return identity.pairs_from_pages(pages, "html", ["app_id", "observed_at"])


@query
def orderbook_snapshot(spark, sf_dir):
    return _rounded(normalize.orderbook_snapshots(_decoded(spark, sf_dir), _mapping(spark, sf_dir)), "spread_bps")


def _mapping(spark, sf_dir):
    """Buckets that commodities name, and buckets seen on pages, of all items; the latter aren't the ones that books are asked by."""
    commodities = identity.buckets_from_commodities(normalize.item_attributes(_decoded(spark, sf_dir)))
    seen = inputs.table(spark, sf_dir, "events").filter("event_id is not null and user_id is not null").select(
        F.element_at(F.array(*map(F.lit, inputs.APPS)), (F.col("user_id") % 5 + 1).cast("int")).alias("app_id"),
        F.concat(F.lit("item-"), F.col("user_id").cast("string")).alias("market_hash_name"),
        F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("market_bucket_id"),
        F.col("ts").alias("observed_at"),
    )
    return identity.item_bucket_map(commodities, seen)


@query
def item_bucket_map(spark, sf_dir):
    return _mapping(spark, sf_dir)


def _bucket_books(spark, sf_dir):
    books = _decoded(spark, sf_dir).filter("endpoint = 'orderbook'")
    return books.select("app_id", F.get_json_object("request_params", "$.market_bucket_id").alias("market_bucket_id"), "observed_at")


@query
def resolve_orderbook(spark, sf_dir):
    return identity.resolve(_bucket_books(spark, sf_dir), _mapping(spark, sf_dir))


@query
def unresolved_orderbook(spark, sf_dir):
    return identity.unresolved(_bucket_books(spark, sf_dir), _mapping(spark, sf_dir))


@query
def orderbook_measures(spark, sf_dir):
    rows = inputs.compact_books(spark, sf_dir)
    bands = {f"{side}_depth_{pct}": depth.depth_within_pct(F.col("levels"), F.col("mid"), pct / 100, side) for side in ("buy", "sell") for pct in (1, 5, 10)}
    out = rows.select(
        "l_orderkey",
        F.size(depth.level_pairs(F.col("levels"))).alias("n_levels"),
        depth.spread(F.col("hi"), F.col("lo")).alias("spread"),
        depth.spread_bps(F.col("hi"), F.col("lo")).alias("spread_bps"),
        *(c.alias(n) for n, c in bands.items()),
    )
    return _rounded(out, "spread_bps")


@query
def fx_converted_prices(spark, sf_dir):
    return _rounded(_converted(spark, sf_dir), "local_price", "rate_to_usd", "usd_equivalent")


@query
def fx_prior_date_rate(spark, sf_dir):
    return _rounded(_converted(spark, sf_dir, gaps=True), "local_price", "rate_to_usd", "usd_equivalent")


@query
def asof_usd_baseline(spark, sf_dir):
    c = _converted(spark, sf_dir)
    usd = c.filter("iso_code = 'USD'").select("app_id", "market_hash_name", F.col("observed_at").alias("at"), "usd_equivalent")
    other = c.filter("iso_code <> 'USD'").select("app_id", "market_hash_name", "observed_at", "iso_code")
    return _rounded(asof.asof_join(other, usd, ["app_id", "market_hash_name"], "observed_at", "at", slice_days=7), "r_usd_equivalent")


@query
def cross_currency_dislocation(spark, sf_dir):
    out = fx.dislocation(_converted(spark, sf_dir)).drop("local_price", "lowest_sell", "currency")
    return _rounded(out, "rate_to_usd", "usd_equivalent", "baseline_usd_price", "usd_gap", "pct_gap")


@query
def fx_day_average_join(spark, sf_dir):
    return _rounded(fx.day_average_gap(_converted(spark, sf_dir)), "avg_usd", "usd_baseline", "usd_gap", "pct_gap")


@query
def ohlc_daily(spark, sf_dir):
    return bars.daily_bars(inputs.observations(spark, sf_dir))


@query
def twap_spread(spark, sf_dir):
    obs = inputs.observations(spark, sf_dir)
    return _rounded(bars.twap(bars.with_spread(obs), bars.BAR, "observed_at", "spread", "twap_spread"), "twap_spread", places=4)


@query
def item_daily(spark, sf_dir):
    return _rounded(bars.item_daily(inputs.observations(spark, sf_dir)), "twap_spread", places=4)


@query
def rolling_7d_window(spark, sf_dir):
    daily = bars.daily_bars(inputs.observations(spark, sf_dir))
    return _rounded(bars.rolling_average(daily).select(*bars.BAR, "close_price", "rolling_avg_close"), "rolling_avg_close")


@query
def rolling_7d_subquery(spark, sf_dir):
    """The correlated form (7 days, not 8), kept as a baseline: the optimizer makes a nested loop of it."""
    daily = bars.daily_bars(inputs.observations(spark, sf_dir))
    out = spark.sql(
        """SELECT d.*, (SELECT avg(p.close_price) FROM {daily} p WHERE p.app_id = d.app_id AND p.market_hash_name = d.market_hash_name
             AND p.money_domain = d.money_domain AND p.observation_date <= d.observation_date AND p.observation_date > date_sub(d.observation_date, 7)) AS rolling_avg_close
           FROM {daily} d""",
        daily=daily.select(*bars.BAR, "close_price"),
    )
    return _rounded(out, "rolling_avg_close")


@query
def rolling_7d_range_join(spark, sf_dir):
    """The correlated form as a range join by bins of time: what it takes for ranges that no window frame expresses."""
    daily = bars.daily_bars(inputs.observations(spark, sf_dir)).select(*bars.BAR, "close_price")
    daily = daily.withColumn("_day", F.unix_date(F.col("observation_date").cast("date")))
    out = range_join.trailing_mean(daily, ["app_id", "market_hash_name", "money_domain"], "_day", "close_price", 7, "rolling_avg_close")
    return _rounded(out.drop("_day"), "rolling_avg_close")


@query
def rolling_7d_half_open(spark, sf_dir):
    """The window form of the correlated baseline."""
    daily = bars.daily_bars(inputs.observations(spark, sf_dir))
    return _rounded(bars.rolling_average(daily, closed=False).select(*bars.BAR, "close_price", "rolling_avg_close"), "rolling_avg_close")


@query
def latest_observation(spark, sf_dir):
    return bars.latest(inputs.observations(spark, sf_dir), ["app_id", "market_hash_name", "currency"], "observed_at", "source_endpoint", "lowest_sell")


@query
def latest_by_self_join(spark, sf_dir):
    return bars.latest_by_self_join(inputs.observations(spark, sf_dir), ["app_id", "market_hash_name", "currency"], "observed_at")


@query
def latest_by_null_safe_self_join(spark, sf_dir):
    return bars.latest_by_self_join(inputs.observations(spark, sf_dir), ["app_id", "market_hash_name", "currency"], "observed_at", null_safe=True)


@query
def change_events(spark, sf_dir):
    return _rounded(cdc.detect_changes(inputs.observations(spark, sf_dir)), "pct_change")


@query
def change_events_strict(spark, sf_dir):
    return _rounded(cdc.detect_changes(inputs.observations(spark, sf_dir), strict_domain=True), "pct_change")


@query
def cdc_compression(spark, sf_dir):
    obs = inputs.observations(spark, sf_dir)
    return _rounded(cdc.compression_report(obs, cdc.detect_changes(obs)), "ratio")


def _cuts(spark: SparkSession, obs: DataFrame, parts: int) -> tuple[list[int], int]:
    """Times that cut observations into parts of like size, and a number of item buckets by which a bucket has some thousand rows in each part."""
    at = F.unix_micros(F.col("observed_at").cast("timestamp"))
    cuts, rows = obs.agg(F.percentile_approx(at, [i / parts for i in range(1, parts)]), F.count(F.lit(1))).first()
    return cuts or [], max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows // (parts * 8_000))


@query
def change_events_stream(spark, sf_dir):
    """The stream over the same observations, which land in time order, some files for each stretch of time, and are read in as many micro-batches; state
    carries an item from one to the next."""
    folder = lake.work_folder(spark, "stream")
    obs = inputs.observations(spark, sf_dir)
    stretches, files = 4, max(2, spark.sparkContext.defaultParallelism)
    at = F.unix_micros(F.col("observed_at").cast("timestamp"))
    cuts, buckets = _cuts(spark, obs, stretches)
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        # Files of one stretch hold different items, so their order doesn't matter.
        part = obs.filter((at > low if low is not None else F.lit(True)) & (at <= high if high is not None else F.lit(True)))
        part.repartition(files, "app_id", "market_hash_name").write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/in")
    events = change_stream.detect_changes_stream(stream, buckets=buckets)
    done = events.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    done.awaitTermination()
    if done.exception():
        raise done.exception()
    return _rounded(spark.read.schema(events.schema).parquet(f"{folder}/out"), "pct_change")


@query
def change_events_bus(spark, sf_dir):
    """Observations published to a topic in three goes, followed as a stream, their change events sent to a second topic, which is read back."""
    folder = lake.work_folder(spark, "bus")
    obs = inputs.observations(spark, sf_dir)
    key = F.concat_ws(":", F.col("app_id").cast("string"), "market_hash_name")
    messages = obs.select(key.alias("key"), F.to_json(F.struct(*obs.columns), lake.JSON_TIMES).alias("value"), "observed_at")
    at = F.unix_micros(F.col("observed_at").cast("timestamp"))
    cuts, buckets = _cuts(spark, obs, 3)
    done = None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        bus.publish(messages.filter((at > low if low is not None else F.lit(True)) & (at <= high if high is not None else F.lit(True))), f"{folder}/observations")
        heard = bus.subscribe(spark, f"{folder}/observations").select(F.from_json("value", OBSERVATION, lake.JSON_TIMES).alias("o")).select("o.*")
        done = bus.send(lake.to_messages(change_stream.detect_changes_stream(heard, buckets=buckets)), f"{folder}/changes", f"{folder}/state", "changes", every=None)
        done.awaitTermination()
        if done.exception():
            raise done.exception()
    return _rounded(bus.replay(spark, f"{folder}/changes").select(F.from_json("value", CHANGE, lake.JSON_TIMES).alias("c")).select("c.*"), "pct_change")


def _days(spark, sf_dir):
    """The attributes of each user as of the end of every day with events."""
    e = inputs.table(spark, sf_dir, "events").filter("ts is not null and user_id is not null")
    order = F.struct("ts", "event_id")
    daily = e.groupBy("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("seen_at")).agg(F.max_by("event_type", order).alias("item_type"), F.max_by("value", order).alias("v"))
    return daily.select(F.concat(F.lit("item-"), F.col("user_id").cast("string")).alias("item_key"), "seen_at", "item_type", F.when(F.col("v") < 20, "low").otherwise("high").alias("rarity_color"))


@query
def scd2_history(spark, sf_dir):
    return scd2.with_current_flag(scd2.scd2_replay(_days(spark, sf_dir), ["item_key"], ["item_type", "rarity_color"], "seen_at"))


def _versions(spark, sf_dir):
    day = lambda d: F.lit(f"2024-01-{d:02d} 00:00:00").cast("timestamp_ntz")
    first = scd2.scd2_first(inputs.item_snapshot(spark, sf_dir, CUTS[0]), day(CUTS[0]))
    return scd2.scd2_merge(first, inputs.item_snapshot(spark, sf_dir, CUTS[1]), ["item_key"], ["item_type", "rarity_color"], day(CUTS[1]))


@query
def scd2_items(spark, sf_dir):
    return scd2.with_current_flag(_versions(spark, sf_dir))


@query
def current_items(spark, sf_dir):
    return scd2.with_current_flag(_versions(spark, sf_dir)).filter("is_current").select("item_key", "item_type", "rarity_color", "valid_from")


def _daily(spark, sf_dir):
    return bars.daily_bars(inputs.observations(spark, sf_dir))


@query
def anomaly_price_zscore(spark, sf_dir):
    return _rounded(anomaly.price_zscore(_daily(spark, sf_dir)), "severity", "score", "pct_move")


@query
def anomaly_spread_widening(spark, sf_dir):
    return _rounded(anomaly.spread_widening(_books(inputs.observations(spark, sf_dir))), "severity", "score", "spread_bps", "ewm_mean", places=4)


@query
def anomaly_volume_spike(spark, sf_dir):
    return _rounded(anomaly.volume_spike(bars.daily_bars(inputs.observations(spark, sf_dir, items=10))).drop("weekday"), "severity", "score")


@query
def anomaly_crossed_book(spark, sf_dir):
    return _rounded(anomaly.crossed_book(_books(inputs.observations(spark, sf_dir))), "severity", "score")


def _anomalies(spark, sf_dir):
    return anomaly.anomaly_mart(_daily(spark, sf_dir), _books(inputs.observations(spark, sf_dir)))


@query
def anomaly_mart(spark, sf_dir):
    return _rounded(_anomalies(spark, sf_dir), "severity", "score", places=4)


@query
def gate_bronze(spark, sf_dir):
    """Violations of the landing checks on decoded envelopes with some broken rows."""
    rows = _decoded(spark, sf_dir).withColumn("raw_payload_json", F.when(F.minute("observed_at") == 0, None).otherwise(F.col("raw_payload_json")))
    columns = ["endpoint", "app_id", "observed_at", "request_params", "raw_payload_json"]
    fresh = quality.stale(rows, "observed_at", "2024-02-02 00:00:00").select(F.lit("fresh").alias("check_name"), F.lit(1).cast("long").alias("n"))
    return quality.not_null(rows, columns).select(F.concat(F.lit("not_null:"), "column_name").alias("check_name"), F.col("n_null").alias("n")).unionByName(fresh)


@query
def check_not_null(spark, sf_dir):
    obs = inputs.observations(spark, sf_dir)
    return quality.not_null(obs, obs.columns)


@query
def check_accepted_values(spark, sf_dir):
    return quality.not_accepted(inputs.table(spark, sf_dir, "events"), "event_type", ["click", "signup", "purchase"])


@query
def check_duplicate_grain(spark, sf_dir):
    return quality.duplicate_grain(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_referential(spark, sf_dir):
    li = inputs.table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return quality.orphans(li, inputs.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'"), ["o_orderkey"])


@query
def check_plausibility(spark, sf_dir):
    return _rounded(quality.implausible(cdc.detect_changes(inputs.observations(spark, sf_dir))), "pct_change")


@query
def check_volume_monotonic(spark, sf_dir):
    rows = quality.volume_decreases(inputs.observations(spark, sf_dir), ["app_id", "market_hash_name", "money_domain"])
    return rows.select("app_id", "market_hash_name", "money_domain", "observed_at", "previous_volume", "volume")


@query
def check_zero_decimal(spark, sf_dir):
    """Prices in currencies without decimals that don't parse: every price divisible by 7 is printed as sold out."""
    rows = inputs.price_texts(inputs.observations(spark, sf_dir))
    text = F.when(F.col("lowest_sell") % 7 == 0, "sold out").otherwise(F.col("price_text"))
    bad = quality.unparsed_zero_decimal(rows.withColumn("lowest_sell", money.parse_price(text, F.col("thousands_sep"), F.col("decimal_sep"))))
    return bad.groupBy("currency").agg(F.count(F.lit(1)).alias("n"))


@query
def check_paths_agree(spark, sf_dir):
    """Differences between the window form and the correlated form: none."""
    naive = lake.replace_table(rolling_7d_subquery(spark, sf_dir), lake.work_folder(spark, "naive"))
    return quality.differences(rolling_7d_half_open(spark, sf_dir), naive).select("app_id", "market_hash_name", "side")


@query
def gap_by_currency(spark, sf_dir):
    # Figures and medians are made from one evaluation.
    gaps = lake.replace_table(fx.dislocation(_converted(spark, sf_dir)).select("iso_code", "pct_gap"), lake.work_folder(spark, "gaps"))
    return _rounded(serving.gap_by_currency(gaps), "mean_gap", "std_gap", "median_gap", "min_gap", "max_gap", places=4)


@query
def gap_sketches(spark, sf_dir):
    """Gaps of two weeks by currency, from the stored sketches of their days.  Estimates differ from run to run, so they are held against the exact figures: the distinct count within
    5 %, the median within 2 % of the ranks."""
    gaps = lake.replace_table(fx.dislocation(_converted(spark, sf_dir)), lake.work_folder(spark, "gaps"))
    stored = lake.replace_table(day_sketches.sketch_days(gaps, ["iso_code"], "observed_at", "pct_gap", ["app_id", "market_hash_name"]), lake.work_folder(spark, "sketches"))
    found = day_sketches.over_days(stored, ["iso_code"], "2024-01-05", "2024-01-18")
    inside = gaps.filter("pct_gap is not null and to_date(observed_at) between '2024-01-05' and '2024-01-18'").join(F.broadcast(found.select("iso_code", "q50")), "iso_code")
    exact = inside.groupBy("iso_code").agg(F.countDistinct("app_id", "market_hash_name").alias("items"), F.avg((F.col("pct_gap") < F.col("q50")).cast("double")).alias("under"), F.avg((F.col("pct_gap") <= F.col("q50")).cast("double")).alias("upto"))
    out = found.join(exact, "iso_code")
    close = (F.abs(F.col("distinct") - F.col("items")) <= 0.05 * F.col("items") + 1).alias("distinct_close")
    middle = ((F.col("under") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_close")
    return _rounded(out.select("iso_code", "n", F.col("mean").alias("mean_gap"), F.col("low").alias("min_gap"), F.col("high").alias("max_gap"), close, middle), "mean_gap", "min_gap", "max_gap", places=4)


@query
def gap_by_price_bucket(spark, sf_dir):
    return _rounded(serving.gap_by_price(fx.dislocation(_converted(spark, sf_dir))), "mean_abs_gap", places=4)


@query
def gap_headline(spark, sf_dir):
    return _rounded(serving.gap_headline(fx.dislocation(_converted(spark, sf_dir))), "avg_abs_gap", "max_abs_gap", places=4)


@query
def gap_series(spark, sf_dir):
    return _rounded(serving.gap_series(fx.dislocation(_converted(spark, sf_dir))), "pct_gap")


@query
def severity_series(spark, sf_dir):
    return _rounded(serving.severity_series(_anomalies(spark, sf_dir)), "severity", places=4)


@query
def anomaly_headline(spark, sf_dir):
    """Headline figures from the serving copy of two apps."""
    path = lake.work_folder(spark, "serving")
    lake.mirror(_anomalies(spark, sf_dir), path, "2024-02-01 00:00:00", app_ids=(440, 570))
    return _rounded(serving.anomaly_headline(lake.read_current(spark, path), ["price_zscore", "spread_widening", "volume_spike", "crossed_book"]), "max_severity", places=4)


@query
def anomaly_headline_jdbc(spark, sf_dir):
    """The same figures from a serving database: the one that ``tickforge.serving.url`` names, or, in local mode, Spark's own."""
    url = spark.conf.get("tickforge.serving.url", None)
    if not url:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("tickforge.serving.url must name a database that driver and executors reach")
        url = f"jdbc:derby:{lake.work_folder(spark, 'serving-db').removeprefix('file://')};create=true"
    database.mirror(_anomalies(spark, sf_dir), url, "mart_anomaly", "2024-02-01 00:00:00", app_ids=(440, 570))
    mart = database.read(spark, url, "mart_anomaly")
    return _rounded(serving.anomaly_headline(mart, ["price_zscore", "spread_widening", "volume_spike", "crossed_book"]), "max_severity", places=4)


@query
def top_moves(spark, sf_dir):
    return _rounded(serving.top_moves(cdc.detect_changes(inputs.observations(spark, sf_dir))), "pct_change")


@query
def anomaly_summary(spark, sf_dir):
    return _rounded(serving.anomaly_totals(_anomalies(spark, sf_dir)), "max_severity", places=4)


@query
def recent_anomalies(spark, sf_dir):
    rows = serving.window_of(_anomalies(spark, sf_dir), "observed_at", "2024-01-05 00:00:00", "2024-01-25 00:00:00", app_id=570)
    top = serving.recent(rows, "observed_at", ["market_hash_name", "anomaly_type", "severity"])
    return _rounded(top.drop("explanation"), "severity", "score", places=4)


@query
def recent_dislocations(spark, sf_dir):
    rows = serving.recent(fx.dislocation(_converted(spark, sf_dir)), "observed_at", ["app_id", "market_hash_name", "iso_code"])
    return _rounded(rows.select("app_id", "market_hash_name", "observed_at", "iso_code", "usd_gap", "pct_gap"), "usd_gap", "pct_gap")


@query
def param_app_ids(spark, sf_dir):
    return serving.parameter_values(inputs.observations(spark, sf_dir), "app_id")


@query
def currency_count(spark, sf_dir):
    return _converted(spark, sf_dir).agg(F.countDistinct("iso_code").alias("currencies"), F.countDistinct("app_id", "market_hash_name").alias("items"))


@query
def coverage_matrix(spark, sf_dir):
    obs = inputs.observations(spark, sf_dir).filter("source_endpoint = 'priceoverview'")
    items = inputs.observations(spark, sf_dir).select("app_id", "market_hash_name").distinct()
    codes = inputs.currencies(spark).filter("currency_code in (1, 3, 10, 13)").select(F.col("currency_code").alias("currency"))
    return identity.coverage_gaps(items, codes, obs.select("app_id", "market_hash_name", "currency").distinct())


@query
def bronze_roundtrip(spark, sf_dir):
    """Envelopes landed by partition and read back with pruning to one endpoint."""
    e = F.from_json("value", "source string, endpoint string, app_id int, currency int, observed_at string, request_params string, raw_payload string")
    rows = inputs.envelopes(inputs.observations(spark, sf_dir)).select(e.alias("e")).select("e.*").withColumn("ingest_id", F.sha2(F.concat("observed_at", "raw_payload"), 256))
    path = lake.work_folder(spark, "bronze")
    lake.write_bronze(rows, path)
    back = lake.endpoint_of(lake.read_bronze(spark, path), "priceoverview")
    return back.groupBy("dt", "hour", "app_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ingest_id").alias("ids"))


@query
def silver_roundtrip(spark, sf_dir):
    """Change events landed by a stream that takes what is there, and read back by their partitions."""
    path = lake.work_folder(spark, "silver")
    # Files that each hold a stretch of time, as they come in, so that a partition is written by few tasks.
    changes = cdc.detect_changes(inputs.observations(spark, sf_dir))
    changes.repartitionByRange("observed_at").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 4).parquet(f"{path}/in")
    landing = lake.land(stream, f"{path}/out", f"{path}/state", lake.SILVER_PARTITIONS, every=None)
    landing.awaitTermination()
    if landing.exception():
        raise landing.exception()
    return lake.read_silver(spark, f"{path}/out").groupBy("dt", "hour", "app_id", "field").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("market_hash_name").alias("items"))
