"""DuckDB SQL with the results of the registered queries."""

from __future__ import annotations

from ..functions.money import CURRENCIES, RATES
from .inputs import APPS

_apps = "[" + ", ".join(map(str, APPS)) + "]"


def _obs(items: int | None = None, name: str = "obs") -> str:
    user = f"(user_id % {items})" if items else "user_id"
    return f"""{name}_0 AS (
  SELECT CAST({_apps}[{user} % 5 + 1] AS INTEGER) AS app_id, 'item-' || {user} AS market_hash_name, ts AS observed_at, CAST(round(value * 100) AS BIGINT) AS price,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, event_id,
    CASE WHEN event_type IN ('click', 'signup') THEN 'search_render' WHEN event_type = 'purchase' THEN 'priceoverview' ELSE 'orderbook' END AS source_endpoint
  FROM events WHERE event_id IS NOT NULL AND user_id IS NOT NULL),
{name}_1 AS (
  SELECT app_id, market_hash_name, observed_at, price AS lowest_sell, CASE WHEN source_endpoint = 'orderbook' THEN price + k - 60 END AS highest_buy,
    CASE WHEN source_endpoint <> 'priceoverview' THEN k END AS sell_listings, CASE WHEN source_endpoint = 'priceoverview' THEN k END AS volume,
    CAST(CASE source_endpoint WHEN 'priceoverview' THEN [1, 3, 13, 10][event_id % 4 + 1] WHEN 'orderbook' THEN 8 END AS INTEGER) AS currency, source_endpoint
  FROM {name}_0),
{name} AS (SELECT *, coalesce('currency:' || currency, 'endpoint:' || source_endpoint) AS money_domain FROM {name}_1)"""


OBS = _obs()
CUR = "cur(currency_code, iso_code, thousands_sep, decimal_sep) AS (VALUES " + ", ".join(f"({c}, '{i}', '{t}', '{d}')" for c, i, t, d in CURRENCIES) + ")"


def _rates(gaps: bool = False) -> str:
    days = "WHERE day(ts) % 3 = 0" if gaps else ""
    values = ", ".join(f"('{i}', CAST({r} AS DOUBLE))" for i, r in RATES)
    return f"""base(currency_iso, base) AS (VALUES {values}),
days AS (SELECT DISTINCT CAST(ts AS DATE) AS rate_date FROM events {days}),
rates AS (SELECT rate_date, currency_iso, base * (1.0 + day(rate_date) / CAST(1000.0 AS DOUBLE)) AS rate_to_usd FROM days, base)"""


def _converted(gaps: bool = False) -> str:
    rate = "ASOF JOIN rates r ON r.currency_iso = c.iso_code AND CAST(o.observed_at AS DATE) >= r.rate_date" if gaps else "JOIN rates r ON r.currency_iso = c.iso_code AND r.rate_date = CAST(o.observed_at AS DATE)"
    return f"""{OBS}, {CUR}, {_rates(gaps)},
converted AS (
  SELECT app_id, market_hash_name, observed_at, CAST(observed_at AS DATE) AS observation_date, currency, c.iso_code, lowest_sell, lowest_sell / CAST(100.0 AS DOUBLE) AS local_price,
    r.rate_to_usd, (lowest_sell / CAST(100.0 AS DOUBLE)) / r.rate_to_usd AS usd_equivalent
  FROM obs o JOIN cur c ON o.currency = c.currency_code {rate}
  WHERE source_endpoint = 'priceoverview' AND lowest_sell IS NOT NULL)"""


DISLOCATION = f"""{_converted()},
usd AS (SELECT app_id, market_hash_name, observed_at AS at, usd_equivalent AS usd_price FROM converted WHERE iso_code = 'USD'),
dislocation AS (
  SELECT n.*, u.at AS baseline_at, u.usd_price AS baseline_usd_price, n.usd_equivalent - u.usd_price AS usd_gap, (n.usd_equivalent - u.usd_price) / nullif(u.usd_price, 0) * 100 AS pct_gap
  FROM (SELECT * FROM converted WHERE iso_code <> 'USD') n ASOF LEFT JOIN usd u
  ON n.app_id = u.app_id AND n.market_hash_name = u.market_hash_name AND n.observed_at >= u.at)"""


def _bars(obs: str = "obs", name: str = "bars") -> str:
    order = "(observed_at, source_endpoint, lowest_sell)"
    return f"""{name} AS (
  SELECT app_id, market_hash_name, money_domain, CAST(observed_at AS DATE) AS observation_date,
    first(lowest_sell ORDER BY observed_at, source_endpoint, lowest_sell) AS open_price, max(lowest_sell) AS high_price, min(lowest_sell) AS low_price,
    last(lowest_sell ORDER BY observed_at, source_endpoint, lowest_sell) AS close_price, CAST(sum(coalesce(volume, 0)) AS BIGINT) AS total_volume, count(*) AS observation_count
  FROM {obs} WHERE lowest_sell IS NOT NULL GROUP BY ALL)"""


TWAP = """spaced AS (
  SELECT app_id, market_hash_name, money_domain, CAST(observed_at AS DATE) AS observation_date, lowest_sell - highest_buy AS spread, observed_at,
    lead(observed_at) OVER (PARTITION BY app_id, market_hash_name, money_domain, CAST(observed_at AS DATE) ORDER BY observed_at, lowest_sell - highest_buy) AS nxt
  FROM obs WHERE source_endpoint = 'orderbook' AND lowest_sell - highest_buy IS NOT NULL),
twap AS (
  SELECT app_id, market_hash_name, money_domain, observation_date, round(sum(spread * (epoch_us(nxt) - epoch_us(observed_at)) / 1e6) / nullif(sum((epoch_us(nxt) - epoch_us(observed_at)) / 1e6), 0), 4) AS twap_spread
  FROM spaced GROUP BY ALL)"""


def _changes(strict: bool = False) -> str:
    keys = "app_id, market_hash_name" + (", money_domain" if strict else "")
    fields = ("lowest_sell", "highest_buy", "sell_listings", "volume")
    order = "observed_at, source_endpoint, money_domain, " + ", ".join(fields)
    window = f"(PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    before = ", ".join(f"last_value({f} IGNORE NULLS) OVER {window} AS p_{f}" for f in fields)
    tall = " UNION ALL ".join(
        f"SELECT app_id, market_hash_name, '{f}' AS field, CAST(p_{f} AS DOUBLE) AS previous, CAST({f} AS DOUBLE) AS current, observed_at FROM marked WHERE p_domain = money_domain AND {f} <> p_{f}" for f in fields
    )
    return f"""marked AS (SELECT *, lag(money_domain) OVER (PARTITION BY {keys} ORDER BY {order}) AS p_domain, {before} FROM obs),
tall AS ({tall}),
changes AS (SELECT app_id, market_hash_name, field, previous, current, current - previous AS delta, round((current - previous) / nullif(previous, 0) * 100, 6) AS pct_change, observed_at FROM tall)"""


BPS = "(lowest_sell - highest_buy) / nullif((lowest_sell + highest_buy) / CAST(2.0 AS DOUBLE), 0) * 10000"


def _zscore(daily: str = "bars") -> str:
    return f"""ret AS (
  SELECT *, CASE WHEN close_price / CAST(nullif(lag(close_price) OVER w, 0) AS DOUBLE) > 0 THEN ln(close_price / CAST(nullif(lag(close_price) OVER w, 0) AS DOUBLE)) END AS r
  FROM {daily} WINDOW w AS (PARTITION BY app_id, market_hash_name, money_domain ORDER BY observation_date)),
zs AS (
  SELECT *, count(r) OVER p AS n, avg(r) OVER p AS m, stddev_samp(r) OVER p AS s FROM ret
  WINDOW p AS (PARTITION BY app_id, market_hash_name, money_domain ORDER BY observation_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
zscore AS (
  SELECT app_id, market_hash_name, 'price_zscore' AS anomaly_type, least(abs((r - m) / s) / 10, 1.0) AS severity, (r - m) / s AS score, CAST(observation_date AS TIMESTAMP) AS observed_at, money_domain,
    (exp(r) - 1) * 100 AS pct_move
  FROM zs WHERE n >= 5 AND s > 0 AND abs((r - m) / s) >= 3)"""


def _spike(daily: str) -> str:
    return f"""sp AS (
  SELECT *, count(*) OVER p AS n, avg(total_volume) OVER p AS m, stddev_samp(total_volume) OVER p AS s FROM {daily}
  WINDOW p AS (PARTITION BY app_id, market_hash_name, money_domain, isodow(observation_date) ORDER BY observation_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
spike AS (
  SELECT app_id, market_hash_name, 'volume_spike' AS anomaly_type, least(abs((total_volume - m) / s) / 10, 1.0) AS severity, (total_volume - m) / s AS score,
    CAST(observation_date AS TIMESTAMP) AS observed_at, money_domain, total_volume
  FROM sp WHERE n >= 3 AND s > 0 AND abs((total_volume - m) / s) >= 3)"""


WIDENING = f"""bk AS (
  SELECT app_id, market_hash_name, observed_at, {BPS} AS bps FROM obs WHERE source_endpoint = 'orderbook'),
nb AS (SELECT *, row_number() OVER (PARTITION BY app_id, market_hash_name ORDER BY observed_at, bps) AS i FROM bk WHERE bps IS NOT NULL),
pairs AS (
  SELECT a.app_id, a.market_hash_name, a.i, a.observed_at, a.bps, b.bps AS x, pow(19.0 / 21.0, a.i - 1 - b.i) AS w
  FROM nb a JOIN nb b ON a.app_id = b.app_id AND a.market_hash_name = b.market_hash_name AND b.i < a.i),
mu AS (
  SELECT app_id, market_hash_name, i, any_value(observed_at) AS observed_at, any_value(bps) AS bps, count(*) AS n, sum(w * x) / sum(w) AS m, sum(w) AS sw, sum(w * w) AS sq
  FROM pairs GROUP BY app_id, market_hash_name, i HAVING count(*) >= 10),
sd AS (
  SELECT mu.*, v.ss FROM mu JOIN (
    SELECT p.app_id, p.market_hash_name, p.i, sum(p.w * (p.x - mu.m) * (p.x - mu.m)) AS ss FROM pairs p JOIN mu USING (app_id, market_hash_name, i) GROUP BY ALL) v
  USING (app_id, market_hash_name, i)),
zw AS (SELECT *, sqrt(ss / sw * (sw * sw) / (sw * sw - sq)) AS s FROM sd),
widening AS (
  SELECT app_id, market_hash_name, 'spread_widening' AS anomaly_type, least((bps - m) / s / 10, 1.0) AS severity, (bps - m) / s AS score, observed_at, bps AS spread_bps, m AS ewm_mean
  FROM zw WHERE s > 0 AND (bps - m) / s >= 3)"""
CROSSED = f"""crossed AS (
  SELECT app_id, market_hash_name, 'crossed_book' AS anomaly_type, CASE WHEN {BPS} IS NULL THEN 0.5 ELSE least(abs({BPS}) / 1000, 1.0) END AS severity, {BPS} AS score, observed_at
  FROM obs WHERE source_endpoint = 'orderbook' AND highest_buy > lowest_sell)"""
COMMON = "app_id, market_hash_name, anomaly_type, severity, score, observed_at"
SAID = {
    "zscore": "printf('%s moved %s %.1f%% (%s), z %.1f', market_hash_name, CASE WHEN pct_move < 0 THEN 'down' ELSE 'up' END, round(abs(pct_move), 1), money_domain, round(score, 1))",
    "spike": "printf('%s volume %d is unusual for a %s (%s), z %.1f', market_hash_name, total_volume, dayname(observed_at), money_domain, round(score, 1))",
    "widening": "printf('%s spread widened to %.0f bps from about %.0f, z %.1f', market_hash_name, round(spread_bps, 0), round(ewm_mean, 0) + 0.0, round(score, 1))",
    "crossed": "printf('%s book is crossed by %.0f bps', market_hash_name, round(abs(score), 0))",
}
MART = f"""{OBS}, {_bars()}, {_zscore()}, {_spike('bars')}, {WIDENING}, {CROSSED},
mart AS ({' UNION ALL '.join(f'SELECT {COMMON}, {text} AS explanation FROM {name}' for name, text in SAID.items())})"""


def _books() -> str:
    bands = ", ".join(
        f"CAST(CASE WHEN len(levels) > 0 AND mid > 0 THEN coalesce(list_sum([x.q FOR x IN levels IF x.p {'>=' if s == 'buy' else '<='} mid * (1 {'-' if s == 'buy' else '+'} {p / 100})]), 0) END AS BIGINT) AS {s}_depth_{p}"
        for s in ("buy", "sell") for p in (1, 5, 10)
    )
    return f"""WITH l AS (
  SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT) AS p, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
s AS (SELECT l_orderkey, list({{'p': p, 'q': q}} ORDER BY l_linenumber, p, q) AS levels, min(p) AS lo, max(p) AS hi, (min(p) + max(p)) / CAST(2.0 AS DOUBLE) AS mid FROM l GROUP BY l_orderkey)
SELECT l_orderkey, CAST(len(levels) AS INTEGER) AS n_levels, hi - lo AS spread, round((hi - lo) / nullif((hi + lo) / CAST(2.0 AS DOUBLE), 0) * 10000, 6) AS spread_bps, {bands} FROM s"""


def _snapshot(name: str, day: int) -> str:
    return f"""{name} AS (
  SELECT 'item-' || user_id AS item_key, last(event_type ORDER BY ts, event_id) AS item_type, CASE WHEN last(value ORDER BY ts, event_id) < 20 THEN 'low' ELSE 'high' END AS rarity_color, max(event_id) AS last_event
  FROM events WHERE day(ts) < {day} GROUP BY user_id)"""


VERSIONS = f"""{_snapshot('a', 11)}, {_snapshot('b', 21)},
versions AS (
  SELECT a.*, TIMESTAMP '2024-01-11 00:00:00' AS valid_from, CASE WHEN b.item_key IS NOT NULL AND (a.item_type <> b.item_type OR a.rarity_color <> b.rarity_color) THEN TIMESTAMP '2024-01-21 00:00:00' END AS valid_to
  FROM a LEFT JOIN b USING (item_key)
  UNION ALL
  SELECT b.*, TIMESTAMP '2024-01-21 00:00:00', NULL FROM b LEFT JOIN a USING (item_key) WHERE a.item_key IS NULL OR a.item_type <> b.item_type OR a.rarity_color <> b.rarity_color)"""

HISTORY = """WITH days AS (
  SELECT 'item-' || user_id AS item_key, date_trunc('day', ts) AS seen_at, arg_max(event_type, (ts, event_id)) AS item_type, arg_max(value, (ts, event_id)) AS v
  FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY user_id, date_trunc('day', ts)),
h AS (SELECT item_key, CAST(seen_at AS TIMESTAMP) AS seen_at, item_type, CASE WHEN v < 20 THEN 'low' ELSE 'high' END AS rarity_color FROM days),
m AS (SELECT *, lag(item_type || '/' || rarity_color) OVER (PARTITION BY item_key ORDER BY seen_at) AS before FROM h),
o AS (SELECT item_key, item_type, rarity_color, seen_at AS valid_from, lead(seen_at) OVER (PARTITION BY item_key ORDER BY seen_at) AS valid_to FROM m WHERE before IS DISTINCT FROM item_type || '/' || rarity_color)
SELECT *, valid_to IS NULL AS is_current FROM o"""

MAPPING = f"""{OBS},
com AS (
  SELECT DISTINCT app_id, market_hash_name, replace(market_hash_name, 'item-', '') AS market_bucket_id FROM obs
  WHERE source_endpoint = 'search_render' AND CAST(replace(market_hash_name, 'item-', '') AS INTEGER) % 3 <> 0),
seen AS (SELECT DISTINCT CAST({_apps}[user_id % 5 + 1] AS INTEGER) AS app_id, 'item-' || user_id AS market_hash_name, 'p' || user_id AS market_bucket_id FROM events WHERE event_id IS NOT NULL AND user_id IS NOT NULL),
mapping AS (SELECT * FROM com UNION ALL SELECT * FROM seen ANTI JOIN com USING (app_id, market_hash_name))"""
BUCKET_BOOKS = "SELECT app_id, replace(market_hash_name, 'item-', '') AS market_bucket_id, observed_at FROM obs WHERE source_endpoint = 'orderbook'"

COLUMNS = "app_id, market_hash_name, observed_at, lowest_sell, highest_buy, sell_listings, volume, currency, source_endpoint, money_domain"


def _nulls(columns: tuple[str, ...], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_null FROM {source} WHERE {c} IS NULL HAVING count(*) > 0" for c in columns)


OBS_COLUMNS = tuple(COLUMNS.split(", "))


def _r(*names: str, places: int = 6) -> str:
    return ", ".join(f"round({n}, {places}) AS {n}" for n in names)


def _rolling(days: int) -> str:
    return f"""WITH {OBS}, {_bars()} SELECT app_id, market_hash_name, money_domain, observation_date, close_price,
  round(avg(close_price) OVER (PARTITION BY app_id, market_hash_name, money_domain ORDER BY observation_date RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND CURRENT ROW), 6) AS rolling_avg_close FROM bars"""


_SIDES = ", ".join(
    f"CAST(CASE WHEN mid > 0 THEN coalesce(list_sum([x.q FOR x IN {s} IF x.p {'>=' if s == 'buy' else '<='} mid * (1 {'-' if s == 'buy' else '+'} {p / 100})]), 0) END AS BIGINT) AS {s}_depth_{p}"
    for s in ("buy", "sell") for p in (1, 5, 10)
)

ORACLES: dict[str, str] = {
    "unified_observations": f"""WITH {OBS} SELECT {COLUMNS} FROM obs WHERE source_endpoint = 'search_render' UNION ALL SELECT {COLUMNS} FROM obs WHERE source_endpoint = 'orderbook' AND lowest_sell % 10 <> 0
        UNION ALL SELECT {COLUMNS.replace('lowest_sell', "CASE WHEN lowest_sell < 0 THEN NULL WHEN currency = 10 THEN lowest_sell // 100 * 100 ELSE lowest_sell END AS lowest_sell")} FROM obs WHERE source_endpoint = 'priceoverview'""",
    "bucket_pairs_of_items": f"""WITH {OBS} SELECT app_id, observed_at, CAST(place AS INTEGER) AS place, market_hash_name, replace(market_hash_name, 'item-', 'b') AS market_bucket_id
        FROM obs, range(2) t(place)""",
    "orderbook_snapshot": f"""WITH {MAPPING}, k AS (SELECT *, sell_listings AS n, (lowest_sell + highest_buy) / CAST(2.0 AS DOUBLE) AS mid, replace(market_hash_name, 'item-', '') AS market_bucket_id
          FROM obs WHERE source_endpoint = 'orderbook' AND lowest_sell % 10 <> 0),
        v AS (SELECT *, [{{'p': highest_buy, 'q': n}}, {{'p': highest_buy - 37, 'q': n + 1}}, {{'p': highest_buy - 74, 'q': n + 2}}] AS buy,
          [{{'p': lowest_sell, 'q': n}}, {{'p': lowest_sell + 37, 'q': n + 1}}, {{'p': lowest_sell + 74, 'q': n + 2}}] AS sell FROM k)
        SELECT v.app_id, v.market_hash_name, v.market_bucket_id, observed_at, lowest_sell, highest_buy, n + 1 AS buy_orders, n AS sell_orders, currency, lowest_sell - highest_buy AS spread,
          round((lowest_sell - highest_buy) / nullif(mid, 0) * 10000, 6) AS spread_bps, {_SIDES}, m.market_hash_name IS NOT NULL AS resolved
        FROM v LEFT JOIN mapping m ON m.app_id = v.app_id AND m.market_bucket_id = v.market_bucket_id""",
    "decode_envelopes": f"""WITH {OBS} SELECT app_id || ':' || market_hash_name AS kafka_key, market_hash_name AS item, source_endpoint AS endpoint, app_id,
        CASE WHEN source_endpoint = 'priceoverview' THEN currency END AS request_currency, observed_at FROM obs""",
    "normalize_search_render": f"WITH {OBS} SELECT {COLUMNS} FROM obs WHERE source_endpoint = 'search_render'",
    "normalize_priceoverview": f"""WITH {OBS} SELECT {COLUMNS.replace('lowest_sell', "CASE WHEN lowest_sell < 0 THEN NULL WHEN currency = 10 THEN lowest_sell // 100 * 100 ELSE lowest_sell END AS lowest_sell")}
        FROM obs WHERE source_endpoint = 'priceoverview'""",
    "normalize_orderbook": f"WITH {OBS} SELECT {COLUMNS} FROM obs WHERE source_endpoint = 'orderbook' AND lowest_sell % 10 <> 0",
    "parse_price": f"""WITH {OBS}, {CUR} SELECT app_id, market_hash_name, observed_at, currency, CASE WHEN decimal_sep = '' THEN lowest_sell // 100 * 100 ELSE lowest_sell END AS minor_units
        FROM obs JOIN cur ON currency = currency_code WHERE lowest_sell >= 0""",
    "parse_volume": "SELECT event_id, TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS BIGINT) AS volume FROM events",
    "item_attributes": f"""WITH {OBS} SELECT app_id, market_hash_name, observed_at, market_hash_name AS item_name, 't' || (lowest_sell % 3) AS item_type, 'c' || (lowest_sell % 2) AS rarity_color,
        CAST(CASE WHEN CAST(replace(market_hash_name, 'item-', '') AS BIGINT) % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS commodity FROM obs WHERE source_endpoint = 'search_render'""",
    "bucket_pairs_from_pages": """WITH p AS (SELECT page_id, regexp_extract_all(html, '(?s)<a href="([^"]*)">([^<]*)</a>', 1) AS a, regexp_extract_all(html, '(?s)<a href="([^"]*)">([^<]*)</a>', 2) AS b FROM pages)
        SELECT page_id, CAST(i - 1 AS INTEGER) AS place, a[i] AS href, b[i] AS label FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM p)""",
    "item_bucket_map": f"WITH {MAPPING} SELECT * FROM mapping",
    "resolve_orderbook": f"WITH {MAPPING} SELECT b.app_id, b.market_bucket_id, b.observed_at, m.market_hash_name FROM ({BUCKET_BOOKS}) b JOIN mapping m USING (app_id, market_bucket_id)",
    "unresolved_orderbook": f"WITH {MAPPING} SELECT b.* FROM ({BUCKET_BOOKS}) b ANTI JOIN mapping m USING (app_id, market_bucket_id)",
    "orderbook_measures": _books(),
    "fx_converted_prices": f"WITH {_converted()} SELECT * REPLACE ({_r('local_price', 'rate_to_usd', 'usd_equivalent')}) FROM converted",
    "fx_prior_date_rate": f"WITH {_converted(True)} SELECT * REPLACE ({_r('local_price', 'rate_to_usd', 'usd_equivalent')}) FROM converted",
    "asof_usd_baseline": f"WITH {DISLOCATION} SELECT app_id, market_hash_name, observed_at, iso_code, baseline_at AS r_at, round(baseline_usd_price, 6) AS r_usd_equivalent FROM dislocation",
    "cross_currency_dislocation": f"""WITH {DISLOCATION} SELECT * EXCLUDE (local_price, lowest_sell, currency) REPLACE ({_r('rate_to_usd', 'usd_equivalent', 'baseline_usd_price', 'usd_gap', 'pct_gap')}) FROM dislocation""",
    "fx_day_average_join": f"""WITH {_converted()}, d AS (SELECT app_id, market_hash_name, observation_date, iso_code, avg(usd_equivalent) AS avg_usd FROM converted GROUP BY ALL)
        SELECT n.app_id, n.market_hash_name, n.observation_date, n.iso_code, round(n.avg_usd, 6) AS avg_usd, round(u.avg_usd, 6) AS usd_baseline, round(n.avg_usd - u.avg_usd, 6) AS usd_gap,
          round((n.avg_usd - u.avg_usd) / nullif(u.avg_usd, 0) * 100, 6) AS pct_gap
        FROM d n JOIN d u ON n.app_id = u.app_id AND n.market_hash_name = u.market_hash_name AND n.observation_date = u.observation_date WHERE n.iso_code <> 'USD' AND u.iso_code = 'USD'""",
    "ohlc_daily": f"WITH {OBS}, {_bars()} SELECT * FROM bars",
    "twap_spread": f"WITH {OBS}, {TWAP} SELECT * FROM twap",
    "item_daily": f"WITH {OBS}, {_bars()}, {TWAP} SELECT * FROM bars LEFT JOIN twap USING (app_id, market_hash_name, money_domain, observation_date)",
    "rolling_7d_window": _rolling(7),
    "rolling_7d_subquery": _rolling(6),
    "rolling_7d_half_open": _rolling(6),
    "latest_observation": f"WITH {OBS} SELECT {COLUMNS} FROM obs QUALIFY row_number() OVER (PARTITION BY app_id, market_hash_name, currency ORDER BY observed_at DESC, source_endpoint DESC, lowest_sell DESC) = 1",
    "latest_by_self_join": f"""WITH {OBS}, m AS (SELECT app_id, market_hash_name, currency, max(observed_at) AS observed_at FROM obs GROUP BY ALL)
        SELECT {COLUMNS} FROM obs JOIN m USING (app_id, market_hash_name, currency, observed_at)""",
    "latest_by_null_safe_self_join": f"WITH {OBS} SELECT {COLUMNS} FROM obs QUALIFY observed_at = max(observed_at) OVER (PARTITION BY app_id, market_hash_name, currency)",
    "change_events": f"WITH {OBS}, {_changes()} SELECT * FROM changes",
    "change_events_strict": f"WITH {OBS}, {_changes(True)} SELECT * FROM changes",
    "change_events_stream": f"WITH {OBS}, {_changes()} SELECT * FROM changes",
    "change_events_bus": f"WITH {OBS}, {_changes()} SELECT * FROM changes",
    "scd2_history": HISTORY,
    "cdc_compression": f"""WITH {OBS}, {_changes()}, t AS (SELECT count(*) AS observations, count(DISTINCT (app_id, market_hash_name)) AS keys FROM obs),
        c AS (SELECT field, count(*) AS events FROM changes GROUP BY ROLLUP (field)) SELECT field, events, observations, keys, round(events / CAST(observations AS DOUBLE), 6) AS ratio FROM c, t""",
    "scd2_items": f"WITH {VERSIONS} SELECT *, valid_to IS NULL AS is_current FROM versions",
    "current_items": f"WITH {VERSIONS} SELECT item_key, item_type, rarity_color, valid_from FROM versions WHERE valid_to IS NULL",
    "anomaly_price_zscore": f"WITH {OBS}, {_bars()}, {_zscore()} SELECT * REPLACE ({_r('severity', 'score', 'pct_move')}) FROM zscore",
    "anomaly_spread_widening": f"WITH {OBS}, {WIDENING} SELECT * REPLACE ({_r('severity', 'score', 'spread_bps', 'ewm_mean', places=4)}) FROM widening",
    "anomaly_volume_spike": f"WITH {_obs(10)}, {_bars()}, {_spike('bars')} SELECT * REPLACE ({_r('severity', 'score')}) FROM spike",
    "anomaly_crossed_book": f"WITH {OBS}, {CROSSED} SELECT * REPLACE ({_r('severity', 'score')}) FROM crossed",
    "anomaly_mart": f"WITH {MART} SELECT * REPLACE ({_r('severity', 'score', places=4)}) FROM mart",
    "gate_bronze": f"""WITH {OBS} SELECT 'not_null:raw_payload_json' AS check_name, count(*) AS n FROM obs WHERE minute(observed_at) = 0 HAVING count(*) > 0
        UNION ALL SELECT 'fresh', CAST(1 AS BIGINT) FROM obs HAVING NOT coalesce(max(observed_at) BETWEEN TIMESTAMP '2024-01-31 23:00:00' AND TIMESTAMP '2024-02-02 00:00:00', false)""",
    "check_not_null": f"WITH {OBS} " + _nulls(OBS_COLUMNS, "obs"),
    "check_accepted_values": "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'signup', 'purchase') GROUP BY event_type",
    "check_duplicate_grain": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "check_referential": "SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY ALL",
    "check_plausibility": f"WITH {OBS}, {_changes()} SELECT * FROM changes WHERE field IN ('lowest_sell', 'highest_buy') AND abs(pct_change) > 50",
    "check_volume_monotonic": f"""WITH {OBS}, v AS (SELECT *, lag(volume) OVER (PARTITION BY app_id, market_hash_name, money_domain ORDER BY observed_at, volume) AS previous_volume FROM obs WHERE volume IS NOT NULL)
        SELECT app_id, market_hash_name, money_domain, observed_at, previous_volume, volume FROM v WHERE volume < previous_volume""",
    "check_zero_decimal": f"WITH {OBS} SELECT currency, count(*) AS n FROM obs WHERE currency IN (8, 10, 18) AND lowest_sell >= 0 AND lowest_sell % 7 = 0 GROUP BY currency",
    "check_paths_agree": "SELECT 0 AS app_id, '' AS market_hash_name, '' AS side WHERE false",
    "gap_by_currency": f"""WITH {DISLOCATION} SELECT iso_code, count(*) AS n, round(avg(pct_gap), 4) AS mean_gap, round(stddev_samp(pct_gap), 4) AS std_gap, round(median(pct_gap), 4) AS median_gap,
        round(min(pct_gap), 4) AS min_gap, round(max(pct_gap), 4) AS max_gap FROM dislocation WHERE pct_gap IS NOT NULL GROUP BY iso_code""",
    "gap_by_price_bucket": f"""WITH {DISLOCATION} SELECT CASE WHEN baseline_usd_price < 0.5 THEN 'a: under 0.50' WHEN baseline_usd_price < 2 THEN 'b: 0.50-2' WHEN baseline_usd_price < 10 THEN 'c: 2-10' ELSE 'd: over 10' END AS price_bucket,
        count(*) AS n, round(avg(abs(pct_gap)), 4) AS mean_abs_gap FROM dislocation WHERE pct_gap IS NOT NULL GROUP BY ALL""",
    "gap_headline": f"WITH {DISLOCATION} SELECT count(*) AS n, count(DISTINCT iso_code) AS currencies, round(avg(abs(pct_gap)), 4) AS avg_abs_gap, round(coalesce(max(abs(pct_gap)), 0), 4) AS max_abs_gap FROM dislocation",
    "gap_series": f"WITH {DISLOCATION} SELECT observed_at, market_hash_name || ' (' || iso_code || ')' AS series, round(pct_gap, 6) AS pct_gap FROM dislocation",
    "severity_series": f"WITH {MART} SELECT observed_at, anomaly_type AS series, round(severity, 4) AS severity FROM mart",
    "anomaly_headline": f"""WITH {MART}, copy AS (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS synced_at FROM mart WHERE app_id IN (440, 570))
        SELECT count(*) AS n, count(*) FILTER (anomaly_type = 'price_zscore') AS n_price_zscore, count(*) FILTER (anomaly_type = 'spread_widening') AS n_spread_widening,
        count(*) FILTER (anomaly_type = 'volume_spike') AS n_volume_spike, count(*) FILTER (anomaly_type = 'crossed_book') AS n_crossed_book,
        round(coalesce(max(severity), 0), 4) AS max_severity, max(synced_at) AS last_synced FROM copy""",
    "silver_roundtrip": f"""WITH {OBS}, {_changes()} SELECT strftime(observed_at, '%Y-%m-%d') AS dt, strftime(observed_at, '%H') AS hour, app_id, field, count(*) AS n, count(DISTINCT market_hash_name) AS items
        FROM changes GROUP BY 1, 2, 3, 4""",
    "top_moves": f"""WITH {OBS}, {_changes()} SELECT app_id, market_hash_name, field, previous, current, delta, pct_change, observed_at FROM changes WHERE field = 'lowest_sell' AND pct_change IS NOT NULL
        ORDER BY abs((current - previous) / previous * 100) DESC, app_id, market_hash_name, observed_at LIMIT 50""",
    "anomaly_summary": f"WITH {MART} SELECT anomaly_type, count(*) AS n, round(coalesce(max(severity), 0), 4) AS max_severity FROM mart GROUP BY ROLLUP (anomaly_type)",
    "recent_anomalies": f"""WITH {MART} SELECT * EXCLUDE (explanation) REPLACE ({_r('severity', 'score', places=4)}) FROM mart WHERE app_id = 570 AND observed_at BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'
        ORDER BY observed_at DESC, market_hash_name, anomaly_type, mart.severity LIMIT 200""",
    "recent_dislocations": f"""WITH {DISLOCATION} SELECT app_id, market_hash_name, observed_at, iso_code, round(usd_gap, 6) AS usd_gap, round(pct_gap, 6) AS pct_gap FROM dislocation
        ORDER BY observed_at DESC, app_id, market_hash_name, iso_code LIMIT 200""",
    "param_app_ids": f"WITH {OBS} SELECT DISTINCT app_id FROM obs",
    "currency_count": f"WITH {_converted()} SELECT count(DISTINCT iso_code) AS currencies, count(DISTINCT (app_id, market_hash_name)) AS items FROM converted",
    "coverage_matrix": f"""WITH {OBS}, i AS (SELECT DISTINCT app_id, market_hash_name FROM obs), c(currency) AS (VALUES (1), (3), (10), (13))
        SELECT i.*, c.currency FROM i, c WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.app_id = i.app_id AND o.market_hash_name = i.market_hash_name AND o.currency = c.currency AND source_endpoint = 'priceoverview')""",
    "bronze_roundtrip": f"""WITH {OBS} SELECT strftime(observed_at, '%Y-%m-%d') AS dt, strftime(observed_at, '%H') AS hour, app_id, count(*) AS n, count(*) AS ids FROM obs WHERE source_endpoint = 'priceoverview' GROUP BY ALL""",
}
ORACLES["anomaly_headline_jdbc"] = ORACLES["anomaly_headline"]
ORACLES["prices_by_sql"] = f"""WITH {OBS}, {CUR} SELECT app_id, market_hash_name, observed_at, 'currency:' || currency AS money_domain, CASE WHEN decimal_sep = '' THEN lowest_sell // 100 * 100 ELSE lowest_sell END AS minor_units
    FROM obs JOIN cur ON currency = currency_code WHERE lowest_sell >= 0 AND app_id IN (440, 570) AND observed_at BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'"""
ORACLES["books_by_sql"] = ORACLES["orderbook_measures"]
ORACLES["rolling_7d_range_join"] = ORACLES["rolling_7d_half_open"]
ORACLES["gap_sketches"] = f"""WITH {DISLOCATION} SELECT iso_code, count(*) AS n, round(avg(pct_gap), 4) AS mean_gap, round(min(pct_gap), 4) AS min_gap, round(max(pct_gap), 4) AS max_gap, true AS distinct_close, true AS median_close
    FROM dislocation WHERE pct_gap IS NOT NULL AND CAST(observed_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-18' GROUP BY iso_code"""
ORACLES["observations_from_variants"] = ORACLES["unified_observations"]
