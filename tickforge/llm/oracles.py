"""DuckDB SQL for the operators that SQL can express: the plain definition of each, over the same tables."""

from __future__ import annotations

from . import mixing
from .license_oracle import license_sql
from .oracles_text import PERIODIC_RUNS, SPELLING
from .url_filter import RULES as URL_RULES

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _low(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{SMALL}')"


NEAR_DUP = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_low('text')}, '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(id, other) AS (SELECT DISTINCT x, x FROM e UNION SELECT r.id, e.y FROM r JOIN e ON r.other = e.x),
m AS (SELECT id, min(other) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id, coalesce(m.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.id = d.doc_id"""

#: The method's parameters: width of buckets, reach of fences, weight of a language.
_gamma, _reach, _prior = 1.01, 3, 20
_shares = {
    "symbol_share": ("n_symbols", "greatest(word_chars, 1)"),
    "dup_line_share": ("n_dup_lines", "greatest(n_words / 8.0, n_dup_lines, 1)"),
    "repeat_share": ("n_repeat_words", "greatest(n_words, 1)"),
    "word_length": ("word_chars", "greatest(n_words, 1)"),
}
_half = lambda m: 0 if m == "word_length" else 0.5
_tall = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, '{m}' AS measure, CAST({c} AS DOUBLE) / {n} AS v, (CAST({c} AS DOUBLE) + {_half(m)}) / ({n} + {_half(m)}) AS seen FROM x" for m, (c, n) in _shares.items()
)


QUALITY = rf"""WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '{WORD}')) AS lines FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
a AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM a, range(8) t(j) GROUP BY doc_id),
x AS (SELECT d.doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda s: length(s))), 0) AS BIGINT) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM d LEFT JOIN r USING (doc_id)),
t AS ({_tall}),
k AS (SELECT *, CAST(ceil(ln(seen) / ln({_gamma})) AS INTEGER) AS bucket FROM t WHERE seen > 0),
lw AS (SELECT lang, measure, bucket, count(*) AS n FROM k GROUP BY ALL),
lt AS (SELECT lang, measure, sum(n) AS total FROM lw GROUP BY ALL),
s AS (SELECT lang, source, measure, bucket, count(*) AS n FROM k GROUP BY ALL),
w AS (SELECT s.lang, source, s.measure, bucket, n * total AS weight FROM s JOIN lt ON s.lang IS NOT DISTINCT FROM lt.lang AND s.measure = lt.measure
  UNION ALL SELECT s.lang, source, s.measure, lw.bucket, {_prior} * lw.n FROM (SELECT DISTINCT lang, source, measure FROM s) s JOIN lw ON s.lang IS NOT DISTINCT FROM lw.lang AND s.measure = lw.measure),
u AS (SELECT lang, source, measure, bucket, sum(sum(weight)) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto, sum(sum(weight)) OVER (PARTITION BY lang, source, measure) AS whole FROM w GROUP BY lang, source, measure, bucket),
q AS (SELECT lang, source, measure, min(bucket) FILTER (4 * upto >= whole) AS q25, min(bucket) FILTER (4 * upto >= 3 * whole) AS q75 FROM u GROUP BY lang, source, measure),
bad AS (SELECT DISTINCT doc_id FROM (SELECT *, CAST(ceil(ln(v) / ln({_gamma})) AS INTEGER) AS b FROM t WHERE v > 0) t JOIN q ON t.lang IS NOT DISTINCT FROM q.lang AND t.source IS NOT DISTINCT FROM q.source AND t.measure = q.measure
  WHERE b > q75 + {_reach} * (q75 - q25) OR t.measure = 'word_length' AND b < q25 - {_reach} * (q75 - q25))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM x"""

_weights = ", ".join(f"{w}.0" for w in mixing.WEIGHTS)
_ramps = ", ".join(map(str, mixing.RAMPS))
_use = "CASE WHEN ramp = 0 THEN u ELSE 2 * u / (1 - ramp + sqrt(greatest((1 - ramp) * (1 - ramp) + 4 * ramp * u, 0))) END"
MIXING = rf"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS ord FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
s1 AS (SELECT *, CAST([{_weights}][place % {len(mixing.WEIGHTS)} + 1] AS DOUBLE) AS weight, source_size * CAST({mixing.MOST} AS DOUBLE) AS cap, CAST([{_ramps}][place % {len(mixing.RAMPS)} + 1] AS DOUBLE) AS ramp FROM s0),
s2 AS (SELECT *, cap / weight AS level, (sum(source_size) OVER () * CAST({mixing.SHARE} AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS water FROM s1),
s3 AS (SELECT *, (SELECT first(water ORDER BY level, place) FROM s2 WHERE water < level) AS final FROM s2),
s AS (SELECT source, source_size, ramp, coalesce(least(cap, final * weight), cap) AS target FROM s3),
p AS (SELECT d.doc_id, size, source_size, target, ramp, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CAST(floor(target + 0.5) AS BIGINT) AS want FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
q AS (SELECT *, CASE WHEN source_size > 0 THEN want // source_size ELSE 0 END AS passes FROM p),
x AS (SELECT *, greatest(0, least(size, want - passes * source_size - before)) AS extra FROM q),
y AS (SELECT *, CAST(passes * size + extra AS BIGINT) AS taken, CASE WHEN extra > 0 THEN passes ELSE passes - 1 END AS last_pass FROM x)
SELECT doc_id, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN (SELECT {_use} FROM (SELECT least(CAST(before AS DOUBLE) / greatest(target, 1), 1) AS u)) END AS position,
  CASE WHEN taken > 0 THEN (SELECT {_use} FROM (SELECT least(CAST(last_pass * source_size + before AS DOUBLE) / greatest(target, 1), 1) AS u)) END AS last_position
FROM y"""

DECONTAMINATION = rf"""WITH d AS (SELECT doc_id, regexp_extract_all({_low('text')}, '{ALNUM}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_low('text')}, '{ALNUM}') AS w FROM benchmark),
i AS (SELECT DISTINCT item, k, array_to_string(w[a:a + k - 1], ' ') AS g FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS a FROM b WHERE len(w) > 0)),
z AS (SELECT DISTINCT k FROM i),
v AS (SELECT doc_id, k, a, array_to_string(w[a:a + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS a FROM d JOIN z ON len(w) >= k)),
m AS (SELECT v.doc_id, v.k, v.a, i.item FROM v JOIN i ON v.k = i.k AND v.g = i.g),
h AS (SELECT doc_id, count(DISTINCT a + o) AS n FROM m, range(10) t(o) WHERE o < k GROUP BY doc_id),
n AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM m GROUP BY doc_id),
-- Near matches: at least 8 of 10 terms within 10 words of their place. A window has its terms with how often the documents hold each.
t AS (SELECT doc_id, w[i] AS term, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
y AS (SELECT DISTINCT item, k, w[a:a + k - 1] AS g FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS a FROM b WHERE len(w) > 0)),
y1 AS (SELECT row_number() OVER () AS win, k, g, list(DISTINCT item) AS items FROM y GROUP BY k, g),
y2 AS (SELECT win, k, g[j] AS term, j, row_number() OVER (PARTITION BY win ORDER BY coalesce(df, 0), j) AS rare FROM (SELECT *, unnest(range(1, k + 1)) AS j FROM y1) x LEFT JOIN f ON f.term = x.g[x.j]),
c AS (SELECT DISTINCT doc_id, win, k, i - j AS s FROM y2 JOIN t USING (term) WHERE rare <= k - (k * 8 + 9) // 10 + 1),
q AS (SELECT doc_id, term, list(i) AS places FROM t WHERE term IN (SELECT term FROM y2) GROUP BY doc_id, term),
c1 AS (SELECT c.doc_id, c.win, c.k, c.s FROM c JOIN y2 USING (win) JOIN q ON q.doc_id = c.doc_id AND q.term = y2.term AND len(list_filter(places, lambda x: abs(x - s - j) <= 10)) > 0
  WHERE rare <= least(c.k, 2 * (c.k - (c.k * 8 + 9) // 10 + 1)) GROUP BY ALL HAVING count(*) >= least(c.k, 2 * (c.k - (c.k * 8 + 9) // 10 + 1)) - (c.k - (c.k * 8 + 9) // 10)),
c2 AS (SELECT c1.doc_id, c1.win, c1.k, c1.s FROM c1 JOIN y2 USING (win) JOIN q ON q.doc_id = c1.doc_id AND q.term = y2.term AND len(list_filter(places, lambda x: abs(x - s - j) <= 10)) > 0
  GROUP BY ALL HAVING count(*) >= (c1.k * 8 + 9) // 10),
e AS (SELECT doc_id, count(DISTINCT item) AS n FROM (SELECT doc_id, unnest(items) AS item FROM (SELECT DISTINCT doc_id, win FROM c2) JOIN y1 USING (win)) x ANTI JOIN (SELECT DISTINCT doc_id, item FROM m) USING (doc_id, item) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(len(items), 0) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated, coalesce(e.n, 0) AS n_near_items
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN e USING (doc_id)"""

_fit = {h + p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for h, p, _ in URL_RULES}
_longest = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
_rule = "CASE " + " ".join(f"WHEN {_fit[h + p]} THEN '{h + p}'" for h, p, _ in _longest) + " END"
_said = "CASE rule " + " ".join(f"WHEN '{h + p}' THEN '{v}'" for h, p, v in _longest) + " END"
_parts = rf"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{SMALL}') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path"


def _node(url: str) -> str:
    part = lambda i: rf"regexp_extract({url}, '(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^#]*)', {i})"
    host = f"translate({part(2)}, '{UPPER}', '{SMALL}')"
    host = f"CASE lower({part(1)}) WHEN 'http' THEN regexp_replace({host}, ':(80)?$', '') WHEN 'https' THEN regexp_replace({host}, ':(443)?$', '') ELSE {host} END"
    return rf"CASE WHEN {part(1)} = '' THEN regexp_replace({url}, '(?s)#.*$', '') ELSE lower({part(1)}) || '://' || {host} || CASE WHEN starts_with({part(3)}, '/') THEN '' ELSE '/' END || {part(3)} END"


URLS = rf"""WITH RECURSIVE h AS (
  SELECT url AS u, regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0) AS tag,
    regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0) AS meta FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
t AS (SELECT u, replace(replace(replace(v, '&#38;', '&'), '&#x26;', '&'), '&amp;', '&') AS v, regexp_extract(u, '(?s)^([^:/?#]+://[^/?#]*)([^?#]*)', 1) AS site, regexp_extract(u, '(?s)^([^:/?#]+://[^/?#]*)([^?#]*)', 2) AS path FROM (
  SELECT u, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS v FROM h UNION ALL SELECT u, regexp_extract(meta, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) FROM h)),
l AS (SELECT u, CASE WHEN regexp_matches(v, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN v WHEN regexp_matches(v, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(v, '//') THEN regexp_extract(site, '^[^:]+:') || v WHEN starts_with(v, '/') THEN site || v WHEN starts_with(v, '?') THEN site || path || v WHEN starts_with(v, '#') THEN u
    ELSE site || coalesce(nullif(regexp_extract(path, '(?s)^.*/'), ''), '/') || regexp_replace(v, '^([.]/)+', '') END AS v FROM t WHERE v <> '' AND site <> ''),
n AS (SELECT {_node('u')} AS u, {_node('v')} AS v FROM l WHERE v IS NOT NULL),
e AS (SELECT u AS x, v AS y FROM n WHERE u <> v UNION SELECT v, u FROM n WHERE u <> v),
r(id, other) AS (SELECT DISTINCT x, x FROM e UNION SELECT r.id, e.y FROM r JOIN e ON r.other = e.x),
w AS (SELECT {_node('url')} AS node, url FROM (SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT v FROM l WHERE v IS NOT NULL) a(url)),
o AS (SELECT id, {_said} AS said FROM (SELECT *, {_rule} AS rule FROM (SELECT id, {_parts} FROM r JOIN w ON r.other = w.node))),
alias AS (SELECT id FROM o GROUP BY id HAVING count(*) FILTER (said = 'block') > 0 AND count(*) FILTER (said = 'allow') = 0),
p AS (SELECT *, {_rule} AS rule FROM (SELECT page_id, {_node('url')} AS node, {_parts} FROM pages))
SELECT page_id, host, path, rule, coalesce({_said}, CASE WHEN node IN (SELECT id FROM alias) THEN 'block' ELSE 'allow' END) AS verdict FROM p"""


ORACLES: dict[str, str] = {
    "op4_near_dup": NEAR_DUP,
    "op5_quality_rules": QUALITY,
    "op6_mixing": MIXING,
    "op8_decontamination": DECONTAMINATION,
    "op9_url_filters": URLS,
    "op10_license_scans": license_sql(),
    "op11_periodic_runs": PERIODIC_RUNS,
    "op13_spelling_variants": SPELLING,
}
