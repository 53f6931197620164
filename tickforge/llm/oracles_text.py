"""DuckDB SQL of the queries on periodic runs and spelling variants, with a CRC-32 that DuckDB lacks."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: One row ``tab``: the 256 remainders of CRC-32.
CRC_TABLE = """crc AS (SELECT list(list_reduce([b, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS tab
  FROM (SELECT unnest(range(256)) AS b))"""


def crc32(text: str, tab: str = "tab") -> str:
    """CRC-32 of text of code points up to U+00FF in UTF-8; ``tab`` is the column of ``CRC_TABLE``."""
    units = f"list_transform(string_split({text}, ''), lambda ch: ord(ch))"
    octets = f"flatten(list_transform({units}, lambda o: CASE WHEN o < 128 THEN [o] ELSE [192 + (o >> 6), 128 + (o & 63)] END))"
    step = f"xor(c >> 8, {tab}[CAST(xor(c & 255, b) AS BIGINT) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({octets}, lambda o: CAST(o AS BIGINT))), lambda c, b: {step}), 4294967295::BIGINT)"


PERIODIC_RUNS = rf"""WITH {CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, {crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc),
e AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS hit, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN hit THEN g % n END AS a FROM e),
p AS (SELECT *, CASE WHEN hit THEN 1 + (n - a) // (3 + g % 8) END AS p FROM f),
t AS (SELECT doc_id, n, CASE WHEN hit THEN w[:a] || list_transform(range(n - a), lambda i: w[a + i % p + 1]) ELSE w END AS w FROM p),
u AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM t),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM u x JOIN u y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m) GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS rank FROM r),
g AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM u WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = u.doc_id AND u.i >= r.start + r.period AND u.i < r.start + r.length) GROUP BY doc_id)
SELECT t.doc_id, t.n AS n_words, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN g USING (doc_id) LEFT JOIN (SELECT * FROM b WHERE rank = 1) b USING (doc_id) LEFT JOIN k USING (doc_id)"""

SPELLING = rf"""WITH RECURSIVE {CRC_TABLE},
o AS (SELECT doc_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '{LETTERS}'), lambda s: translate(s, '{UPPER}', '{SMALL}'))) AS run FROM documents),
h AS (SELECT run, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM o, crc),
w AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM h),
v AS (SELECT word, count(*) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
g AS (SELECT word, n, unnest(list_distinct(list_transform(range(length(word)), lambda i: left(word, CAST(i AS INTEGER)) || substr(word, CAST(i AS INTEGER) + 2)))) AS less FROM v),
x AS (SELECT word, n, unnest(list_transform(range(length(word)), lambda i: left(word, CAST(i AS INTEGER)) || '.' || substr(word, CAST(i AS INTEGER) + 2))) AS gap FROM v),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM x a JOIN x b ON a.gap = b.gap AND a.word <> b.word
  UNION SELECT g.word, g.n, v.word, v.n FROM g JOIN v ON g.less = v.word UNION SELECT v.word, v.n, g.word, g.n FROM g JOIN v ON g.less = v.word),
c AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS top, max(m) AS top_n FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 2 * v.n THEN top END AS form, CASE WHEN top_n >= 2 * v.n THEN top_n END AS form_n FROM v LEFT JOIN c USING (word)),
r(word, root) AS (SELECT word, word FROM f WHERE form IS NULL UNION ALL SELECT f.word, r.root FROM f JOIN r ON f.form = r.word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r USING (word)"""
