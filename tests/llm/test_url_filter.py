from tickforge.llm import url_filter
from tickforge.llm.components import connected_components


def test_rules(spark):
    urls = ["http://A.Net/x?y", "https://a.net", "http://example.net/en/1", "http://www.EXAMPLE.net/en", "ftp://example.com/de/", "http://m.org/fr/x#y", "http://xorg/fr/", "no url", None, "a://b://c.net/", "http://a.net?x/"]
    rows = {i: r for i, r in enumerate(sorted(url_filter.filter_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")).collect()))}
    assert [rows[i]["rule"] for i in range(11)] == ["net/", None, "example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None, None, None]
    assert (rows[0]["host"], rows[0]["path"]) == ("a.net", "/x") and (rows[8]["host"], rows[8]["path"]) == ("", "")
    assert rows[10]["verdict"] == "allow" and rows[0]["verdict"] == "block"


def test_aliases(spark):
    canonical = lambda u: f'<head><link href="{u}" rel="canonical"></head>'
    refresh = lambda u: f"<meta http-equiv='refresh' content='0; url={u}'>"
    pages = [
        (1, "http://bad.net/x", None),
        (2, "http://alias.io/a", canonical("http://bad.net/x")),
        (3, "http://alias.io/b#frag", refresh("http://alias.io/a")),
        (4, "http://site.org/fr/ok", canonical("http://alias.io/a2")),
        (5, "http://alias.io/a2", canonical("http://bad.net/x2")),
        (6, "http://free.io/", canonical("/relative")),
        (7, "http://site.org/fr/y", refresh("http://bad.net/z")),
        (8, "http://alias.io/r", None),
        (8, "http://alias.io/r", None),
        (9, None, canonical("http://bad.net/x")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://alias.io/r", "http://alias.io/b"), (None, "x")], "u string, v string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(df, redirects).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow"}
    assert url_filter.filter_urls(df, redirects).count() == len(pages)
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_components(spark):
    import random

    random.seed(5)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(None, 3), (7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_planted_links_over_a_whole_table(spark, tmp_path):
    """Canonical links and refreshes between the pages of a table, in many spellings, against the SQL."""
    import duckdb

    from tests.compare import differences
    from tickforge.llm.oracles import ORACLES

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()
    rows = []
    for i, p in enumerate(pages):
        to = pages[(i * 7 + 3) % len(pages)]["url"]
        host, _, path = to.partition("://")[2].partition("/")
        href = [to, f"HTTP://{host.upper()}:80/{path}", f"https://{host}:443/{path}?a=1&amp;b=2#x", f"//{host}/{path}", f"/{path}", "./next?x", "?q=1", "#top", "mailto:a@b.cc", ""][i % 10]
        tag = f'<LINK href="{href}" rel=canonical>' if i % 3 else f'<meta http-equiv="refresh" content="0; url={href}">'
        rows.append((p["page_id"], None if i % 50 == 0 else p["url"] + "#frag" * (i % 2), None if i % 40 == 0 else (p["html"] or "") + (tag if i % 4 else "")))
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    planted = spark.read.parquet(f"{tmp_path}/pages.parquet")
    assert url_filter.links(planted).count() > 80
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = url_filter.filter_urls(planted)
    assert differences(got, db, ORACLES["op9_url_filters"]) == ""
    assert got.filter("rule is null and verdict = 'block'").count() > 5


def test_spellings_of_a_blocked_url(spark):
    rows = [(i, f"http://p{i}.com/", f'<link rel="canonical" href="{h}">') for i, h in enumerate(["http://BAD.NET:80/x?a=1&amp;b=2", "http://bad.net/x?a=1&b=2#y", "https://bad.net/x", "//p1.com", "/in", "javascript:0"])]
    rows += [(10, "http://p4.com/in", None), (11, "HTTP://P0.COM", None)]
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [k for k, v in got.items() if v == "allow"] == [4, 5, 10]


def test_rules_fit_urls_as_they_are_written(spark):
    """A url that no rule fits as it is written is treated alike with a link and without one."""
    rows = [(1, "http://x.net", None), (2, "http://y.net", '<link rel="canonical" href="http://a.de/1">'), (3, "http://a.de/1", None), (4, "http://z.net/", None), (5, "http://z.net:80", '<link rel="canonical" href="/in">')]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # The last is another spelling of a page that a rule blocks.
    assert got == {1: (None, "allow"), 2: (None, "allow"), 3: (None, "allow"), 4: ("net/", "block"), 5: (None, "block")}


def test_generated_code_compiles(spark):
    """With links, redirects and rules, every stage stays under the limit of generated code."""
    pages = spark.createDataFrame([(1, "http://y.io", '<link rel="canonical" href="http://a.net/1">')], "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        assert [r["verdict"] for r in url_filter.filter_urls(pages, spark.createDataFrame([("http://a.net/1", "x://y")], "u string, v string")).collect()] == ["block"]
    finally:
        spark.conf.set("spark.sql.codegen.fallback", before)
        spark.conf.unset("spark.sql.codegen.factoryMode")
