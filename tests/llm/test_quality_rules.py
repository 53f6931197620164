import re

from tickforge.llm import quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    wins = {}
    for i in range(len(words) - 7):
        wins.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {j for at in wins.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), n < 20 or 100 * len(hit) > 30 * n


def check(docs):
    want = sorted(((r["doc_id"] is None, r["doc_id"]), *brute(r["text"])) for r in docs.collect())
    rows = quality_rules.judge(docs).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"]), *r[1:7]) for r in rows) == want
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    return rows


def test_whole_table(spark):
    rows = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    good = [r for r in rows if not r["base_failed"]]
    assert sum(r["kept"] for r in good) > 0.8 * len(good)


def test_odd_texts(odd, empty):
    check(odd)
    assert quality_rules.judge(empty).count() == 0


def test_thresholds_adapt(spark):
    words = lambda n, i: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, words(100, i) + " #" * 6, "en", "code") for i in range(200)]
    rows += [(1000 + i, words(100, i), "en", "books") for i in range(200)]
    rows += [(5000, "# " * 90 + words(100, 5000), "en", "books"), (5001, words(100, 5001) + " #" * 6, "en", "code")]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[5000] and kept[5001] and all(kept[i] for i in range(200))


def test_fences_come_from_the_sketches(spark):
    """Every measure's fences differ from group to group, and refuse documents in groups of their own."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    groups = ("lang", "source")
    rows = quality_rules.with_buckets(quality_rules.measures(docs)).cache()
    found = quality_rules.fences(quality_rules.leaning(quality_rules.sketches(rows, groups), "source", "lang"), groups).collect()
    fence = {(r["measure"], r["lang"], r["source"]): r for r in found}
    kept_out = {m: set() for m in quality_rules.MEASURES}
    for r in rows.collect():
        for m in quality_rules.MEASURES:
            f = fence[m, r["lang"], r["source"]]
            if r[m] is not None and (r[m] > f["high"] or m == "word_length" and r[m] < f["low"]):
                kept_out[m].add((r["lang"], r["source"]))
    rows.unpersist()
    for m in quality_rules.MEASURES:
        assert len({r["high"] for r in found if r["measure"] == m}) > 10, m
        assert kept_out[m], m
    assert len(kept_out["symbol_share"]) > 60 and len(kept_out["word_length"]) > 60
    judged = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    wrong = sum(r["quality"] == 1 and not judged[r["doc_id"]]["kept"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect())
    assert wrong < 0.08 * len(judged)


def test_small_groups_lean_on_their_language(spark):
    """Without a size at which that changes: the weights are a document's own and the language's, whatever the size of the group."""
    rows = [("en", "big", "word_length", 10, 300), ("en", "small", "word_length", 90, 1), (None, None, "word_length", 5, 2)]
    sketch = spark.createDataFrame(rows, "l string, s string, measure string, bucket int, n long")
    got = {(r["l"], r["s"], r["bucket"]): int(r["weight"]) for r in quality_rules.leaning(sketch, "s", "l").collect()}
    p = quality_rules.PRIOR
    assert got == {("en", "big", 10): 300 * 301 + p * 300, ("en", "big", 90): p, ("en", "small", 10): p * 300, ("en", "small", 90): 301 + p, (None, None, 5): 2 * 2 + p * 2}
    fence = {r["s"]: (r["low"], r["high"]) for r in quality_rules.fences(quality_rules.leaning(sketch, "s", "l"), ("l", "s")).collect()}
    assert fence == {"big": (10, 10), "small": (10, 10), None: (5, 5)}
