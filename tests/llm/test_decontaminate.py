import hashlib
import re

from tickforge.llm import decontaminate


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        k = min(10, len(w))
        for a in range(len(w) - k + 1) if k else ():
            wins.setdefault(tuple(w[a : a + k]), set()).add(str(i))
    sizes = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w, hit, of = words(t), set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if found := wins.get(tuple(w[a : a + k])):
                    of |= found
                    hit |= set(range(a, a + k))
        out.append(((d is None, d), len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def got(df):
    return sorted(((r[0] is None, r[0]), *r[1:6]) for r in df.collect())


def test_whole_tables(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert got(decontaminate.contamination(docs, items)) == want
    assert any(r[-1] for r in want)


def test_many_blocks_and_shards(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    want = got(decontaminate.contamination(docs, items))
    monkeypatch.setattr(decontaminate, "BLOCK", 100)
    monkeypatch.setattr(decontaminate, "SHARD", 1)
    assert got(decontaminate.contamination(docs, items)) == want


def test_index_is_held_by_few_shards_at_a_time(spark):
    """Writers and readers hold a row group, and footers the least and greatest bytes of each; so neither may grow with the shards that one task writes."""
    import pyarrow.parquet as pq

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").coalesce(1)
    shards = 0
    for path in decontaminate.build_index(docs).inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:")).metadata
        for g in map(meta.row_group, range(meta.num_row_groups)):
            assert g.num_rows == 1 or g.total_byte_size < 6 << 20
            assert not any(g.column(c).is_stats_set for c in range(g.num_columns) if g.column(c).physical_type == "BYTE_ARRAY")
        shards += meta.num_rows
    assert shards > 8


def test_documents_without_words_alone(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    texts = [(1, None), (2, ""), (3, " - ")]
    assert got(decontaminate.contamination(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), bench)) == brute(texts, [(1, "a b c")])


def test_short_items_overlaps_and_borders(spark, odd, empty):
    texts = [(1, "a b c d e f g h i j k l"), (2, "x a b"), (3, "b c"), (4, "A-B! c d e f g h i j k l m"), (5, "a a a a a a a a a a a a"), (6, None), (7, "é b")]
    items = [(10, "a b"), (11, "a b c d e f g h i j k"), (12, "a"), (13, ""), (14, None), (15, "É B"), (16, "a a a a a a a a a a a"), (10, "l m")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontaminate.contamination(docs, bench)) == brute(texts, items)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(decontaminate.contamination(odd, bench)) == brute(rows, items)
    assert decontaminate.contamination(empty, bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, bench.limit(0)).collect())


def test_repetitive_items_take_bounded_work(spark):
    """2000 equal words against 40 000 of them, and many windows of two words: equal windows once, places in pieces."""
    import time

    import numpy as np

    same = decontaminate.item_windows([{"words": [7] * 2000}], 10)
    assert [len(g[0]) for g in same] == [1]
    terms, ends = np.array([7], np.uint64), np.array([40_000])
    began = time.perf_counter()
    window, start = decontaminate._find(terms, ends, np.arange(40_000), same[0][0])
    assert len(start) == 39_991 and time.perf_counter() - began < 2
    rng = np.random.default_rng(1)
    two = decontaminate.item_windows([{"words": rng.integers(1, 3, 3000).tolist()}], 10)[0][0]
    parts = list(decontaminate._pieces(np.array([1, 2], np.uint64), np.array([20_000, 40_000]), two, 2))
    assert sum(map(len, parts)) == len(two) == len(np.unique(np.concatenate(parts))) and len(parts) > 10


def test_repetitive_texts_by_brute_force(spark, monkeypatch):
    import random

    rng = random.Random(5)
    letters = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(i, letters(n)) for i, n in enumerate((4, 9, 10, 30, 60))] + [(7, "a " * 50), (8, "a " * 9)]
    texts = [(i, letters(rng.randrange(150))) for i in range(25)] + [(90, "a " * 300), (91, "b a " * 100)]
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for cut, piece in ((1 << 16, 1 << 20), (7, 50)):
        monkeypatch.setattr(decontaminate, "CUT", cut)
        monkeypatch.setattr(decontaminate, "PIECE", piece)
        assert got(decontaminate.contamination(docs, bench)) == brute(texts, items)


def test_proximity(spark):
    text = " ".join(f"w{i}" for i in range(12))
    broken = text.replace("w5", "w5 extra words here")
    docs = spark.createDataFrame([(1, text), (2, broken), (3, "w1 " * 5)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in decontaminate.contamination(docs, spark.createDataFrame([(1, text)], "item_id long, text string")).collect()}
    assert (rows[1]["n_items"], rows[1]["n_near_items"]) == (1, 0)
    assert (rows[2]["n_items"], rows[2]["n_near_items"]) == (0, 1)
    assert (rows[3]["n_items"], rows[3]["n_near_items"]) == (0, 0)


def brute_near(docs, items, slop=10):
    out = {}
    for d, t in docs:
        at: dict = {}
        for p, w in enumerate(words(t)):
            at.setdefault(w, []).append(p)
        for i, text in items:
            w = words(text)
            k = min(10, len(w))
            for a in range(len(w) - k + 1) if k else ():
                win = w[a : a + k]
                for s in {p - j for j, x in enumerate(win) for p in at.get(x, ())}:
                    if sum(any(abs(p - s - j) <= slop for p in at.get(x, ())) for j, x in enumerate(win)) >= -(-k * 8 // 10):
                        out.setdefault(d, set()).add(str(i))
    exact = {d: {i for i, t in items if any(" ".join(words(t)[a : a + min(10, len(words(t)))]) in " ".join(words(x)) for a in range(max(1, len(words(t)) - 9)))} for d, x in docs}
    return {d: len(v - {str(i) for i in exact[d]}) for d, v in out.items()}


def test_proximity_by_brute_force(spark, monkeypatch):
    """Altered copies, whatever else stands in the shard; terms of another document never count."""
    import random

    rng = random.Random(3)
    items = [(i, " ".join(f"v{rng.randrange(300)}" for _ in range(n))) for i, n in enumerate((10, 10, 14, 25, 7, 3, 12))]
    items.append((99, items[0][1]))
    docs = []
    for d in range(40):
        w = [f"v{rng.randrange(300)}" for _ in range(rng.choice((0, 5, 40, 90)))]
        for _ in range(2):
            part = items[rng.randrange(7)][1].split()
            for _ in range(rng.randrange(4)):
                part[rng.randrange(len(part))] = f"n{rng.randrange(9)}"
            if rng.random() < 0.3:
                part = part[: len(part) // 2] + [f"x{rng.randrange(9)}"] * rng.choice((1, 4, 12)) + part[len(part) // 2 :]
            at = rng.randrange(len(w) + 1)
            w[at:at] = part[: rng.randrange(3, len(part) + 1)]
        docs.append((d, " ".join(w)))
    halves = items[1][1].split()
    docs += [(100, " ".join(halves[:5])), (101, " ".join(halves[5:]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_near(docs, items)
    assert sum(v > 0 for v in want.values()) > 10
    for shard in (decontaminate.SHARD, 1):
        monkeypatch.setattr(decontaminate, "SHARD", shard)
        found = {r["doc_id"]: r["n_near_items"] for r in decontaminate.contamination(frame, bench).collect()}
        assert found == {d: want.get(d, 0) for d, _ in docs} and found[100] == found[101] == 0
