import random
import re

import pytest

from tickforge.llm import near_dup


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    for i, s in sets.items():
        near = {}
        for x in s:
            for j in by[x]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, n in near.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return sorted(((i is None, i), len(shingles(t, width)), root(i) if i is not None else None, i is None or root(i) == i) for i, t in rows)


def got(df):
    return sorted(((r[0] is None, r[0]), *r[1:]) for r in df.collect())


@pytest.fixture(scope="module")
def groups(spark):
    """Near copies of a few texts, at similarities around the threshold, and chains of them."""
    rng = random.Random(3)
    rows = []
    for g in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(40):
            t = list(base)
            for _ in range(rng.randrange(9)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(t)))
    return rows


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_whole_table(spark, width, percent):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(near_dup.components_of(docs, width, percent)) == brute(rows, width, percent)


def test_groups(spark, groups):
    want = brute(groups, 3, 85)
    assert 6 < len({r[2] for r in want}) < len(groups)
    assert got(near_dup.components_of(spark.createDataFrame(groups, "doc_id long, text string"), 3, 85)) == want


def test_parts_too_large_for_a_task(spark, groups, monkeypatch):
    monkeypatch.setattr(near_dup, "PART", 500)
    monkeypatch.setattr(near_dup, "TILE", 2000)
    monkeypatch.setattr(near_dup, "SMALL", 3)
    assert got(near_dup.components_of(spark.createDataFrame(groups, "doc_id long, text string"), 3, 85)) == brute(groups, 3, 85)


def test_links_of_shuffled_chains():
    """Revisions that drift: only neighbours in a chain reach the threshold, and every order of the sets finds all links."""
    import numpy as np

    rng = random.Random(5)
    for _ in range(300):
        chains = [[np.arange(c * 1000 + k, c * 1000 + k + 20) for k in range(rng.randrange(2, 12))] for c in range(rng.randrange(1, 4))]
        sets = [s for chain in chains for s in chain]
        rng.shuffle(sets)
        label = list(range(len(sets)))
        for i, j in near_dup._linked(sets, 85):
            assert abs(int(sets[i][0]) - int(sets[j][0])) == 1
            label = [label[i] if x == label[j] else x for x in label]
        assert len(set(label)) == len(chains)


def test_odd(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(near_dup.components_of(odd, 3, 85)) == brute(rows, 3, 85)
    assert near_dup.components_of(empty, 3, 85).count() == 0
    kept = near_dup.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_minhash_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    b = np.concatenate([a[:400], rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    s = near_dup.circulant_minhash(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 600, 1200]), 1024)
    assert abs((s[0] == s[1]).mean() - 400 / 800) < 0.06


def test_ids_of_other_types(spark):
    texts = ["one two three four", "one two three four", "a b c", "one two three four five", None]
    docs = spark.createDataFrame([(f"x{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dup.components_of(docs, 1, 80).collect()}
    assert got == {"x0": ("x0", True), "x1": ("x0", False), "x2": ("x2", True), "x3": ("x0", False), "x4": ("x4", True)}
    assert {r["doc_id"] for r in near_dup.keep_one(docs, 1, 80).collect()} == {"x0", "x2", "x4"}


def test_comparisons_are_linear_in_small_sets():
    """Chains of short texts: twice as many sets take about twice as long, not four times."""
    import time

    import numpy as np

    from tickforge.llm.near_dup import _linked

    took = []
    for m in (5000, 20_000):
        chain = [np.array([i // 2, i // 2 + 10**6, (i + 1) // 2 + 2 * 10**6], np.uint64) for i in range(m)]
        began = time.perf_counter()
        assert len(_linked(chain, 50)) == m // 2
        took.append(time.perf_counter() - began)
    assert took[1] < 9 * took[0]


def test_links_join_what_all_pairs_join():
    import numpy as np

    from tickforge.llm.near_dup import _linked

    def joined(m, links):
        root = list(range(m))
        for a, b in links:
            ra, rb = root[a], root[b]
            root = [min(ra, rb) if r in (ra, rb) else r for r in root]
        return root

    rng = np.random.default_rng(3)
    for _ in range(60):
        base = [np.unique(rng.integers(0, rng.integers(5, 80), rng.integers(1, 30))).astype(np.uint64) for _ in range(int(rng.integers(1, 8)))]
        sets = []
        for _ in range(int(rng.integers(1, 50))):
            x, k = base[rng.integers(len(base))], int(rng.integers(0, 4))
            sets.append(np.unique(np.concatenate([x[k:] if len(x) > k else x, rng.integers(0, 90, k).astype(np.uint64)])))
        similar = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
        every = [(i, j) for i in range(len(sets)) for j in range(i) if similar(sets[i], sets[j])]
        links = _linked(sets, 80)
        assert all(similar(sets[i], sets[j]) for i, j in links)
        assert joined(len(sets), links) == joined(len(sets), every) and len(links) == len(sets) - len(set(joined(len(sets), every)))
