import re

import pytest

from tickforge.llm import mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full, out = 1.5 * sum(sizes.values()), set(), {}
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        out = {s: 2 * sizes[s] if s in full else left * weight[s] / w for s in names}
        over = {s for s in names if s not in full and out[s] > 2 * sizes[s]}
        if not over:
            return out
        full |= over


def check(docs):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    src = docs.collect()
    sizes = {}
    for r in src:
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    assert sorted(r["size"] for r in rows) == sorted(size(r["text"]) for r in src)
    want = brute_targets(sizes)
    source = {r["doc_id"]: r["source"] for r in src}
    taken = {}
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        assert (r["position"] is None) == (r["taken"] == 0)
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1
    positions = [r["position"] for r in rows if r["position"] is not None]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sources(docs).collect()))


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_odd(odd, empty):
    check(odd)
    assert mixing.mix_sources(empty).count() == 0


def test_curriculum_inverts_demand(spark):
    from pyspark.sql import functions as F

    df = spark.range(11).select((F.col("id") / 10).alias("u"))
    for ramp in (-0.5, 0.0, 0.5):
        for r in df.select("u", mixing.invert_demand(F.col("u"), F.lit(ramp)).alias("t")).collect():
            assert r["t"] + ramp * (r["t"] ** 2 - r["t"]) == pytest.approx(r["u"])
