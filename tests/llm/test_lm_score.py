import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickforge.llm import lm_score
from tickforge.llm.elias_fano import EliasFano, load, save


@pytest.mark.parametrize(("n", "u"), [(0, 10), (1, 1), (1000, 1 << 20), (5000, 6000), (20000, (1 << 64) - 1)])
def test_elias_fano(tmp_path, n, u):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, u, n, dtype=np.uint64))
    save(f"file://{tmp_path}/x", EliasFano.build(v, u).arrays())
    e = EliasFano.of(load(f"file://{tmp_path}/x"))
    assert (e.get(np.arange(n)) == v).all()
    q = np.concatenate([rng.integers(0, u, 500, dtype=np.uint64), v])
    place, there = e.find(q)
    assert (place == np.searchsorted(v, q)).all() and (there == np.isin(q, v)).all()


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows, order):
    grams = [Counter() for _ in range(order + 1)]
    n_docs = 0
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            seq = ["<s>", *tokens(t)]
            n_docs += 1
            grams[1].update((w,) for w in seq)
            for k in range(2, order + 1):
                grams[k].update(tuple(seq[a : a + k]) for a in range(len(seq) - k + 1))
    n = sum(grams[1].values()) - n_docs
    v = len(grams[1]) - (1 if n_docs else 0)
    kept = [None, *grams[1:]]
    after = [defaultdict(list) for _ in range(order + 1)]
    for k in range(2, order + 1):
        for g, c in kept[k].items():
            after[k][g[:-1]].append(c)

    def p(g):
        if len(g) == 1:
            return (grams[1].get(g, 0) + 1) / (n + v + 1)
        low = p(g[1:])
        total = grams[len(g) - 1].get(g[:-1], 0)
        counts = after[len(g)].get(g[:-1])
        if not counts:
            return low
        back = 1 - sum(c - lm_score.DISCOUNT for c in counts) / total
        c = kept[len(g)].get(g)
        return (max(c - lm_score.DISCOUNT, 0) / total if c else 0) + back * low

    out = []
    for i, t in rows:
        seq = ["<s>", *tokens(t)]
        base = sum(math.log10(p((w,))) for w in seq[1:])
        score = sum(math.log10(p(tuple(seq[max(0, a - order + 1) : a + 1]))) for a in range(1, len(seq)))
        known = sum((w,) in grams[1] for w in seq[1:])
        out.append(((i is None, i), i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(seq) - 1, known, n, base, score))
    return sorted(out)


def check(df, rows, order):
    got = sorted(((r[0] is None, r[0]), *r[1:]) for r in lm_score.score_documents(df, order=order).collect())
    return same(got, brute(rows, order))


def same(got, want):
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], abs=4e-4 * w[2] + 1e-9)
    return got


@pytest.mark.parametrize("order", [1, 2, 3])
def test_whole_table(spark, sf_dir, order):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()], order)
    if order > 1:
        out = [g for g in got if g[1]]
        assert sum(g[6] for g in out) > sum(g[5] for g in out)


def test_odd(spark, odd, empty):
    check(odd, [(r["doc_id"], r["text"]) for r in odd.collect()], 3)
    assert lm_score.score_documents(empty).count() == 0
    held = spark.createDataFrame([(i, "a b") for i in range(60)], "doc_id long, text string").filter(lm_score.held_out())
    rows = lm_score.score_documents(held).collect()
    assert rows and all(r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in rows)


def test_ngrams_that_occur_once_count(spark):
    """A held-out copy of a single training document scores far above its own words in another order."""
    out = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    new = next(i for i in range(100) if i not in out)
    words = [f"w{j}" for j in range(200)]
    rows = [(new, " ".join(words)), (out[0], " ".join(words)), (out[1], " ".join(words[::-1]))]
    got = {r["doc_id"]: r for r in lm_score.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    copy, turned = got[out[0]], got[out[1]]
    assert copy["held_out"] and turned["held_out"] and copy["base_score"] == pytest.approx(turned["base_score"])
    assert copy["score"] > turned["score"] + 200


def test_small_shards_and_split_contexts(spark, sf_dir):
    """Many files to a level, and contexts that are dealt to several of them, give the same scores."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = lm_score.train(docs.filter(~lm_score.held_out()), shard=3000, hot=40)
    assert min(model.shards) > 3 and all(len(h.ids) > 3 and h.parts.max() > 1 for h in model.hot[:2])
    scored = lm_score.score(docs, model, "doc_id", "text").collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in (r["doc_id"] for r in scored)}
    got = sorted(((False, r[0]), held[r[0]], r[1], r[2], model.tokens, r[3], r[4]) for r in scored)
    same(got, brute([(r["doc_id"], r["text"]) for r in docs.collect()], 3))


def test_successors_of_large_numbers(tmp_path):
    """A shard of contexts with numbers up to 2**40 whose words have numbers up to 2**40: raised numbers stay one sequence."""
    rng = np.random.default_rng(5)
    c = np.unique(rng.integers(0, 1 << 40, 50_000))
    c, w = np.repeat(c, 3), rng.integers(0, 1 << 40, 3 * len(c))
    assert len(lm_score._combined(c, w)[0]) == len(c) == int(lm_score._combined(c, w)[2].sum())
    blob = lm_score._pack(*lm_score._combined(c, w))
    assert all((x == y).all() for x, y in zip(lm_score._unpack(blob, 3), lm_score._combined(c, w), strict=True))
    model = lm_score.Model(tokens=len(c), types=1 << 40, shards=[1, 1], paths=[{}], hot=[lm_score.Hot()])
    c, w, n = lm_score._combined(c, w)
    model.paths.append({0: lm_score.write_level(f"file://{tmp_path}", 0, c, w, n, model, 2)[1]})
    ids, gained, back = model.successors(2, c, w)
    assert (ids == np.arange(len(c))).all() and gained == pytest.approx(0.4 / 3, rel=1e-3) and back == pytest.approx(0.6, rel=1e-3)
    ids, gained, back = model.successors(2, c, w ^ 1)
    assert (ids[~np.isin(w ^ 1, w)] == -1).all() and (model.successors(2, c + 1, w)[2] == 1).mean() > 0.99


def test_probabilities_sum_to_one(spark):
    texts = ["a b a b c", "a b c", "b a", "a b a c c", "c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = lm_score.train(df, 3)
    from tickforge.llm.wordstream import hash_words
    import pyarrow as pa

    words = hash_words(pa.array(["a b c zzz"])).hashes
    ids, counts = model.words(np.append(words, lm_score.END))
    base = model.base(counts)
    assert base.sum() == pytest.approx(1)
    for c in ids[:3]:
        _, gained, back = model.successors(2, np.full(5, c), ids)
        assert (gained + back * base).sum() == pytest.approx(1, abs=2e-3)


def test_structured_words(spark):
    """Words that cancel out in sums of powers modulo 2**64 keep counts of their own."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    train = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [(train[0], one), (train[1], other), (train[2], other), (train[3], other[:200]), (train[4], one[:200])]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 3)
