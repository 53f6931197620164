import hashlib
import random
import re
import struct

import xxhash
from pyspark.sql import functions as F

from tickforge.llm import simhash
from tickforge.llm.simhash import fingerprint_documents, fingerprints, text_of, within_radius


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(*parts):
    """Spark's xxhash64 of several strings: each seeds the next."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p if isinstance(p, bytes) else p.encode(), seed=seed)
    return seed


def fingerprint(text):
    """The fingerprint of a text, voted term by term."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    terms = [words[i : i + 3] for i in range(max(len(words) - 2, min(len(words), 1)))]
    votes = [0] * 128
    for t in terms:
        first = chain(*t)
        bits = first, chain(struct.pack("<Q", first))
        for i in range(128):
            votes[i] += 1 if bits[i // 64] >> i % 64 & 1 else -1
    halves = [sum(1 << i for i in range(64) if votes[64 * h + i] > 0) for h in (0, 1)]
    return f"{halves[0]:016x}{halves[1]:016x}"


def apart(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def expected(rows):
    """Of distinct documents (id, text): all columns, by definition."""
    texts = {(i, t or "") for i, t in rows}
    order = sorted(texts, key=lambda x: (x[0] is None, -(x[0] or 0), signed(chain(x[1]))))
    mine = [(i, fingerprint(t)) for i, t in rows]
    out = {}
    for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        k = len(t) // 3
        edited = t[: len(t) - k] + u[:k]
        f, e, n = fingerprint(t), fingerprint(edited), fingerprint(u)
        near = sum(apart(f, g) <= 6 for _, g in mine) - 1 if i is not None and i % 50 == 0 else None
        out[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] = (f, e, 1 - apart(f, e) / 128, 1 - apart(f, n) / 128, near)
    return out


def check(df, rows):
    got = df.collect()
    assert len(got) == len(rows)
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in got} == expected(rows)


def test_whole_query_as_by_brute_force(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgé😀") for _ in range(rng.randrange(1, 9))) for _ in range(80)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(400)
    rows = [(i * 7 % 300, prose(rng.randrange(0, 60))) for i in range(120)]
    rows += [(300 + i, base if i % 3 else base + " " + prose(2)) for i in range(60)]
    rows += [(5, "again"), (5, "again"), (5, "other"), (None, "no id"), (None, None), (7, None), (7, "")]
    check(fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)), rows)


def test_awkward_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(fingerprint_documents(odd), rows)
    assert fingerprint_documents(empty).collect() == []
    one = odd.filter("doc_id = 12")
    check(fingerprint_documents(one), [(r["doc_id"], r["text"]) for r in one.collect()])


def test_all_fingerprints_within_the_radius(spark):
    rng = random.Random(8)
    far = [rng.getrandbits(128) for _ in range(40)]
    flip = lambda f, k: f ^ sum(1 << i for i in rng.sample(range(128), k))
    every = sorted(set(far + [flip(f, k) for f in far for k in range(1, 10)]))
    halves = [(signed(f >> 64), signed(f & (1 << 64) - 1), 1) for f in every]
    classes = spark.createDataFrame(halves, "a long, b long, n long")
    queries = spark.createDataFrame([h[:2] for h in halves[::5]], "qa long, qb long")
    for radius, blocks in ((6, 8), (3, 4), (0, 2)):
        found = [tuple(r) for r in within_radius(queries, classes, radius, blocks).select("qa", "qb", "a", "b").collect()]
        exact = [(*p[:2], *q[:2]) for p, f in zip(halves[::5], every[::5], strict=True) for q, g in zip(halves, every, strict=True) if bin(f ^ g).count("1") <= radius]
        assert sorted(found) == sorted(exact)


def test_equal_texts_and_edits(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a  b\tc d"), (3, "a b c e")], "k int, text string")
    f = {r["k"]: r["f"] for r in fingerprints(docs, ("k",)).select("k", text_of(F.col("a"), F.col("b")).alias("f")).collect()}
    assert f[1] == f[2] == fingerprint("a b c d")
    assert f[3] != f[1]


def test_main_path_has_no_python(odd):
    plan = simhash.edited_likeness(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
