import random
import zlib

from tickforge.llm.periodic_runs import collapse, periodic_runs, repeat_tails, run_digest, runs_of_texts


def brute(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def texts(seed):
    rng = random.Random(seed)
    pick = lambda letters, n: [rng.choice(letters) for _ in range(n)]
    fibonacci, b = ["a"], ["a", "b"]
    while len(b) < 900:
        fibonacci, b = b, fibonacci + b
    unit, part = pick("ab", rng.randrange(2, 5)), pick("abcdefgh", rng.randrange(30, 250))
    cut = unit[: rng.randrange(len(unit) + 1)]
    tower = (unit * rng.randrange(5, 30) + pick("abc", 2)) * 4
    return [
        [],
        pick("ab", 700),
        pick("abcd", 400),
        b,
        unit * 200,
        (unit * 70 + cut + unit * 70 + cut) * 2,  # touching runs of one period hold squares of many lags
        part + part + part[: rng.randrange(len(part))],
        pick("xyz", 50) + part[:40] * 2 + pick("xyz", 70) + part * 2,
        (tower + ["x"]) * 2,
        part[:11] + part[:11],  # 22 words
        part[:5] + part[:6],
        ["a"] * 11,
        ["a"] * 12,
    ]


def test_all_runs_as_by_brute_force():
    for seed in range(4):
        docs = texts(seed)
        for words, (w, runs) in zip(docs, runs_of_texts([" ".join(d) for d in docs]), strict=True):
            assert w == words
            assert runs == brute(words)


def test_long_monotonous_texts_take_linear_work():
    (_, one), (_, two) = runs_of_texts(["word " * 400_000, "a b " * 200_000])
    assert one == [(0, 400_000, 1)]
    assert two == [(0, 400_000, 2)]


def test_collapse_keeps_first_periods():
    words = "x a b a b a b a b a b a b a b y".split()
    assert collapse(words, brute(words)) == "x a b y"


def test_awkward_rows(odd, empty):
    rows = {(r["doc_id"], r["n_words"]): r for r in periodic_runs(odd).collect()}
    assert len(periodic_runs(odd).collect()) == odd.count()
    assert [tuple(x) for x in rows[6, 30000]["runs"]] == [(0, 30000, 1)]
    assert rows[6, 30000]["collapsed"] == "word"
    for i in (1, 2, 3):
        assert (rows[i, 0]["runs"], rows[i, 0]["collapsed"]) == ([], "")
    digest = run_digest(empty)
    assert digest.count() == 0
    assert {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"} <= set(digest.columns)
    none = [r for r in run_digest(odd).collect() if r["doc_id"] == 2][0]
    assert (none["n_runs"], none["start"], none["length"], none["period"], none["exponent_milli"]) == (0, None, None, None, None)


def test_tails_repeat_in_a_tenth_of_the_ids(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[: i % 41])) for i in range(300)] + [(None, "a b c")]
    got = {r["doc_id"]: r["text"] for r in repeat_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = 0
    for i, text in rows:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        w = text.split()
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert got[i] == " ".join(w[:a] + [w[a + (j - a) % p] for j in range(a, n)])
            hit += 1
        else:
            assert got[i] == text
    assert hit > 10
