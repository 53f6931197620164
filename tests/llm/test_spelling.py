import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np

from tickforge.llm import spelling
from tickforge.llm.spelling import Ranks, group_variants, near_words, roots, vocabulary, words_of


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def some_words(seed, letters, size):
    rng = random.Random(seed)
    out = {"".join(rng.choice(letters) for _ in range(rng.randrange(5, 12))) for _ in range(size)}
    for w in list(out):
        i = rng.randrange(len(w))
        out |= {w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]}
    return sorted(w for w in out if len(w) >= 5)


def expected(counts):
    """Rows of the query by comparing all words."""
    near = {w: [x for x in counts if is_near(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        r = w
        while form[r]:
            r = form[r]
        out.add((w, form[w], r, counts[w], len(near[w]), counts.get(form[w])))
    return out


def rows(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_ranks_are_those_of_sorted_rotations():
    rng = np.random.default_rng(5)
    text = rng.integers(0, 4, 300).astype(np.uint8)
    ranks = Ranks(text, 4)
    turns = sorted(range(300), key=lambda i: bytes(np.roll(text, -i)))
    assert ranks.suffix.tolist() == turns
    before = np.array([text[i - 1] for i in turns])
    for r in (0, 1, 63, 64, 65, 200, 300):
        for c in range(4):
            same, less = ranks.count(np.array([c]), np.array([r]))
            assert (same[0], less[0]) == ((before[:r] == c).sum(), (before[:r] < c).sum())


def test_each_near_word_is_found_once():
    for seed, letters in enumerate(["ab", "abc", "abcdefgh", "aàÿ×z"]):
        words = some_words(seed, letters, 40)
        ask = words[:: seed % 2 + 1]
        got = []
        for right in (False, True):
            query, near = near_words(words, ask, right)
            got += [(ask[q], words[x]) for q, x in zip(query.tolist(), near.tolist(), strict=True)]
        assert sorted(got) == sorted((a, b) for a in ask for b in words if is_near(a, b))


def test_groups_as_by_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    counts = {w: rng.choice([3, 4, 5, 8, 13, 30, 90]) for w in some_words(9, "abcd", 60)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows(group_variants(df)) == expected(counts)
    monkeypatch.setattr(spelling, "BLOCK", 7)  # halves that are cut into blocks
    monkeypatch.setattr(spelling, "SHARD", 900)  # and many shards
    assert rows(group_variants(df)) == expected(counts)


def test_a_near_word_met_under_another_half_is_not_counted_again(spark, monkeypatch):
    asking, own, other = ("abcdef", 5, False, True), ("abcdeg", 9, True, True), ("abcdeg", 9, True, False)
    assert spelling._answers(False, [asking, own]) == (["abcdef"], [1], ["abcdeg"], [9])
    assert spelling._answers(False, [asking, other]) == ([], [], [], [])
    assert spelling._answers(False, [asking, own, other]) == (["abcdef"], [1], ["abcdeg"], [9])
    shorter = [("abcde", 9, True, asks) for asks in (True, False)]  # its own half is "ab"
    assert spelling._answers(False, [asking, shorter[0]]) == ([], [], [], [])
    assert spelling._answers(False, [asking, shorter[1]]) == (["abcdef"], [1], ["abcde"], [9])
    words = ["".join(w) for size in (5, 6, 7) for w in itertools.product("ab", repeat=size)]
    counts = {w: 3 + 7 * i % 40 for i, w in enumerate(words)}
    monkeypatch.setattr(spelling, "BLOCK", 5)
    monkeypatch.setattr(spelling, "SHARD", 600)
    assert rows(group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == expected(counts)


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}" if i < 40 else None) for i in range(41)]
    got = {r["word"]: r["root"] for r in roots(spark.createDataFrame(chain + [("alone", None)], "word string, form string")).collect()}
    assert got == {w: "w040" for w, _ in chain} | {"alone": "alone"}


def test_texts_to_groups(spark, odd, empty):
    long = "x" * 5000
    texts = [(i, f"Color colour COLOUR colour{i % 2} Straße strasse {long} {long[:-1]}") for i in range(60)] + [(None, "colour"), (3, None), (3, ""), (3, "color color")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    counts = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    got = group_variants(vocabulary(spelling.drop_letters(words_of(docs))))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows(got) == expected(counts)
    assert ("color", "colour", "colour") in {r[:3] for r in rows(got)}
    assert "other" not in {r["word"] for r in vocabulary(words_of(odd)).collect()}
    assert group_variants(vocabulary(words_of(empty))).count() == 0
