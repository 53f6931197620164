import numpy as np
import pyarrow as pa
import pytest

from tickforge.llm import decontaminate, near_dup, token_counts
from tickforge.llm.wordstream import BLANK, KEEP, hash_words, windows

ONE = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
OTHER = ONE.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [7, 8, 9, 16, 64, 255, 256, 257, 1024, 2048])
def test_structured_words_differ(size):
    """Words that cancel out in sums of powers modulo 2**64, shifted words and repeated blocks."""
    words = {ONE[:size], OTHER[:size], "a" * size, "a" * (size - 1) + "b", "b" + "a" * (size - 1), "a" * (size + 1), "ab" * size, "ba" * size, ONE[:size][::-1] + "x"}
    got = hash_words(pa.array([" ".join(sorted(words))])).hashes
    assert len(set(got.tolist())) == len(words)


def test_equal_words_agree_wherever_they_stand():
    texts = ["x", " Abc\tdef  x" + ONE, None, "", "def x" + ONE + " abc", "é" * 9]
    w = hash_words(pa.array(texts), BLANK)
    assert w.counts.tolist() == [1, 3, 0, 0, 3, 1]
    h = w.hashes.tolist()
    assert h[1] == h[6] and h[2] == h[4] and h[3] == h[5] and len(set(h)) == 5
    kept = hash_words(pa.array(["Abc abc"]), BLANK, KEEP).hashes
    assert kept[0] != kept[1] == h[1]
    assert len(hash_words(pa.array(["zzz", "Abc"]).slice(1)).hashes) == 1


@pytest.mark.parametrize("k", [3, 5, 10])
def test_windows(k):
    rng = np.random.default_rng(k)
    docs = [rng.integers(0, 2, n).tolist() for n in (0, 1, 2, k - 1, k, k + 1, 300)]
    docs.append(docs[-1][:k])
    w = hash_words(pa.array([" ".join("ab"[x] for x in d) for d in docs]))
    out, first = windows(w.hashes, w.first, k)
    seen: dict = {}
    for d, (a, b) in zip(docs, zip(first[:-1], first[1:], strict=True), strict=True):
        runs = [tuple(d[i : i + k]) for i in range(len(d) - k + 1)] or ([tuple(d)] if d else [])
        assert len(runs) == b - a
        for r, h in zip(runs, out[a:b].tolist(), strict=True):
            assert seen.setdefault(r, h) == h
    assert len(set(seen.values())) == len(seen)


def test_structured_words_in_operators(spark):
    texts = [ONE, OTHER, f"{ONE} x y", f"{OTHER} x y", ONE]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.components_of(docs, 3, 85).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}
    items = spark.createDataFrame([("i", ONE)], "item_id string, text string")
    assert {r["doc_id"] for r in decontaminate.contamination(docs, items).collect() if r["contaminated"]} == {0, 2, 4}
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    for r in token_counts.token_counts(docs, path, 2048).collect():
        assert r["n_tokens"] == len(t.encode(texts[r["doc_id"]], add_special_tokens=False))
