from tickforge.llm import language_id


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    test = [r for r in rows if r["held_out"]]
    assert len(test) > 200 and sum(r["lang"] == r["lang_pred"] for r in test) > 0.97 * len(test)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_teach_nothing(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    blind = docs.withColumn("lang", F.when(language_id.held_out(), None).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert sorted(language_id.identify(docs).collect()) == sorted(language_id.identify(blind).collect())


def test_odd(odd, empty, spark):
    got = {}
    for r in language_id.identify(odd).collect():
        got.setdefault(r["doc_id"], r["lang_pred"])
    assert [got[i] for i in (1, 2, 3, 8)] == ["und"] * 4
    assert got[9] == "fr" and got[4] != "und"
    assert language_id.identify(empty).count() == 0
    untaught = language_id.predict_language(odd.select("doc_id", "text"), {}).collect()
    assert {r["lang_pred"] for r in untaught} == {"und"}


def test_vectors_by_hand():
    import numpy as np

    v = language_id.bundle(["ab"])[0]
    a, b, s = (language_id.letter_vector(ord(c)).astype(int) for c in "ab ")
    want = np.roll(s, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * s
    assert (v == want).all()


def brute(rows):
    """Predictions and scores by definition, one n-gram after another: rows ``id, text, lang``."""
    import unicodedata
    import zlib

    import numpy as np

    def vector(text):
        plain = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in f" {text.lower()} ")
        plain = " ".join(plain.split()).join("  ") if plain.strip() else " "
        out = np.zeros(language_id.DIMENSIONS)
        for i in range(len(plain) - 2):
            bound = np.ones(language_id.DIMENSIONS)
            for back, c in enumerate(reversed(plain[i : i + 3])):
                bound = bound * np.roll(language_id.letter_vector(ord(c)).astype(float), back)
            out += bound
        return out

    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    learned = {}
    for i, text, lang in rows:
        if text is not None and lang is not None and not (i is not None and zlib.crc32(str(i).encode()) % 3 == 1):
            learned[lang] = learned.get(lang, 0) + vector(text)
    learned = {k: unit(v) for k, v in sorted(learned.items()) if np.any(v)}
    mean = sum(learned.values()) / len(learned)
    out = {}
    for i, text, _ in rows:
        if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            out[i] = "und", 0.0
            continue
        v = unit(unit(vector(text)) - mean)
        cosine = {k: float(v @ unit(p - mean)) for k, p in learned.items()}
        best = max(cosine, key=lambda k: cosine[k])
        out[i] = best, min(max((1 + cosine[best]) / 2, 0), 1)
    return out


def test_predictions_by_brute_force(spark):
    import pytest

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").limit(60).collect()
    rows = [(r["doc_id"], (r["text"] or "")[:160], r["lang"]) for r in docs]
    rows += [(1000, "\u0301\u0301", "en"), (1001, "e\u0301te\u0301 12", "fr"), (1002, None, "en"), (1003, "123 --", "en"), (1004, "no label here", None), (1005, "ÀÉ Straße", "de")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    want = brute(rows)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert {k: v[1] for k, v in got.items()} == pytest.approx({k: v[1] for k, v in want.items()}, abs=1e-6)
    assert got[1000] == got[1002] == got[1003] == ("und", 0.0) and got[1001][0] != "und"
