import public_tokenizers
from tokenizers import Tokenizer

from tickforge.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    t = Tokenizer.from_file(PATH)
    return sorted(
        (r["doc_id"] if r["doc_id"] is not None else -1, len((r["text"] or "").encode()), n := len(t.encode(r["text"] or "", add_special_tokens=False)), n > 2048)
        for r in rows
    )


def got(df):
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in df.collect())


def test_whole_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(token_counts.token_counts(docs, PATH, 2048)) == expected(docs.collect())


def test_odd_texts(odd, empty):
    assert got(token_counts.token_counts(odd, PATH, 2048)) == expected(odd.collect())
    assert token_counts.token_counts(empty, PATH, 2048).count() == 0


def test_table_and_cache_never_change_results(odd, monkeypatch):
    want = expected(odd.collect())
    monkeypatch.setattr(token_counts, "SUMMARY", 2)
    monkeypatch.setattr(token_counts, "CACHE", 1)
    assert got(token_counts.token_counts(odd, PATH, 2048)) == want
