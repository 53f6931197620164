import hashlib
import re

from tickforge.llm import pii


def luhn(d):
    s = [int(c) for c in d][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(s)) % 10 == 0


def base(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m[0])]


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def added(text):
    """IBANs, social security numbers and named secrets with the words near them."""
    words = {"iban": "iban|bank|account|konto|compte|cuenta", "ssn": "ssn|social|security|insurance", "secret": "key|secret|token|credential|login"}
    rules = [
        ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", mod97, 0.8),
        ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: m[:3] not in ("000", "666") and m[0] != "9" and m[4:6] != "00" and m[7:] != "0000", 0.4),
        ("secret", r"(?<![A-Za-z0-9])(?:[aA][pP][iI][_-]?[kK][eE][yY]|(?i:secret|token|password|passwd))\x20{0,3}[=:]\x20{0,3}[\"'][A-Za-z0-9_+/=-]{16,}[\"']", lambda m: True, 0.7),
    ]
    near = lambda m, k: any(re.search(words[k], x, re.I | re.A) for x in (text[max(0, m.start() - 40) : m.start()], text[m.end() : m.end() + 40]))
    return [(k, m.start(), m.end()) for k, p, ok, prior in rules for m in re.finditer(p, text) if ok(m[0]) and prior + 0.2 * near(m, k) >= 0.6 - 1e-9]


def check(docs):
    got = {}
    for r in pii.pii_digest(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    rows = docs.select("doc_id", "text").collect()
    assert sum(map(len, got.values())) == len(rows)
    for r in rows:
        spans = base(r["text"] or "")
        for g in got[r["doc_id"]]:
            assert [g[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE], r
            listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            assert g["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
            assert g["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans + added(r["text"] or ""))


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_odd_texts(odd, empty):
    skip = odd.filter("doc_id <> 8 or doc_id is null")  # quadratic for the plain patterns of this test
    check(skip)
    assert pii.pii_digest(odd).count() == odd.count()
    assert pii.pii_digest(empty).count() == 0


def test_edges(spark):
    texts = [
        "a@b.co%x@y.zz a@b@c.d ..@-.- @a.b a@b a@b.c.",
        "1.2.3.4.5.6.7.8 0001.002.3.255 256.1.1.1 1.2.3.0000000000000000004 1..2.3.4 0.0.0.0",
        "4111111111111111 4111-1111-1111-1111 4111  1111 4111 1111 1111 1112 - 378282246310005",
        "+1 (743) 555-3824 +49-30-123456 +1234 ++12345678901 + 1 23 +1 (743) 555-3824 (ext",
        "4111 1111 1111 1111 5",
    ]
    check(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))


def test_added_kinds(spark):
    texts = [
        (1, "my bank account is DE89 3704 0044 0532 0130 00 thanks"),
        (2, "DE89370400440532013001"),
        (3, "social security 123-45-6789"),
        (4, "lot 123-45-6789"),
        (5, 'api_key = "abcdef0123456789abcdef"'),
    ]
    got = {r["doc_id"]: r["spans"] for r in pii.pii_digest(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1].split(",")[-1] == "iban:19:46"
    assert "iban" not in got[2]
    assert "ssn:16:27" in got[3] and "ssn" not in got[4]
    assert "secret:0:34" in got[5]


def test_secrets_without_digits_and_long_ones(spark):
    long = "Ab-" * 4000
    texts = [(1, 'password = "CorrectHorseBatteryStaple" is set'), (2, f"token: '{long}'."), (3, 'password = "TooShort"'), (4, 'password = "CorrectHorseBatteryStaple')]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.pii_digest(df).collect()}
    assert got == {1: "secret:0:38", 2: f"secret:0:{9 + len(long)}", 3: "", 4: ""}
    masked = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert masked == {1: "<SECRET> is set", 2: "<SECRET>.", 3: texts[2][1], 4: texts[3][1]}


def test_redact(spark, odd):
    df = spark.createDataFrame([(1, "x a@b.cc y 1.2.3.4", 18), (2, None, None), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact(df, length_col="n_chars").collect()}
    assert got == {1: ("x <EMAIL> y <IP>", 16), 2: (None, None), 3: ("clean", 5)}
    again = pii.redact(odd)
    assert again.columns == odd.columns and again.count() == odd.count()


def test_context_windows(spark):
    """Forty characters before the span and forty after it, not the span, and no more where the text begins."""
    texts = [f"123-45-6789{' ' * n}social" for n in (33, 34, 35, 60)] + [f"social{' ' * n}123-45-6789" for n in (33, 34, 35)] + ["123-45-6789 a@b.cc 1.2.3.4 security", "1.2.3.4 " * 12 + "a host"]
    texts += ["bob@mail.com", "write to bob@x.com", "a@b.cc," * 9 + "mail", "mail" + ",a@b.cc" * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(df)
    scores = {r["doc_id"]: r["scores"].split(",") for r in pii.pii_digest(df).collect()}
    assert scores[9] == ["0.80"] and scores[10] == ["1.00"]
    assert scores[11] == ["0.80"] * 3 + ["1.00"] * 6 and scores[12] == ["1.00"] * 6 + ["0.80"] * 3


def test_many_matches_and_clashing_columns(spark):
    text = "".join(f"é{i} a{i}@b.cc, 10.0.{i % 256}.{i % 300} " for i in range(5000))
    docs = spark.createDataFrame([(1, text, "mine", [1], "x"), (2, "plain", None, None, "y"), (3, None, "z", [], None)], "doc_id long, text string, _whole string, _spans array<int>, _new string")
    check(docs.select("doc_id", "text"))
    got = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert got[1]["_whole"] == "mine" and got[1]["_spans"] == [1] and got[1]["_new"] == "x" and got[2]["text"] == "plain" and got[3]["text"] is None
    want, at = "", 0
    for k, a, b in sorted(base(text), key=lambda s: s[1]):
        want, at = want + text[at:a] + f"<{k.upper()}>", b
    assert got[1]["text"] == want + text[at:]


def test_overlapping_spans_are_masked_together(spark):
    texts = ["+1.2.3.4 x", "+49 4111 1111 1111 1111", "a 12.34.56.78@b.cc z", "1.2.3.4 2.3.4.5"]
    got = [r["text"] for r in sorted(pii.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())]
    assert not any(base(t) for t in got)
    assert got[2] == "a <EMAIL> z" and got[3] == "<IP> <IP>"
