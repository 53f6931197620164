r"""Personal data in whole texts, with built-in expressions only.

Regular expressions propose spans, checksums confirm or refuse them (Luhn for cards, mod-97 for IBANs, number ranges for
addresses), and nearby context words move the score.  A text's spans come from ``split`` and ``regexp_extract_all`` with the
same pattern: the lengths of the pieces between matches and of the matches, summed up by doubling, give every start in code points, and the pieces around a match
are its context; nothing leaves the row, nothing is shuffled, and the work doesn't grow with the square of the matches.

The patterns are written with possessive loops and anchored at the first character of a run (or the end of the
previous match), which finds exactly the leftmost non-overlapping matches of the plain patterns, in linear time and without
recursion on very long runs.

Base kinds: ``email``, ``ip``, ``card``, ``phone``.  Kinds that the method adds: ``iban`` (mod-97), ``ssn`` (valid ranges and
a context word) and ``secret`` (a named credential followed by a long value).  A base span is always reported; an added
one if its score, which context words near it raise, reaches ``THRESHOLD``.

Defined results: null and empty texts have no spans (empty strings, counts 0); repeated rows are treated alike;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import fresh

#: Plain pattern meant by each kind, as an equivalent linear one.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?i)(?<![A-Za-z0-9])(?:api[_-]?key|secret|token|password|passwd)\x20{0,3}[=:]\x20{0,3}[\"'][A-Za-z0-9_+/=-]{16,}+[\"']",
}
BASE = ("email", "ip", "card", "phone")
#: A pattern without which a text can hold no match; saves the scan.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+", "iban": "[0-9]{2}", "ssn": "[0-9]{2}", "secret": r"[=:]\x20{0,3}[\"']"}
#: Words that raise the score of a kind when they stand in the WINDOW characters before the span or in those after it.
CONTEXT = {
    "email": "mail|contact|write|address",
    "ip": "host|server|address|login|client",
    "card": "card|visa|credit|payment|cvv",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social|security|insurance",
    "secret": "key|secret|token|credential|login",
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.4, "ssn": 0.4, "secret": 0.7}
CHECKED, NEARBY, WINDOW, THRESHOLD = 0.4, 0.2, 40, 0.6
#: Pieces before or after a match that surely hold WINDOW characters, or all there are: no match has fewer than five.
PIECES = 2 * (WINDOW // 5) + 1
#: Spans that are cut out of a text together.
BLOCK = 256
MASKS = {k: f"<{k.upper()}>" for k in PATTERNS}


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.length(digits))
    value = F.aggregate(
        places,
        F.lit(0),
        lambda acc, i: acc
        + F.when((F.length(digits) - i) % 2 == 0, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
            F.substr(digits, i, F.lit(1)).cast("int") * 2
            - F.when(F.substr(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0)
        ),
    )
    return value % 10 == 0


def mod97(iban: Column) -> Column:
    """True if an account number leaves 1 modulo 97, its letters read as 10 to 35."""
    s = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substr(s, F.lit(5), F.length(s)), F.substr(s, F.lit(1), F.lit(4)))
    left = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(c == "", acc)
        .when(c.rlike("[0-9]"), (acc * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return left == 1


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return s.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}+|(?<=0))(?:\.|$)){4}$")
    if kind == "card":
        d = _digits(s)
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    if kind == "iban":
        return mod97(s)
    if kind == "ssn":
        return ~s.rlike("^(?:000|666|9)") & ~s.rlike("-00-") & ~s.rlike("-0000$")
    return F.lit(True)


def running(values: Column, join: Callable[[Column, Column], Column], none: Column) -> Column:
    """Running sums (or other joins) of an array: in step ``k`` each takes in the one ``2**k`` places before it."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))
    back = lambda sums, i, k: F.coalesce(F.get(sums, i - F.pow(F.lit(2), k).cast("int")), none)
    return F.aggregate(steps, values, lambda sums, k: F.transform(sums, lambda x, i: join(x, back(sums, i, k))))


def spans_of(text: Column, kind: str) -> Column:
    """Array of ``(kind, start, end, score)`` of the valid matches of one kind, in order of their starts."""
    pattern = PATTERNS[kind]
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    # Arrays that are needed more than once are bound as the one element of an array, so that they are made once.
    zipped = F.array(F.zip_with(between, found, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m"))))  # the last gap has no match

    def measured(z: Column) -> Column:
        size = F.transform(z, lambda r: F.length(r["gap"]) + F.coalesce(F.length(r["m"]), F.lit(0)))
        return F.struct(z.alias("rows"), F.flatten(F.transform(z, lambda r: F.array(r["gap"], r["m"]))).alias("pieces"), running(size, lambda a, b: a + b, F.lit(0)).alias("ends"))

    bound = F.transform(zipped, measured)
    whole = lambda parts, at, n: F.array_join(F.slice(parts, at, n), "")
    words = rf"(?i)(?:{CONTEXT[kind]})"

    def near(parts: Column, i: Column) -> Column:
        """Piece ``2 i + 2`` (from 1) is match ``i``."""
        first = F.greatest(2 * i + 2 - PIECES, F.lit(1))
        return F.right(whole(parts, first, 2 * i + 2 - first), F.lit(WINDOW)).rlike(words) | F.left(whole(parts, 2 * i + 3, F.lit(PIECES)), F.lit(WINDOW)).rlike(words)

    def placed(b: Column) -> Column:
        one = lambda r, i: F.struct(r["m"].alias("m"), (F.get(b["ends"], i) - F.length(r["m"])).alias("start"), F.get(b["ends"], i).alias("end"), i.alias("i"))
        score = lambda s: F.lit(PRIOR[kind] + (CHECKED if kind in ("card", "iban") else 0.0)) + F.when(near(b["pieces"], s["i"]), NEARBY).otherwise(0.0)
        valid = F.filter(F.transform(b["rows"], one), lambda s: s["m"].isNotNull() & _valid(kind, s["m"]))
        return F.transform(valid, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score(s).alias("score")))

    scored = F.flatten(F.transform(bound, placed))
    if kind not in BASE:
        scored = F.filter(scored, lambda s: s["score"] >= THRESHOLD - 1e-9)
    return F.when(text.rlike(NEEDS[kind]) & text.rlike(pattern), scored).otherwise(empty)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, an array column of spans for each kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    return rows.select(F.col("_id").alias(id_col), *(spans_of(F.col("_text"), k).alias(k) for k in PATTERNS))


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base spans, a hash of their list, and the list of all spans, per document."""
    found = find_pii(docs, id_col, text_col)
    joined = lambda kinds: F.concat(*(F.col(k) for k in kinds))
    return found.select(
        id_col,
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(_listed(joined(BASE)), 256).alias("base_sha256"),
        _listed(joined(PATTERNS)).alias("spans"),
        F.array_join(F.transform(joined(PATTERNS), lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every found span replaced by the mask of its kind, and ``length_col`` set to the new length if it is named.

    Spans that overlap are masked together, as the one that starts first, then the longest, then the first kind by name.
    """
    whole, spans, runs, parts, new = (fresh(docs, c) for c in ("whole", "spans", "runs", "parts", "new"))
    found = F.concat(*(spans_of(F.col(whole), k) for k in PATTERNS))
    masks = F.map_from_arrays(F.array(*map(F.lit, MASKS)), F.array(*map(F.lit, MASKS.values())))
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("last"), s["kind"].alias("kind"))))
    # Runs of overlapping spans: one begins where no span before reaches, and ends where the last of it does.
    reach = running(F.transform(spans, lambda s: -s["last"]), F.greatest, F.lit(0))
    heads = F.transform(runs, lambda r: F.filter(F.transform(F.col(spans), lambda s, i: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), F.coalesce(F.get(r, i - 1), F.lit(-1)).alias("before"))), lambda h: h["start"] >= h["before"]))
    ended = lambda heads, r: F.transform(heads, lambda h, i: F.struct(h["start"].alias("start"), h["kind"].alias("kind"), F.coalesce(F.get(heads, i + 1)["before"], F.element_at(r, -1)).alias("end")))
    parted = F.flatten(F.zip_with(heads, F.col(runs), ended))

    def block(first: Column) -> Column:
        """What stands from the end of the run before ``first`` to the end of the last run of its block, masked."""
        mine = F.slice(F.col(parts), first + 1, F.lit(BLOCK))
        begin = F.when(first == 0, 0).otherwise(F.get(F.col(parts), first - 1)["end"])
        text = F.substr(F.col(whole), begin + 1, F.element_at(mine, -1)["end"] - begin)
        cut = lambda t: F.transform(
            mine,
            lambda r, i: F.concat(
                F.substr(t, F.coalesce(F.get(mine, i - 1)["end"], begin) - begin + 1, r["start"] - F.coalesce(F.get(mine, i - 1)["end"], begin)), F.element_at(masks, r["kind"])
            ),
        )
        return F.array_join(F.flatten(F.transform(F.array(text), cut)), "")

    blocks = F.transform(F.sequence(F.lit(0), F.size(parts) - 1, F.lit(BLOCK)), block)
    rest = F.substr(F.col(whole), F.element_at(F.col(parts), -1)["end"] + 1, F.length(whole))
    some = F.size(parts) > 0
    out = (
        docs.withColumn(whole, F.coalesce(F.col(text_col), F.lit("")))
        .withColumn(spans, order)
        .withColumn(runs, F.array(reach))
        .withColumn(parts, F.when(F.size(spans) > 0, parted).otherwise(F.array()))
        .withColumn(new, F.when(some, F.concat(F.array_join(blocks, ""), rest)))
    )
    changed = {text_col: F.when(some, F.col(new)).otherwise(F.col(text_col))}
    if length_col:
        changed[length_col] = F.when(some, F.length(new).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return out.select(*(changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
