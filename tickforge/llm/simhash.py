r"""SimHash fingerprints, likeness of texts by their bits, and all fingerprints within a Hamming radius, with built-in expressions only.

The terms of a text are its runs of ``WIDTH`` words (a shorter text is one term), weighted by how often they occur.  Every term has a hash of ``BITS``
signed bits; the weights vote on each bit, and the sign of the sum is the fingerprint's bit.  Votes are summed in a grouped aggregation over the
exploded terms, two bits in a column (counts of 32 bits side by side), where the rows of a text already are in one place.

Fingerprints within ``RADIUS`` bits are found by permuted block tables: the bits are cut into ``BLOCKS`` blocks; a table for every choice of ``BLOCKS - RADIUS``
blocks puts these in front, as its key; two fingerprints within the radius agree in all blocks but ``RADIUS`` at most, so they agree in the key of some
table.  Pairs with equal keys are compared in the join itself, and a pair counts only in the first table where it agrees.  Equal fingerprints are one row of the
tables with a count, so copies are never paired.

``edited_likeness`` needs each document's successor in descending order of ids, without one task that sorts them all: distinct documents (an id and a hash
of its text) are dealt by ranges, followed within each range, and the first of every range, one row for each, is handed to the range before.  Texts are then
shuffled once, and the beginning of each successor a second time, as long as it is needed.

Defined results: null text is empty; a text without words has no votes and all bits zero; ids may be of any type that has an order, null ids come last; rows that are
equal in id and text are one document, whose result each of them gets; documents with equal ids follow each other by the hash of their texts; a single document
follows itself; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .scratch import materialize

WIDTH, BITS = 3, 128
#: Hamming radius of a search, and blocks of its tables.
RADIUS, BLOCKS = 6, 8
_LANES = 0x0000000100000001


def term_hashes(texts: DataFrame, text_col: str, width: int = WIDTH) -> DataFrame:
    """``texts`` with ``terms``, 64-bit hashes of all runs of ``width`` words (of all words if there are fewer), instead of the text."""
    words = F.filter(F.split(text_col, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    # A column of its own: each run looks up its words there.
    rows = texts.withColumn("words", words).drop(text_col)
    runs = F.transform("words", lambda w, i: F.xxhash64(w, *(F.get("words", i + d) for d in range(1, width))))
    return rows.withColumn("terms", F.slice(runs, F.lit(1), F.greatest(F.size("words") - (width - 1), F.least(F.size("words"), F.lit(1))))).drop("words")


def _sums() -> list[Column]:
    """Votes for the bits of ``term`` (and of its hash): bits ``j`` and ``j + 32`` of a half in one column."""
    second = F.when(F.col("term").isNotNull(), F.xxhash64("term"))
    return [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_LANES))).alias(f"{name}{j}") for name, h in (("a", F.col("term")), ("b", second)) for j in range(32)]


def _signs(name: str, votes: Column) -> Column:
    """64 bits from the votes: those that more than half of the terms have set."""
    bit = lambda set_, at: F.when(2 * set_ > votes, F.call_function("shiftleft", F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long"))
    low = lambda x: F.coalesce(x, F.lit(0).cast("long")).bitwiseAND(F.lit(0xFFFFFFFF))
    high = lambda x: F.shiftrightunsigned(F.coalesce(x, F.lit(0).cast("long")), 32)
    bits = F.transform(F.array(*(F.col(f"{name}{j}") for j in range(32))), lambda x, j: bit(low(x), j).bitwiseOR(bit(high(x), j + 32)))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def fingerprints(texts: DataFrame, keys: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """``keys, a, b`` (the halves of the fingerprint) of each text; the columns ``keys`` name a text and hold no nulls."""
    terms = term_hashes(texts.select(*keys, text_col), text_col).select(*keys, F.explode_outer("terms").alias("term"))
    votes = terms.groupBy(*keys).agg(F.count("term").alias("votes"), *_sums())
    return votes.select(*keys, _signs("a", F.col("votes")).alias("a"), _signs("b", F.col("votes")).alias("b"))


def distance(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Bits in which the fingerprints ``(a, b)`` and ``(c, d)`` differ."""
    return F.bit_count(a.bitwiseXOR(c)) + F.bit_count(b.bitwiseXOR(d))


def text_of(a: Column, b: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def _block(a: Column, b: Column, i: int, blocks: int) -> Column:
    """The bits of block ``i``; blocks are whole parts of one half."""
    per = blocks // 2
    half, at, size = (a if i < per else b), (i % per) * (64 // per), 64 // per
    return F.shiftrightunsigned(half, at).bitwiseAND(F.lit((1 << size) - 1 if size < 64 else -1))


def within_radius(queries: DataFrame, classes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``qa, qb, a, b, n`` for every query ``qa, qb`` and every row ``a, b, n`` of distinct fingerprints within ``radius`` bits of it.

    ``blocks`` is even, divides ``BITS`` and is greater than ``radius``.
    """
    choices = list(combinations(range(blocks), blocks - radius))

    def entries(rows: DataFrame, a: str, b: str) -> DataFrame:
        part = [_block(F.col(a), F.col(b), i, blocks) for i in range(blocks)]
        keys = [F.struct(F.lit(t).alias("table"), F.xxhash64(F.lit(t), *(part[i] for i in c)).alias("key")) for t, c in enumerate(choices)]
        return rows.select("*", F.explode(F.array(*keys)).alias("e")).select(*rows.columns, "e.table", "e.key")

    left = entries(queries.select("qa", "qb").distinct(), "qa", "qb").select("qa", "qb", F.col("table").alias("t"), F.col("key").alias("k"))
    right = entries(classes.select("a", "b", "n"), "a", "b")
    q, r = (F.col("qa"), F.col("qb")), (F.col("a"), F.col("b"))
    equal = [_block(q[0], q[1], i, blocks) == _block(r[0], r[1], i, blocks) for i in range(blocks)]
    first = reduce(lambda rest, t: F.when(reduce(lambda x, y: x & y, (equal[i] for i in choices[t])), t).otherwise(rest), range(len(choices) - 1, -1, -1), F.lit(-1))
    meets = (F.col("t") == F.col("table")) & (F.col("k") == F.col("key")) & (distance(*q, *r) <= radius) & (F.col("table") == first)
    # Explosion makes the entries of queries many times what the planner takes them for, so they are never broadcast.
    return left.hint("merge").join(right, meets).select("qa", "qb", "a", "b", "n")


def successors(keys: DataFrame) -> DataFrame:
    """``key, h, n, next_key, next_h`` of distinct rows ``id, key, h, n``: who follows by descending id (nulls last), then ``h``; the first follows the last."""
    order = [F.col("id").desc_nulls_last(), F.col("h")]
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(keys.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "ranges")
    along = W.Window.partitionBy("range").orderBy(*order)
    after = F.lead(F.struct("key", "h")).over(along)
    rows = dealt.select("key", "h", "n", "range", after.alias("after"), F.row_number().over(along).alias("place"))
    # One row for each range: its first document, and the first of the next range.
    first = rows.filter("place = 1").select("range", F.struct("key", "h").alias("head"))
    every = W.Window.orderBy("range")
    turn = F.first("head").over(every.rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing))
    heads = first.select(F.col("range").alias("r"), F.coalesce(F.lead("head").over(every), turn).alias("head"))
    out = rows.join(F.broadcast(heads), rows["range"] == heads["r"]).withColumn("next", F.coalesce("after", "head"))
    return out.select("key", "h", "n", F.col("next.key").alias("next_key"), F.col("next.h").alias("next_h"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, key, h, n_chars, edited, a, b, ea, eb, na, nb`` of each row: the SHA-256 of the edited text, and fingerprints of the text, the edited text
    and the successor's text.

    The edited text has, instead of its last third, as many of the first code points of its successor.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.xxhash64(text).alias("h"), text.alias("text"))
    keys = rows.groupBy("id", "key", "h").agg(F.max(F.length("text")).alias("n"))
    follow = materialize(successors(keys), "successors")
    whole = rows.select("key", "h", "text").repartition(parts, "key", "h").groupBy("key", "h").agg(F.first("text").alias("text"))
    wanted = follow.select(F.col("next_key").alias("key"), F.col("next_h").alias("h"), F.col("key").alias("to_key"), F.col("h").alias("to_h"), "n")
    heads = whole.join(wanted, ["key", "h"]).select(F.col("to_key").alias("key"), F.col("to_h").alias("h"), "n", F.substring("text", F.lit(1), F.floor(F.col("n") / 3).cast("int")).alias("head"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n") - F.floor(F.col("n") / 3)).cast("int")), F.col("head"))
    both = whole.join(heads, ["key", "h"]).select("key", "h", "n", "text", edited.alias("edited"))
    both = both.select("key", "h", "n", F.sha2("edited", 256).alias("sha"), F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("v"))
    marks = fingerprints(both.select("key", "h", "n", "sha", "v.which", "v.text"), ("key", "h", "n", "sha", "which"))
    of = lambda which, c: F.max(F.when(F.col("which") == which, F.col(c)))
    marks = marks.groupBy("key", "h", "n", "sha").agg(of(0, "a").alias("a"), of(0, "b").alias("b"), of(1, "a").alias("ea"), of(1, "b").alias("eb"))
    marks = materialize(marks, "fingerprints")
    after = marks.select(F.col("key").alias("next_key"), F.col("h").alias("next_h"), F.col("a").alias("na"), F.col("b").alias("nb"))
    marks = marks.join(follow.select("key", "h", "next_key", "next_h").join(after, ["next_key", "next_h"]).select("key", "h", "na", "nb"), ["key", "h"])
    return rows.select("id", "key", "h").join(marks, ["key", "h"]).select("id", "key", "h", F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited"), "a", "b", "ea", "eb", "na", "nb")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 50) -> DataFrame:
    """One row per document: its fingerprint and that of its edited text, their likeness (share of equal bits) and the likeness to its successor.

    ``n_near``: of documents whose id ``every`` divides, how many other rows of the table have a fingerprint within ``RADIUS`` bits; null for the others.
    """
    rows = materialize(edited_likeness(docs, id_col, text_col), "likeness")
    classes = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    asks = F.coalesce(F.expr("try_cast(id as bigint)") % every == 0, F.lit(False))
    found = within_radius(rows.filter(asks).select(F.col("a").alias("qa"), F.col("b").alias("qb")), classes)
    near = found.groupBy("qa", "qb").agg((F.sum("n") - 1).alias("n_near"))
    out = rows.join(near, (rows["a"] == near["qa"]) & (rows["b"] == near["qb"]), "left")
    like = lambda *x: 1 - distance(*map(F.col, x)) / F.lit(float(BITS))
    return out.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.col("edited").alias("edited_sha256"),
        text_of(F.col("a"), F.col("b")).alias("fingerprint"),
        text_of(F.col("ea"), F.col("eb")).alias("edited_fingerprint"),
        like("a", "b", "ea", "eb").alias("near_edited"),
        like("a", "b", "na", "nb").alias("near_next"),
        F.when(asks, F.col("n_near")).alias("n_near"),
    )
