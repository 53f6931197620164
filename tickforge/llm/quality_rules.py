r"""Quality rules with thresholds that adapt to each language and source, with built-in expressions only.

Every document gets a few measures of its whole text.  Each measure feeds a mergeable quantile sketch per language and
source: counts of logarithmic buckets (``GAMMA - 1`` wide), which are partial sums on the map side, merge by
addition in any order and so give the same thresholds on every run.  Cutoffs are fences read from the sketches, ``FENCE`` times the
distance of the quartiles in buckets (the usual fence for far outliers) above the upper one and, for the word length, below the lower one; a join brings them back to the
documents of that language and source.

* No measure has a cutoff, floor or least width of its own.  Most texts have no symbols or repetitions at all; what a text without them says is that its share lies below what
  its length can show.  So a share of ``x`` in ``n`` enters the sketch as ``(x + 1/2) / (n + 1/2)``, and the quartiles of a group lie apart as far as the resolutions of its texts do.  The share
  itself is compared with the fence, and none at all always passes.
* A group's sketch is merged with its language's, scaled to the weight of ``PRIOR`` documents.  So a small group leans on its language and a large one on itself, at every
  size in the same way.

Words are ``[^\x20\x09-\x0D]+``.  Defined results: null text has no words, no lines and fails the base rule; null language
or source is a group of its own; repeated rows count each; empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .scratch import materialize

WINDOW = 8
MIN_WORDS, REPEAT_PERCENT = 20, 30
#: Width of a sketch bucket; fences lie so many distances of the quartiles outside them; documents that a group's language counts as.
GAMMA = 1.01
FENCE = 3
PRIOR = 20
#: Measures: the count, and what it is a share of (the word length is a mean, with a fence on both sides).
MEASURES = ("symbol_share", "dup_line_share", "repeat_share", "word_length")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _sorted_windows(hashes: Column) -> Column:
    """``(hash, place)`` of all windows, equal hashes side by side."""
    return F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _covered(p: Column) -> Column:
    """How many words the windows cover that occur twice or more, from sorted windows."""
    same = lambda i, d: F.coalesce(F.get(p, i + d)["h"] == F.get(p, i)["h"], F.lit(False))
    again = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: ((i > 0) & same(i, -1)) | same(i, 1))
    at = F.array_sort(F.transform(again, lambda i: F.get(p, i)["i"]))
    return F.aggregate(
        at,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(
            (i + WINDOW).alias("end"), (acc["n"] + (i + WINDOW - F.greatest(acc["end"], i)).cast("long")).alias("n")
        ),
    )["n"]


def _joined(hashes: Column, d: int) -> Column:
    """Each hash with the one that stands ``d`` places on."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + d)))


def measures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The columns ``keep`` and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of each text."""
    blank = " \t\n\x0b\f\r"
    rows = docs.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    text = F.col("_text")
    rows = (
        rows.withColumn("_words", F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != ""))
        .withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn("word_chars", F.length(F.translate(text, blank, "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .drop("_text", "_lines")
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .drop("_words")
    )
    for d in (1, 2, 4):  # hashes of two, four and eight words from those of half as many
        rows = rows.withColumn("_hashes", _joined(F.col("_hashes"), d))
    rows = rows.withColumn("_hashes", F.slice("_hashes", 1, F.greatest(F.size("_hashes") - (WINDOW - 1), F.lit(0))))
    # Most texts repeat nothing, which one pass over the hashes shows.
    again = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    rows = rows.withColumn("_pairs", F.when(again, _sorted_windows(F.col("_hashes"))))
    rows = rows.withColumn("n_repeat_words", F.when(F.col("_pairs").isNotNull(), _covered(F.col("_pairs"))).otherwise(F.lit(0).cast("long")))
    return rows.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), *COUNTS)


def _parts() -> dict[str, tuple[Column, Column]]:
    one = lambda c: F.greatest(c, F.lit(1)).cast("double")
    return {
        "symbol_share": (F.col("n_symbols"), one(F.col("word_chars"))),
        "dup_line_share": (F.col("n_dup_lines"), one(F.greatest(F.col("n_words") / 8.0, F.col("n_dup_lines")))),
        "repeat_share": (F.col("n_repeat_words"), one(F.col("n_words"))),
        "word_length": (F.col("word_chars"), one(F.col("n_words"))),
    }


def _bucket(value: Column) -> Column:
    return F.ceil(F.log(value) / F.log(F.lit(GAMMA))).cast("int")


def with_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` with, for each measure, the bucket of its value (null if that is zero) and ``_seen``, the bucket that enters the sketch."""
    out = {}
    for m, (count, size) in _parts().items():
        out[m] = F.when(count > 0, _bucket(count / size))
        out[f"{m}_seen"] = out[m] if m == "word_length" else _bucket((count + 0.5) / (size + 0.5))
    return rows.withColumns(out)


def sketches(rows: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Bucket counts ``groups, measure, bucket, n``: the mergeable sketches of all measures."""
    tall = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(f"{m}_seen").alias("bucket")) for m in MEASURES))).alias("x")
    return rows.select(*groups, tall).select(*groups, "x.*").filter("bucket is not null").groupBy(*groups, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def leaning(sketch: DataFrame, group: str, wider: str) -> DataFrame:
    """Sketches ``wider, group, measure, bucket, weight`` in which the sketch of ``wider`` counts as ``PRIOR`` documents.

    With ``n`` of ``total`` documents of the wider group in a bucket, a document of the group itself weighs ``total`` and the bucket ``PRIOR * n`` besides: whole numbers, so sums are exact.
    """
    whole = W.Window.partitionBy(wider, "measure")
    wide = sketch.groupBy(wider, "measure", "bucket").agg(F.sum("n").alias("n")).withColumn("total", F.sum("n").over(whole))
    wide = wide.select(F.col(wider).alias("w"), F.col("measure").alias("m"), F.col("bucket").alias("b"), F.col("n").alias("wn"), "total")
    totals = wide.select("w", "m", "total").distinct()
    same = F.col(wider).eqNullSafe(F.col("w")) & (F.col("measure") == F.col("m"))
    big = lambda c: F.col(c).cast("decimal(18,0)")
    own = sketch.join(totals, same).select(wider, group, "measure", "bucket", (big("n") * big("total")).alias("weight"))
    lent = sketch.select(wider, group, "measure").distinct().join(wide, same).select(wider, group, "measure", F.col("b").alias("bucket"), (F.lit(PRIOR) * big("wn")).alias("weight"))
    return own.unionByName(lent).groupBy(wider, group, "measure", "bucket").agg(F.sum("weight").cast("decimal(38,0)").alias("weight"))


def fences(sketch: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Cutoffs ``groups, measure, low, high``, as the lowest and highest bucket that passes, read from sketches with a ``weight``."""
    order = W.Window.partitionBy(*groups, "measure").orderBy("bucket")
    whole = W.Window.partitionBy(*groups, "measure")
    ranked = sketch.withColumn("_upto", F.sum("weight").over(order)).withColumn("_all", F.sum("weight").over(whole))
    quartile = lambda k: F.min(F.when(4 * F.col("_upto") >= k * F.col("_all"), F.col("bucket")))
    quartiles = ranked.groupBy(*groups, "measure").agg(quartile(1).alias("q25"), quartile(3).alias("q75"))
    reach = FENCE * (F.col("q75") - F.col("q25"))
    return quartiles.select(*groups, "measure", (F.col("q25") - reach).alias("low"), (F.col("q75") + reach).alias("high"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: the measures, ``base_failed`` and ``kept``."""
    counted = measures(docs, text_col, (id_col, lang_col, source_col)).toDF("_id", "_lang", "_source", *COUNTS)
    rows = with_buckets(materialize(counted, "quality"))
    fine = materialize(sketches(rows, ("_lang", "_source")), "sketches")
    found = fences(leaning(fine, "_source", "_lang"), ("_lang", "_source"))
    wide = found.groupBy(F.col("_lang").alias("g_lang"), F.col("_source").alias("g_source")).agg(
        *(F.max(F.when(F.col("measure") == m, F.col(end))).alias(f"{m}_{end}") for m in MEASURES for end in ("low", "high"))
    )
    joined = rows.join(wide, F.col("_lang").eqNullSafe(F.col("g_lang")) & F.col("_source").eqNullSafe(F.col("g_source")), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    good = F.lit(True)
    for m in MEASURES:
        within = F.col(m) <= F.col(f"{m}_high")
        good &= F.coalesce(within & (F.col(m) >= F.col(f"{m}_low")) if m == "word_length" else within, F.lit(True))
    return joined.select(
        F.col("_id").alias(id_col), *COUNTS, failed.alias("base_failed"), (~failed & good).alias("kept")
    )
