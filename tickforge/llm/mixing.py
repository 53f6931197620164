r"""Mixing sources to target weights along a curriculum, with built-in expressions only.

Targets: sources share a budget by weight, but none takes more than a multiple of its own size; what a capped source can't
take is reshared by weight until none is above its cap.  That is a water level: sources ordered by cap per weight, prefix
sums decide where the level stands.

Documents: a source's documents lie in hash order (of the id, or of the text where that is null) on a line of words.  Whole passes over the source come first, then the
part of the line that is still needed, so whole documents are taken but for one per source, which is cut, and each source's
words sum to its target rounded.  Every source has a weight schedule over training time; its integral is the demand for
words up to each time, and inverting it gives the training position at which a document is read.  Rows are range-sorted by
position.

A source's line is summed in two steps, so that a source with a third of all rows isn't one task: sums per slice of the hash
range, then offsets within a slice.

Defined results: null text has size 0; the null source is a source, listed last; documents of one id are ordered by id,
then size (equal rows are interchangeable); a source without words takes none; empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import materialize

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
#: Hexadecimal digits that name a slice of the hash range (4096 slices); the relative change of a source's weight over
#: training, by its place in the list.
SLICE_DIGITS = 3
RAMPS = (-0.5, 0.5, 0.0)


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size`` to ``source, source_size, place, target``.  One row per source, no documents."""
    listed = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    rows = (
        sizes.withColumn("place", F.row_number().over(listed) - 1)
        .withColumn("weight", w)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_level", F.col("cap") / F.col("weight"))
    )
    by_level = W.orderBy("_level", "place")
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = (
        rows.withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("_water", F.col("_left") / F.sum("weight").over(after))
        # The level is where the first source that isn't full stands; if all are full there is none.
        .withColumn("_final", F.first(F.when(F.col("_water") < F.col("_level"), F.col("_water")), True).over(by_level.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    )
    target = F.when(F.col("_final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("_final") * F.col("weight")))
    return rows.select("source", "source_size", "place", target.alias("target"))


def invert_demand(u: Column, ramp: Column) -> Column:
    """Time in [0, 1] at which a source with weight ``1 + ramp * (2 t - 1)`` has used the share ``u`` of its words: the
    solution of ``t + ramp * (t * t - t) = u``."""
    root = F.sqrt(F.greatest((1 - ramp) * (1 - ramp) + 4 * ramp * u, F.lit(0.0)))
    return F.when(ramp == 0, u).otherwise(2 * u / (1 - ramp + root))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``id_col, size, source_size, target, taken, position, last_position``, sorted by position.

    ``taken`` is how many of its words the mix reads, repeats counted.  ``position`` is the training time at which it is
    first read, null if never; ``last_position`` that of its last reading.
    """
    rows = (
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"),
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit(""))).alias("order"),
        )
        .withColumn("slice", F.substring("order", 1, SLICE_DIGITS))
    )
    rows = materialize(rows.withColumn("source", F.col("source").cast("string")), "mixing")
    per_slice = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    planned = targets(per_slice.groupBy("source").agg(F.sum("slice_size").alias("source_size")))
    along = W.partitionBy("source").orderBy("slice")
    offsets = per_slice.withColumn("offset", F.sum("slice_size").over(along) - F.col("slice_size"))
    plan = offsets.join(planned, offsets["source"].eqNullSafe(planned["source"])).select(
        offsets["source"].alias("p_source"), F.col("slice").alias("p_slice"), "offset", "source_size", "place", "target"
    )
    inside = W.partitionBy("source", "slice").orderBy("order", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = placed.join(plan, placed["source"].eqNullSafe(plan["p_source"]) & (placed["slice"] == plan["p_slice"]))
    before = F.col("offset") + F.col("within")
    want = F.floor(F.col("target") + 0.5).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(want / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0).cast("long")
    rest = want - passes * F.col("source_size")
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - before))
    ramp = F.element_at(F.array(*map(F.lit, RAMPS)), (F.col("place") % len(RAMPS) + 1).cast("int"))
    share = lambda words: invert_demand(F.least(words / F.greatest(F.col("target"), F.lit(1.0)), F.lit(1.0)), ramp)
    last_pass = F.when(extra > 0, passes).otherwise(passes - 1)
    taken = passes * F.col("size") + extra
    return out.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        F.col("target").cast("double").alias("target"),
        taken.alias("taken"),
        F.when(taken > 0, share(before.cast("double"))).alias("position"),
        F.when(taken > 0, share((last_pass * F.col("source_size") + before).cast("double"))).alias("last_position"),
    ).orderBy(F.col("position").asc_nulls_last(), id_col)
