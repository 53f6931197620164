"""Slowly changing dimensions of type 2."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scd2_merge(current: DataFrame, incoming: DataFrame, keys: Sequence[str], checked: Sequence[str], as_of: Column) -> DataFrame:
    """The next state of a versioned table (``keys, attributes, valid_from, valid_to``).

    A key whose checked attributes differ gets its open version closed at ``as_of`` and a new one opened; a new key is opened; a key that vanished
    stays open; closed versions stay as they are.  Only the open versions are joined.
    """
    attributes = [c for c in current.columns if c not in ("valid_from", "valid_to")]
    closed = current.filter(F.col("valid_to").isNotNull())
    open_ = current.filter(F.col("valid_to").isNull()).alias("o")
    new = incoming.select(*attributes).alias("n")
    same_key = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    joined = open_.withColumn("_old", F.lit(True)).join(new.withColumn("_new", F.lit(True)), same_key, "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in checked])
    old, fresh = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    versions = F.array(
        F.when(old, F.struct(*(F.col(f"o.{c}").alias(c) for c in attributes), F.col("o.valid_from").alias("valid_from"), F.when(fresh & differs, as_of).alias("valid_to"))),
        F.when(fresh & (~old | differs), F.struct(*(F.col(f"n.{c}").alias(c) for c in attributes), as_of.alias("valid_from"), F.lit(None).cast(current.schema["valid_to"].dataType).alias("valid_to"))),
    )
    merged = joined.select(F.explode(F.array_compact(versions)).alias("v")).select("v.*")
    return closed.unionByName(merged)


def scd2_first(incoming: DataFrame, as_of: Column) -> DataFrame:
    """The first state: every row open since ``as_of``."""
    return incoming.withColumn("valid_from", as_of).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))


def scd2_replay(history: DataFrame, keys: Sequence[str], checked: Sequence[str], at: str) -> DataFrame:
    """All versions ``keys, attributes, valid_from, valid_to`` from the whole history of attributes at once: the state that merging every date in turn would leave.

    ``history`` has a row for each key and time ``at`` at which the key was seen.  A row opens a version if it is the key's first or differs in a checked attribute
    from the row before; the version lasts until the next one opens, and has the attributes of the row that opened it.  Of several rows of a key and time the last by attributes
    counts.  Rows without a time are left out.

    One exchange by key, whatever the number of dates.  A key's rows are sorted, never gathered, and only rows that open a version reach the second window, which
    runs over the same partitioning.
    """
    attributes = [c for c in history.columns if c not in (*keys, at)]
    rows = history.filter(F.col(at).isNotNull()).select(*keys, F.col(at).alias("valid_from"), *attributes)
    along = Window.partitionBy(*keys).orderBy("valid_from", *(F.col(c).asc_nulls_first() for c in attributes))
    rows = rows.withColumn("_last", ~F.lead("valid_from").over(along).eqNullSafe(F.col("valid_from"))).filter("_last").drop("_last")
    by_time = Window.partitionBy(*keys).orderBy("valid_from")
    same = reduce(lambda a, b: a & b, [F.lag(c).over(by_time).eqNullSafe(F.col(c)) for c in checked])
    opens = rows.withColumn("_opens", (F.row_number().over(by_time) == 1) | ~same).filter("_opens").drop("_opens")
    return opens.select(*keys, *attributes, "valid_from", F.lead("valid_from").over(by_time).alias("valid_to"))


def scd2_continue(current: DataFrame, history: DataFrame, keys: Sequence[str], checked: Sequence[str], at: str) -> DataFrame:
    """``current`` (as ``scd2_replay`` or ``scd2_merge`` left it) with later dates: only the open versions take part, as the first rows of their keys."""
    attributes = [c for c in current.columns if c not in (*keys, "valid_from", "valid_to")]
    open_ = current.filter(F.col("valid_to").isNull()).select(*keys, *attributes, F.col("valid_from").alias(at))
    later = scd2_replay(open_.unionByName(history.select(*keys, *attributes, at)), keys, checked, at)
    return current.filter(F.col("valid_to").isNotNull()).unionByName(later.select(*current.columns))


def with_current_flag(versions: DataFrame) -> DataFrame:
    return versions.withColumn("is_current", F.col("valid_to").isNull())
