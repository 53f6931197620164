"""Field-level change detection over a bounded table; the stream has the same rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import WATCHED

ITEM = ("app_id", "market_hash_name")
#: Rows of one time go by endpoint, domain and values, so that reruns agree.
ORDER = ("observed_at", "source_endpoint", "money_domain", *WATCHED)


def detect_changes(obs: DataFrame, fields: Sequence[str] = WATCHED, strict_domain: bool = False) -> DataFrame:
    """One row for each watched field that differs from its last known value within the same money domain.

    A null never replaces a value.  A row in another domain than the row before resets the fields that it has and reports
    none of them; a field that it hasn't keeps its value.  With ``strict_domain`` each domain of an item is followed apart.
    """
    keys = [*ITEM, "money_domain"] if strict_domain else list(ITEM)
    order = Window.partitionBy(*keys).orderBy(*(F.col(c).asc_nulls_last() for c in ORDER))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    marked = obs.withColumn("_domain", F.lag("money_domain").over(order))
    for f in fields:
        marked = marked.withColumn(f"_{f}", F.last(f, ignorenulls=True).over(before))
    tall = marked.select(
        *ITEM,
        "observed_at",
        F.col("_domain").eqNullSafe(F.col("money_domain")).alias("_same"),
        F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"_{f}").cast("double").alias("previous"), F.col(f).cast("double").alias("current")) for f in fields))).alias("c"),
    ).select(*ITEM, "observed_at", "_same", "c.*")
    changed = tall.filter(F.col("_same") & F.col("current").isNotNull() & F.col("previous").isNotNull() & (F.col("current") != F.col("previous")))
    delta = F.col("current") - F.col("previous")
    return changed.select(*ITEM, "field", "previous", "current", delta.alias("delta"), (F.try_divide(delta, F.col("previous")) * 100).alias("pct_change"), "observed_at")


def compression_report(obs: DataFrame, changes: DataFrame) -> DataFrame:
    """How many observations became how many change events, in all (field null) and by field."""
    total = obs.agg(F.count(F.lit(1)).alias("observations"), F.countDistinct(*ITEM).alias("keys"))
    counts = changes.rollup("field").agg(F.count(F.lit(1)).alias("events"))
    return counts.crossJoin(F.broadcast(total)).withColumn("ratio", F.try_divide(F.col("events").cast("double"), F.col("observations")))
