"""Checks are frames of violations; a gate runs them and stops what follows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import utc


@dataclass
class Check:
    """Passes if ``violations`` has no row.  ``severity``: ``block`` or ``warn``."""

    name: str
    severity: str
    violations: DataFrame


class GateFailed(RuntimeError):
    pass


@dataclass
class GateResult:
    passed: int
    total: int
    failed: list[str] = field(default_factory=list)
    warned: list[str] = field(default_factory=list)

    @property
    def success(self) -> bool:
        return not self.failed

    def __str__(self) -> str:
        return f"{self.passed}/{self.total} checks passed" + (f"; failed: {', '.join(self.failed)}" if self.failed else "")


def run_gate(checks: Sequence[Check], stop: bool = True) -> GateResult:
    """Run checks; with ``stop`` a failed blocking check raises."""
    out = GateResult(0, len(checks))
    for c in checks:
        if c.violations.limit(1).count() == 0:
            out.passed += 1
        elif c.severity == "warn":
            out.warned.append(c.name)
        else:
            out.failed.append(c.name)
    if stop and out.failed:
        raise GateFailed(str(out))
    return out


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n_null`` of the columns that have nulls, from one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    tall = counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns))).alias("x"))
    return tall.select("x.*").filter("n_null > 0")


def missing_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    lost = sorted(set(columns) - set(df.columns))
    return df.sparkSession.createDataFrame([(c,) for c in lost], "column_name string")


def stale(df: DataFrame, ts: str, now: str, hours: int = 25) -> DataFrame:
    """One row if the newest time isn't within ``[now - hours, now]``; so no rows at all, and times to come, fail."""
    newest = df.agg(F.max(ts).alias("newest"))
    at = F.lit(now).cast("timestamp_ntz")
    return newest.filter(~F.coalesce(F.col("newest").between(at - F.expr(f"interval {hours} hours"), at), F.lit(False)))


def not_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(list(values))).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def duplicate_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys with several rows; null keys count as equal."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(fact: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the fact without a row in the dimension, and how many rows have them."""
    return fact.join(dimension.select(*keys), list(keys), "left_anti").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def implausible(changes: DataFrame, percent: float = 50.0) -> DataFrame:
    """Price changes beyond a percentage."""
    return changes.filter(F.col("field").isin("lowest_sell", "highest_buy") & (F.abs("pct_change") > percent))


def volume_decreases(obs: DataFrame, keys: Sequence[str], ts: str = "observed_at") -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(ts, "volume")
    return obs.filter("volume is not null").withColumn("previous_volume", F.lag("volume").over(order)).filter("volume < previous_volume")


def unparsed_zero_decimal(obs: DataFrame, codes: Sequence[int] = (8, 10, 18)) -> DataFrame:
    """Prices in a currency without decimals that didn't parse."""
    return obs.filter(F.col("currency").isin(list(codes)) & F.col("lowest_sell").isNull())


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either frame that the other lacks, duplicates counted."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def empty(df: DataFrame) -> DataFrame:
    """One row if the frame has none."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("n")).filter("n = 0")


def bronze_checks(bronze: DataFrame, now: str) -> list[Check]:
    columns = ("source", "endpoint", "app_id", "observed_at", "request_params", "raw_payload", "ingest_id", "currency")
    required = [c for c in columns if c not in ("currency", "request_params") and c in bronze.columns]
    checks = [Check("columns_exist", "block", missing_columns(bronze, columns))]
    checks.append(Check("not_empty", "block", empty(bronze)))
    checks.append(Check("not_null", "block", not_null(bronze, required)))
    if "observed_at" in bronze.columns:
        checks.append(Check("fresh", "block", stale(bronze.withColumn("observed_at", utc(F.col("observed_at").cast("string"))), "observed_at", now)))
    return checks
