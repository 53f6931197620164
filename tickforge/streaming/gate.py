"""Quality gates on a stream: violations are counted while a micro-batch is written, and a failed blocking check ends the query."""

from __future__ import annotations

import threading
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions.times import utc
from ..operators.quality import GateFailed, GateResult
from ..sources import lake


@dataclass
class Rule:
    """``violated`` is a boolean column; null counts as not violated.  ``severity``: ``block`` or ``warn``."""

    name: str
    severity: str
    violated: Column

    def count(self) -> Column:
        return F.count_if(F.coalesce(self.violated, F.lit(False))).alias(self.name)


def envelope_rules(required: Sequence[str] = ("source", "endpoint", "app_id", "observed_at", "raw_payload", "ingest_id")) -> list[Rule]:
    """The envelope's required fields, and times that can be read."""
    return [*(Rule(f"not_null_{c}", "block", F.col(c).isNull()) for c in required), Rule("readable_time", "block", F.col("observed_at").isNotNull() & utc(F.col("observed_at")).isNull())]


def counts(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates ``rows`` and one count of violations for each rule: for ``observe`` on a stream and ``agg`` on a table alike."""
    return [F.count(F.lit(1)).alias("rows"), *(r.count() for r in rules)]


def result_of(rules: Sequence[Rule], found: dict[str, int]) -> GateResult:
    out = GateResult(0, len(rules))
    for r in rules:
        if not found.get(r.name):
            out.passed += 1
        else:
            (out.warned if r.severity == "warn" else out.failed).append(r.name)
    return out


@dataclass
class StreamGate(StreamingQueryListener):
    """Takes the counts of each micro-batch of the queries that observe ``name``; adds them up in ``totals`` and stops a query whose batch fails.

    The counts are those of the pass that writes the batch; nothing is read twice.  The batch that fails is in the sink (it is what the counts tell of); nothing after it is.
    """

    name: str
    rules: Sequence[Rule]
    totals: dict[str, int] = field(default_factory=dict)
    batches: list[tuple[int, GateResult]] = field(default_factory=list)
    failed: GateResult | None = None

    def onQueryStarted(self, event) -> None:  # noqa: N802 - names of the interface
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = event.progress.observedMetrics.get(self.name)
        if row is None or not row["rows"]:
            return
        found = row.asDict()
        for k, v in found.items():
            self.totals[k] = self.totals.get(k, 0) + v
        result = result_of(self.rules, found)
        self.batches.append((event.progress.batchId, result))
        if not result.success and self.failed is None:
            self.failed = result
            query = self.spark.streams.get(str(event.progress.id))
            if query is not None:  # stopping waits for the query, which may wait for its listeners
                threading.Thread(target=query.stop, daemon=True).start()

    def raise_if_failed(self) -> None:
        if self.failed is not None:
            raise GateFailed(f"{self.name}: {self.failed}")


def gated(stream: DataFrame, gate: StreamGate) -> DataFrame:
    """The stream, with what the gate counts observed on the way."""
    return stream.observe(gate.name, *counts(gate.rules))


def land_gated(stream: DataFrame, path: str, checkpoint: str, partitions: Sequence[str], rules: Sequence[Rule] | None = None, name: str = "gate", every: str | None = "30 seconds") -> tuple[StreamingQuery, StreamGate]:
    """``lake.land`` behind a gate.  The caller waits for the query, then calls ``raise_if_failed``, and ``removeListener`` when done."""
    gate = StreamGate(name, envelope_rules() if rules is None else rules)
    stream.sparkSession.streams.addListener(gate)
    return lake.land(gated(stream, gate), path, checkpoint, partitions, every=every), gate
