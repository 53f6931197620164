"""Keyed change detection over a stream, with the rules of the batch form.

State lives in RocksDB: for each item one value, what is known of it, and a list that holds rows only while a micro-batch with many rows of the item is worked
on.  Idle items leave the store, by wall-clock time to live or by timers on the watermark.  Many items may be followed together, a bucket of them at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime, timedelta
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schemas import CHANGE, WATCHED

KNOWN = "lowest_sell bigint, highest_buy bigint, sell_listings bigint, volume bigint, newest bigint, money_domain string, timer boolean"
HELD = "at bigint, lowest_sell bigint, highest_buy bigint, sell_listings bigint, volume bigint, source_endpoint string, money_domain string"
#: A bucket's rows, and what is known of each of its items: one list for each column, equally long.
ITEM_HELD = f"{HELD}, app_id int, market_hash_name string"
ITEM_KNOWN = "lowest_sell array<bigint>, highest_buy array<bigint>, sell_listings array<bigint>, volume array<bigint>, newest array<bigint>, domain array<string>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of one item that are sorted in memory at once, and parts into which a stretch of time with more is cut.
CHUNK, PARTS = 50_000, 64
ORDER = ["at", "source_endpoint", "money_domain", *WATCHED]
TAKEN = ["observed_at", *ORDER[1:]]
EVENT = Row(*(c.split()[0] for c in CHANGE.split(", ")))
EPOCH, MICRO = datetime(1970, 1, 1), timedelta(microseconds=1)


def compare(rows: pd.DataFrame, known: dict, domain: str | None, fields: Sequence[str]) -> tuple[pd.DataFrame, str | None]:
    """Change events ``at, field, previous, current, delta, pct_change`` of an item's sorted rows; updates ``known``."""
    own = rows["money_domain"].astype(object).where(rows["money_domain"].notna(), None)
    last = own.shift(1).astype(object)
    last.iloc[0] = domain
    same = (own == last) | (own.isna() & last.isna())
    found = []
    for f in fields:
        value = rows[f].dropna().astype("float64")
        if value.empty:
            continue
        before = value.shift(1)
        before.iloc[0] = float("nan") if known[f] is None else known[f]
        hit = value.index[same[value.index] & before.notna() & (before != value)]
        delta = value[hit] - before[hit]
        pct = (delta / before[hit].where(before[hit] != 0)) * 100
        found.append(pd.DataFrame({"at": rows.loc[hit, "at"], "field": f, "previous": before[hit], "current": value[hit], "delta": delta, "pct_change": pct}))
        known[f] = int(value.iloc[-1])
    found = [x for x in found if len(x)]
    return (pd.concat(found).sort_values("at", kind="stable") if found else pd.DataFrame()), own.iloc[-1]


def item_tuples(rows: pd.DataFrame, keys: Sequence[str]) -> list[tuple]:
    """The item of each row, as the store has it."""
    named = rows[list(keys)].astype({"app_id": "Int64"}).astype(object)
    return list(named.where(named.notna(), None).itertuples(index=False, name=None))


def compare_items(rows: pd.DataFrame, keys: Sequence[str], of: dict[tuple, list], fields: Sequence[str]) -> pd.DataFrame:
    """Change events of many items' rows, sorted by item and then as ``compare`` takes them; updates what is known ``of`` the items, the columns of ``ITEM_KNOWN``."""
    number = rows.groupby(list(keys), dropna=False, sort=False).ngroup().to_numpy()
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    items = item_tuples(rows.loc[starts], keys)
    known = [of.setdefault(i, [None] * 6) for i in items]
    own, domains = pd.factorize(rows["money_domain"])  # null is -1
    codes = {None: -1} | {d: i for i, d in enumerate(domains)}
    last = np.roll(own, 1)
    last[starts] = [codes.get(k[5], -2) for k in known]
    same, found = own == last, []
    for f in fields:
        value, place = rows[f].astype("float64").to_numpy(), WATCHED.index(f)
        at = np.flatnonzero(~np.isnan(value))
        if not len(at):
            continue
        value, item = value[at], number[at]
        head = np.diff(item, prepend=-1) != 0
        before = np.roll(value, 1)
        before[head] = [np.nan if known[i][place] is None else known[i][place] for i in item[head]]
        hit = same[at] & ~np.isnan(before) & (before != value)
        found.append(pd.DataFrame({"row": at[hit], "field": f, "previous": before[hit], "current": value[hit]}))
        tail = np.append(head[1:], True)
        for i, v in zip(item[tail].tolist(), value[tail].tolist(), strict=True):
            known[i][place] = int(v)
    ends = np.append(starts[1:], len(rows)) - 1
    for k, newest, domain in zip(known, rows["at"].to_numpy()[ends].tolist(), own[ends], strict=True):
        k[4:] = newest if k[4] is None else max(newest, k[4]), None if domain < 0 else domains[domain]
    out = pd.concat(found).sort_values("row", kind="stable", ignore_index=True) if found else pd.DataFrame({"row": [], "field": [], "previous": [], "current": []})
    at, delta = out["row"].to_numpy("int64"), out["current"] - out["previous"]
    return pd.DataFrame({
        "app_id": pd.array([items[i][0] for i in number[at]], "Int32"), "market_hash_name": [items[i][1] for i in number[at]], "field": out["field"], "previous": out["previous"],
        "current": out["current"], "delta": delta, "pct_change": (delta / out["previous"].where(out["previous"] != 0)) * 100, "observed_at": rows["at"].to_numpy()[at].astype("datetime64[us]"),
    })


class ChangeDetector(StatefulProcessor):
    """Follows one item.  Its rows of a micro-batch come in frames of bounded size.  If one frame holds them all they are sorted there; else they are put into
    the store's list and read back by stretches of time of ``chunk`` rows, so memory doesn't grow with an item's rows (those of one microsecond stay together)."""

    held_schema, order = HELD, ORDER

    def __init__(self, fields: Sequence[str], late: str, idle_ms: int | None, ttl_ms: int | None, chunk: int = CHUNK) -> None:
        self.fields, self.late, self.idle_ms, self.ttl_ms, self.chunk = tuple(fields), late, idle_ms, ttl_ms, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("known", KNOWN, self.ttl_ms)
        self.held = handle.getListState("held", self.held_schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - names of the interface
        known, newest, domain, timer = self._known()
        before = newest
        for part in self._in_order(self._frames(rows, newest if self.late == "drop" else None)):
            found, domain = compare(part, known, domain, self.fields)
            newest = max(int(part["at"].iloc[-1]), newest if newest is not None else int(part["at"].iloc[-1]))
            if len(found):
                yield self._events(key, found)
        self._keep(known, newest, domain, timer, before)

    def _known(self) -> tuple:
        *known, newest, domain, timer = self.state.get() or (None,) * 7
        return dict(zip(WATCHED, known, strict=True)), newest, domain, timer

    def _keep(self, known: dict, newest: int | None, domain: str | None, timer: bool | None, before: int | None) -> None:
        if newest is None:
            return
        if self.idle_ms is not None and not timer:
            self.handle.registerTimer(newest // 1000 + self.idle_ms)
            timer = True
        if newest != before or any(v is not None for v in known.values()):
            self.state.update((*(known[f] for f in WATCHED), newest, domain, bool(timer)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """The watermark has passed an item's newest row by the idle time, unless newer ones came: then the timer moves on."""
        if self.state.exists():
            *rest, newest, domain, _ = self.state.get()
            if newest // 1000 + self.idle_ms > expiredTimerInfo.getExpiryTimeInMs():
                self.handle.registerTimer(newest // 1000 + self.idle_ms)
                self.state.update((*rest, newest, domain, True))
            else:
                self.state.clear()
        yield from ()

    def close(self) -> None:
        pass

    def _frames(self, rows: Iterable[pd.DataFrame], since: int | None) -> Iterator[pd.DataFrame]:
        for frame in rows:
            frame = frame.assign(at=frame["observed_at"].astype("datetime64[us]").astype("int64"))
            if since is not None:
                frame = frame[frame["at"] >= since]
            if len(frame):
                yield frame[self.order]

    def _in_order(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows of all frames by time, in frames of bounded size."""
        first = list(islice(frames, 2))
        if len(first) == 1 and len(first[0]) <= self.chunk:
            yield first[0].sort_values(self.order, ignore_index=True)
        elif first:
            low, high = None, None
            names = [c.split()[0] for c in self.held_schema.split(", ")]
            for frame in chain(first, frames):
                low = int(frame["at"].min()) if low is None else min(low, int(frame["at"].min()))
                high = int(frame["at"].max()) if high is None else max(high, int(frame["at"].max()))
                plain = frame[names].astype(dict.fromkeys(WATCHED, "Int64")).astype(object)  # the store takes no floats for whole numbers
                self.held.appendList(list(plain.where(plain.notna(), None).itertuples(index=False, name=None)))
            for a, b in self._stretches(low, high + 1):
                part = pd.DataFrame([r for r in self.held.get() if a <= r[0] < b], columns=names)
                yield part.sort_values(self.order, ignore_index=True)
            self.held.clear()

    def _stretches(self, low: int, high: int) -> Iterator[tuple[int, int]]:
        """Stretches of time, one after the other, of ``chunk`` held rows at most (or of one microsecond)."""
        width = -(-(high - low) // PARTS)
        counts = [0] * PARTS
        for row in self.held.get():
            if low <= row[0] < high:
                counts[(row[0] - low) // width] += 1
        start, total = low, 0
        for i, n in enumerate(counts):
            at = low + i * width
            if total and total + n > self.chunk:
                yield start, at
                start, total = at, 0
            if n > self.chunk and width > 1:
                yield from self._stretches(at, min(at + width, high))
                start = at + width
            else:
                start, total = (at, n) if not total else (start, total + n)
        if total:
            yield start, high

    def _events(self, key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "app_id": key[0], "market_hash_name": key[1], "field": found["field"], "previous": found["previous"], "current": found["current"], "delta": found["delta"],
            "pct_change": found["pct_change"], "observed_at": found["at"].astype("datetime64[us]"),
        })


class ChangeFollower(ChangeDetector):
    """The same over plain rows.  Most items have few rows in a micro-batch; making frames of them took most of the time.  More than ``chunk`` rows go the way of frames."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = list(islice(rows, self.chunk + 1))
        if len(held) > self.chunk:
            for events in super().handleInputRows(key, self._as_frames(chain(held, rows)), timerValues):
                for *e, pct, at in events.itertuples(index=False, name=None):
                    yield EVENT(*e, None if pd.isna(pct) else pct, at.to_pydatetime())
            return
        known, newest, domain, timer = self._known()
        before = newest
        taken = [(at, (at - EPOCH) // MICRO, *rest) for at, *rest in self._taken(held)]
        if self.late == "drop" and newest is not None:
            taken = [r for r in taken if r[1] >= newest]
        taken.sort(key=lambda r: [(v is None, v) if v is not None else (True,) for v in r])
        for at, micros, _, own, *values in taken:
            same, domain = own == domain, own
            newest = micros if newest is None else max(newest, micros)
            current = dict(zip(WATCHED, values, strict=True))
            for f in self.fields:
                new, old = current[f], known[f]
                if new is None:
                    continue
                known[f] = new
                if same and old is not None and float(old) != float(new):
                    delta = float(new) - float(old)
                    yield EVENT(key[0], key[1], f, float(old), float(new), delta, delta / old * 100 if old else None, at)
        self._keep(known, newest, domain, timer, before)

    @staticmethod
    def _taken(rows: Iterable[Row]) -> Iterator[tuple]:
        places = None
        for r in rows:
            places = places or [r.__fields__.index(c) for c in TAKEN]
            yield tuple(r[i] for i in places)

    def _as_frames(self, rows: Iterable[Row]) -> Iterator[pd.DataFrame]:
        taken = self._taken(rows)
        while some := list(islice(taken, self.chunk)):
            yield pd.DataFrame(some, columns=TAKEN)


class BucketFollower(ChangeDetector):
    """Follows all items of a bucket together.  Frames hold the rows of many items and one value of the store what is known of them, so a call, a frame, a batch of events
    and a question to the store are paid by bucket.  More than ``chunk`` rows of a bucket go through the list as those of a hot item do."""

    held_schema = ITEM_HELD

    def __init__(self, keys: Sequence[str], fields: Sequence[str], late: str, chunk: int = CHUNK) -> None:
        super().__init__(fields, late, None, None, chunk)
        self.keys = tuple(keys)
        self.order = [*keys, *(c for c in ORDER if c not in keys)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        items = (f"{k} array<{'int' if k == 'app_id' else 'string'}>" for k in self.keys)
        self.state = handle.getValueState("known", ", ".join([*items, ITEM_KNOWN]), None)
        self.held = handle.getListState("held", self.held_schema, None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        columns, n = self.state.get() or (), len(self.keys)
        known = {item: list(rest) for item, rest in zip(zip(*columns[:n], strict=True), zip(*columns[n:], strict=True), strict=True)}
        newest = {item: k[4] for item, k in known.items()}
        for part in self._in_order(self._taken(rows, newest)):
            found = compare_items(part, self.keys, known, self.fields)
            if len(found):
                yield found
        if known:
            self.state.update(tuple([*map(list, zip(*known, strict=True)), *map(list, zip(*known.values(), strict=True))]))

    def _taken(self, rows: Iterable[pd.DataFrame], newest: dict[tuple, int]) -> Iterator[pd.DataFrame]:
        """Frames without rows that have no time or, if such are to be left out, that are older than their item's newest when the micro-batch began."""
        whole = (r[r["observed_at"].notna()].astype({"app_id": "Int64"}) for r in rows)  # the store takes no floats for whole numbers
        for frame in self._frames(whole, None):
            if self.late == "drop":
                frame = frame[[at >= newest.get(item, at) for item, at in zip(item_tuples(frame, self.keys), frame["at"], strict=True)]]  # noqa: PLW2901
            if len(frame):
                yield frame


def detect_changes_stream(
    obs: DataFrame,
    late: str = "keep",
    strict_domain: bool = False,
    fields: Sequence[str] = WATCHED,
    idle: str | None = None,
    watermark: str = "10 minutes",
    ttl: str | None = None,
    chunk: int = CHUNK,
    frames: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Change events of a stream of observations.

    The rows of an item in one micro-batch are taken in the order of their times.  ``late``: rows older than the item's newest are compared as they come
    (``keep``) or left out (``drop``).  ``idle``: an item is forgotten when the watermark (``watermark`` behind the newest row of all) has passed its newest row by so much;
    rows older than the watermark are then left out by Spark.  ``ttl``: an item is forgotten when it wasn't updated for so long by the clock; with a trigger
    that ends (``availableNow``) that needs ``spark.sql.streaming.noDataMicroBatches.enabled`` off, or Spark keeps waiting for the clock.  Rows without a time are left out.
    Rows come to Python one by one, which costs an item least, but PySpark then gathers an item's events of a micro-batch before it hands them on; with ``frames`` rows and
    events come and go in frames of bounded size, at many times the cost for items with few rows.  With ``buckets`` items are dealt into so many buckets by hash, and frames hold the rows of a whole bucket, in bounded size, which costs
    least where a micro-batch has many items.  What is known of a bucket's items is read and written whole when one of them has rows, so a bucket should have hundreds or some thousands of
    them; its rows needn't fit into memory.  The number belongs to the stream's checkpoint, as the state is kept by bucket.
    """
    if late not in ("keep", "drop"):
        raise ValueError(f"late must be keep or drop, not {late!r}")
    if idle and ttl:
        raise ValueError("state leaves by the watermark (idle) or by the clock (ttl), not by both")
    if buckets and (idle or ttl or frames):
        raise ValueError("items of a bucket don't leave one by one (idle, ttl) and have no frames of their own")
    spark = obs.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    millis = lambda span: None if span is None else pd.Timedelta(span) // pd.Timedelta(milliseconds=1)
    keys = ["app_id", "market_hash_name", *(["money_domain"] if strict_domain else [])]
    # Buckets leave rows without a time out themselves: pushed below the parsing of messages, the filter would parse each message once more.
    rows = (obs if buckets else obs.filter("observed_at is not null")).select("app_id", "market_hash_name", "observed_at", *WATCHED, "source_endpoint", "money_domain")
    if idle:
        rows = rows.withColumn("_t", F.col("observed_at").cast("timestamp")).withWatermark("_t", watermark)
    if buckets:
        dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).groupBy("_bucket")
        return dealt.transformWithStateInPandas(BucketFollower(keys, fields, late, chunk), CHANGE, "Append", "None")
    processor = (ChangeDetector if frames else ChangeFollower)(fields, late, millis(idle), millis(ttl), chunk)
    mode = "EventTime" if idle else "ProcessingTime" if ttl else "None"
    grouped = rows.groupBy(*keys)
    return (grouped.transformWithStateInPandas if frames else grouped.transformWithState)(processor, CHANGE, "Append", mode)


def drop_redelivered(stream: DataFrame, ts: str = "observed_at", within: str = "1 hour", id_col: str = "ingest_id") -> DataFrame:
    """A stream in which a message that is delivered again (same ``id_col``) comes once; ids are remembered for ``within`` of event time.

    Messages without an id or a time can't be told from others and are kept.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = stream.withColumn("_at", F.coalesce(F.col(ts).cast("timestamp"), F.timestamp_micros(F.lit(0)))).withWatermark("_at", within)
    once = timed.withColumn("_id", F.coalesce(id_col, F.uuid())).dropDuplicatesWithinWatermark(["_id"])
    return once.drop("_id", "_at")


def streaming_bars(obs: DataFrame, ts: str = "observed_at", watermark: str = "10 minutes") -> DataFrame:
    """Daily bars of a stream, final once the watermark passes the day."""
    order = F.struct(ts, "source_endpoint", "lowest_sell")
    timed = obs.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", watermark).filter("lowest_sell is not null")
    bars = timed.groupBy("app_id", "market_hash_name", "money_domain", F.window("_t", "1 day")).agg(
        F.min_by("lowest_sell", order).alias("open_price"),
        F.max("lowest_sell").alias("high_price"),
        F.min("lowest_sell").alias("low_price"),
        F.max_by("lowest_sell", order).alias("close_price"),
        F.count(F.lit(1)).alias("observation_count"),
    )
    return bars.withColumn("observation_date", F.to_date("window.start")).drop("window")
