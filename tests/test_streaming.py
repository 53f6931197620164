"""Stateful change detection: expiry, hot items, restarts and repeated deliveries."""

import random

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.test_operators import at, events, follow, obs, random_rows
from tickforge.plans import queries
from tickforge.streaming import change_stream
from tickforge.streaming.change_stream import ChangeDetector, detect_changes_stream, drop_redelivered


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Held:
    """A list of the store that knows how many rows were read from it at once."""

    def __init__(self):
        self.rows = []

    def appendList(self, rows):  # noqa: N802
        self.rows.extend(rows)

    def get(self):
        return iter(self.rows)

    def clear(self):
        self.rows = []


class Handle:
    def __init__(self):
        self.timers, self.values, self.lists = [], Value(), Held()

    def getValueState(self, name, schema, ttl=None):  # noqa: N802
        return self.values

    def getListState(self, name, schema, ttl=None):  # noqa: N802
        return self.lists

    def registerTimer(self, ms):  # noqa: N802
        self.timers.append(ms)


def frames(rows, size):
    columns = ["market_hash_name", "observed_at", "lowest_sell", "highest_buy", "sell_listings", "volume", "currency", "source_endpoint"]
    df = pd.DataFrame([(i, at(m), *rest) for i, m, *rest in rows], columns=columns)
    df["money_domain"] = [f"currency:{int(c)}" if pd.notna(c) else f"endpoint:{e}" for c, e in zip(df["currency"], df["source_endpoint"], strict=True)]
    return [df.iloc[a : a + size] for a in range(0, len(df), size)]


def test_a_hot_item_is_followed_in_bounded_frames(monkeypatch):
    rng = random.Random(6)
    rows = [("hot", m, *r[2:]) for m, r in zip(rng.sample(range(5000), 900), random_rows(900, 6), strict=True)]
    rows += [("hot", 6000, *r[2:]) for r in random_rows(30, 7)][:1]
    sizes, plain = [], change_stream.compare
    monkeypatch.setattr(change_stream, "compare", lambda part, *rest: (sizes.append(len(part)), plain(part, *rest))[1])
    handle, detector = Handle(), ChangeDetector(change_stream.WATCHED, "keep", None, None, chunk=100)
    detector.init(handle)
    got = pd.concat(list(detector.handleInputRows((730, "hot"), iter(frames(rows, 70)), None)))
    assert sorted(zip(got["market_hash_name"], got["field"], got["previous"], got["current"], got["observed_at"].dt.to_pydatetime(), strict=True)) == follow(rows)
    assert max(sizes) <= 100 and sum(sizes) == len(rows)
    assert handle.lists.rows == []


@pytest.mark.parametrize(("chunk", "framed"), [(50_000, False), (20, True)])
def test_few_rows_of_an_item_are_followed_without_frames(monkeypatch, chunk, framed):
    """Frames of pandas took 40 ms for an item, whatever its rows; only hot items need them."""
    made, plain = [], change_stream.compare
    rows = [("a", m, *r[2:]) for m, r in zip(random.Random(8).sample(range(5000), 300), random_rows(300, 8), strict=True)]
    sent = [[Row(**r) for r in f.astype(object).where(f.notna(), None).to_dict("records")] for f in frames(sorted(rows, key=lambda r: r[1]), 100)]
    monkeypatch.setattr(change_stream, "compare", lambda part, *rest: (made.append(len(part)), plain(part, *rest))[1])
    handle, detector = Handle(), change_stream.ChangeFollower(change_stream.WATCHED, "keep", None, None, chunk=chunk)
    detector.init(handle)
    got = [e for part in sent for e in detector.handleInputRows((730, "a"), iter([Row(**r.asDict() | {"observed_at": r["observed_at"].to_pydatetime()}) for r in part]), None)]
    assert sorted((e["market_hash_name"], e["field"], e["previous"], e["current"], e["observed_at"]) for e in got) == follow(rows)
    assert all(e["pct_change"] == (e["current"] - e["previous"]) / e["previous"] * 100 if e["previous"] else e["pct_change"] is None for e in got)
    assert bool(made) == framed and max(made, default=0) <= chunk and handle.lists.rows == []


def test_frames_and_rows_give_the_same(spark, tmp_path):
    rows = sorted(random_rows(200, 21), key=lambda r: r[1])
    parts = [obs(spark, rows[:90]), obs(spark, rows[90:])]
    framed = written(spark, str(tmp_path / "frames"), parts, lambda s: detect_changes_stream(s, late="drop", frames=True))
    plain = written(spark, str(tmp_path / "rows"), parts, lambda s: detect_changes_stream(s, late="drop"))
    assert events(framed) == events(plain) == follow(rows)
    assert plain.exceptAll(framed).count() == 0


@pytest.mark.parametrize("chunk", [50_000, 60])
def test_items_of_a_bucket_are_followed_together(monkeypatch, chunk):
    """What is known of a bucket's items is one value of the store, read and written once in a micro-batch, however many items have rows."""
    rng, asked = random.Random(9), []
    rows = [(f"i{rng.randrange(40)}", *r[1:]) for r in random_rows(400, 9)]
    rows = [(r[0], m, *r[2:]) for m, r in zip(sorted(rng.sample(range(9000), 400)), rows, strict=True)]
    handle, follower = Handle(), change_stream.BucketFollower(["app_id", "market_hash_name"], change_stream.WATCHED, "keep", chunk=chunk)
    for name in ("get", "update"):
        monkeypatch.setattr(handle.values, name, lambda *a, plain=getattr(handle.values, name), name=name: (asked.append(name), plain(*a))[1])
    sizes, plain = [], change_stream.compare_items
    monkeypatch.setattr(change_stream, "compare_items", lambda part, *rest: (sizes.append(len(part)), plain(part, *rest))[1])
    follower.init(handle)
    out = []
    for batch in (rows[:150], rows[150:]):
        sent = frames(rng.sample(batch, len(batch)), 70)
        sent[0] = pd.concat([sent[0], sent[0].assign(observed_at=pd.NaT)])
        out += follower.handleInputRows((1,), iter([f.assign(app_id=730) for f in sent]), None)
    got = pd.concat(out)
    assert sorted(zip(got["market_hash_name"], got["field"], got["previous"], got["current"], got["observed_at"].dt.to_pydatetime(), strict=True)) == follow(rows)
    assert asked == ["get", "update"] * 2 and max(sizes) <= max(chunk, 70) and sum(sizes) == 400 and handle.lists.rows == []


@pytest.mark.parametrize("options", [{}, {"late": "drop"}, {"strict_domain": True}, {"fields": ("volume", "lowest_sell")}, {"chunk": 9}])
def test_buckets_and_rows_give_the_same(spark, tmp_path, options):
    rows = random_rows(200, 23)
    rows = [(None if k % 17 == 0 else r[0], *r[1:]) for k, r in enumerate(rows)]
    parts = [obs(spark, rows[:90]).withColumn("app_id", F.expr("nullif(cast(lowest_sell % 2 as int), 1)")), obs(spark, rows[90:]).withColumn("app_id", F.lit(0))]
    parts[1] = parts[1].unionByName(parts[1].limit(3).withColumn("observed_at", F.lit(None).cast("timestamp_ntz")))
    together = written(spark, str(tmp_path / "buckets"), parts, lambda s: detect_changes_stream(s, buckets=3, **options))
    alone = written(spark, str(tmp_path / "rows"), parts, lambda s: detect_changes_stream(s, **options))
    assert together.count() == alone.count() > 0
    assert together.exceptAll(alone).count() == 0
    with pytest.raises(ValueError, match="bucket"):
        detect_changes_stream(parts[0], buckets=3, ttl="1 hour")


@pytest.mark.parametrize("name", ["change_events_bus", "change_events_stream"])
def test_registered_streams_follow_buckets(spark, monkeypatch, name):
    class Seen(Exception):
        pass

    def seen(stream, buckets=None):
        raise Seen(buckets)

    monkeypatch.setattr(change_stream, "detect_changes_stream", seen)
    with pytest.raises(Seen) as e:
        queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert e.value.args[0] >= 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_rows_of_one_time_stay_together():
    handle, detector = Handle(), ChangeDetector(change_stream.WATCHED, "keep", None, None, chunk=3)
    detector.init(handle)
    rows = [("a", 5, k, None, None, None, 1, "orderbook") for k in range(10)] + [("a", 6, 50, None, None, None, 1, "orderbook")]
    got = pd.concat(list(detector.handleInputRows((730, "a"), iter(frames(rows, 4)), None)))
    assert got["current"].tolist() == [*map(float, range(1, 10)), 50.0]


def written(spark, path, parts, make):
    """Each part is one file, read in one micro-batch of one run; the stream is started anew for every part."""
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{path}/in/{k:03d}")
        stream = spark.readStream.schema(part.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        done = make(stream).writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
        done.awaitTermination()
        assert done.exception() is None
    return spark.read.parquet(f"{path}/out")


def stored(spark, path):
    names = spark.read.format("statestore").option("stateVarName", "known").load(f"{path}/state")
    return {r["item"] for r in names.select(F.col("key.market_hash_name").alias("item")).collect()}


def test_idle_items_leave_the_store_by_the_watermark(spark, tmp_path):
    row = lambda item, m, v: (item, m, v, None, None, None, 1, "priceoverview")
    parts = [
        obs(spark, [row("idle", 0, 100), row("busy", 0, 100)]),
        obs(spark, [row("busy", 100, 110), row("idle2", 100, 7)]),
        obs(spark, [row("busy", 200, 120)]),
        obs(spark, [row("busy", 210, 125), row("idle", 210, 999)]),
    ]
    got = written(spark, str(tmp_path), parts, lambda s: detect_changes_stream(s, idle="1 hour", watermark="10 minutes"))
    # "idle" came back after it was forgotten: 999 is its first value, not a change from 100.
    assert [e[:1] + e[2:4] for e in events(got)] == [("busy", 100.0, 110.0), ("busy", 110.0, 120.0), ("busy", 120.0, 125.0)]
    assert stored(spark, tmp_path) == {"busy", "idle"}
    timers = spark.read.format("statestore").option("readRegisteredTimers", True).load(f"{tmp_path}/state")
    assert timers.count() == 2


def test_idle_items_leave_the_store_by_the_clock(spark, tmp_path):
    row = lambda item, m, v: (item, m, v, None, None, None, 1, "priceoverview")
    parts = [obs(spark, [row("a", 0, 1)]), obs(spark, [row("a", 1, 2)])]
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    short = written(spark, str(tmp_path / "short"), parts, lambda s: detect_changes_stream(s, ttl="1 millisecond"))
    assert short.count() == 0
    long = written(spark, str(tmp_path / "long"), parts, lambda s: detect_changes_stream(s, ttl="1 hour"))
    assert [e[2:4] for e in events(long)] == [(1.0, 2.0)]
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    with pytest.raises(ValueError, match="both"):
        detect_changes_stream(obs(spark, []), ttl="1 hour", idle="1 hour")


def test_long_lists_over_restarts_equal_the_rules(spark, tmp_path):
    rows = sorted(random_rows(150, 12), key=lambda r: r[1])
    parts = [obs(spark, rows[:80]), obs(spark, rows[80:])]
    got = written(spark, str(tmp_path), parts, lambda s: detect_changes_stream(s, chunk=9))
    assert events(got) == follow(rows)
    assert spark.read.format("statestore").option("stateVarName", "held").load(f"{tmp_path}/state").count() == 0


def test_repeated_deliveries_give_one_event(spark, tmp_path):
    schema = "ingest_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in obs(spark, []).schema.fields)
    sent = lambda ids, rows: spark.createDataFrame([(i, *r) for i, r in zip(ids, obs(spark, rows).collect(), strict=True)], schema)
    row = lambda m, v: ("a", m, v, None, None, None, 1, "priceoverview")
    parts = [sent(["x", "y"], [row(0, 1), row(1, 2)]), sent(["y", "x", "z"], [row(1, 2), row(0, 1), row(2, 1)])]
    once = written(spark, str(tmp_path / "once"), parts, lambda s: detect_changes_stream(drop_redelivered(s)))
    assert [e[2:4] for e in events(once)] == [(1.0, 2.0), (2.0, 1.0)]
    # Without it, the delivery that came again is followed again.
    again = written(spark, str(tmp_path / "again"), parts, lambda s: detect_changes_stream(s))
    assert len(events(again)) > 2
