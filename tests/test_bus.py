import os
import threading
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceArrowWriter, DataSourceStreamArrowWriter
from pyspark.sql.group import GroupedData

from tests.test_operators import events, follow, obs, random_rows
from tickforge.schemas import OBSERVATION
from tickforge.sources import bus, lake
from tickforge.streaming import change_stream


def rows(df):
    return sorted((r["key"], r["value"]) for r in df.collect())


def make(spark, pairs):
    return spark.createDataFrame(pairs, "key string, value string")


def test_batches_are_appended_with_offsets_without_gaps(spark, tmp_path):
    path = str(tmp_path / "topic")
    assert bus.replay(spark, path).count() == 0
    first = [(f"k{i % 7}", f"a{i}") for i in range(40)] + [(None, "no key"), ("empty", None)]
    bus.publish(make(spark, first).repartition(3), path)
    bus.publish(make(spark, [("k1", "later")]), f"file://{path}")
    assert rows(bus.replay(spark, path).na.fill("-")) == sorted((k or "-", v or "-") for k, v in [*first, ("k1", "later")])
    places: dict = {}
    for r in bus.replay(spark, path).collect():
        places.setdefault(r["partition"], []).append(r["offset"])
    assert all(sorted(v) == list(range(len(v))) for v in places.values()) and len(places) > 1
    by_key = {}
    for r in bus.replay(spark, path).collect():
        assert by_key.setdefault(r["key"], r["partition"]) == r["partition"]


def test_streams_restart_without_loss_or_repeats(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run():
        q = bus.send(bus.subscribe(spark, source), target, state, "copy", every=None)
        q.awaitTermination(60)
        assert q.exception() is None

    sent = []
    for k in range(3):
        part = [(f"k{i}", f"{k}-{i}") for i in range(5)]
        sent += part
        bus.publish(make(spark, part), source)
        run()
    assert rows(bus.replay(spark, target)) == sorted(sent)
    run()  # nothing new
    # A crash after publishing, before Spark noted the batch: it is run again and recognised.
    newest = max(int(x) for x in os.listdir(f"{state}/commits") if x.isdigit())
    os.unlink(f"{state}/commits/{newest}")
    for hidden in os.listdir(f"{state}/commits"):
        if hidden == f".{newest}.crc":
            os.unlink(f"{state}/commits/{hidden}")
    run()
    assert rows(bus.replay(spark, target)) == sorted(sent)


def test_writers_never_take_the_same_number(tmp_path):
    topic = bus.Topic(str(tmp_path))
    threads = [threading.Thread(target=lambda t=t: [topic.publish([{"partition": 0, "file": f"{t}-{k}", "rows": 2}], f"p{t}", k) for k in range(20)]) for t in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    records = [topic.record(n) for n in range(1, topic.last() + 1)]
    assert len(records) == 80
    assert [r["segments"][0]["first"] for r in records] == list(range(0, 160, 2))
    assert records[-1]["producers"] == {f"p{t}": 19 for t in range(4)}
    assert topic.publish([], "p0", 19) is None


def test_unpublished_segments_are_never_read(spark, tmp_path):
    path = str(tmp_path / "topic")
    bus.publish(make(spark, [("a", "1")]), path)
    writer = bus.BusWriter({"path": path})
    lost = writer.write(iter([{"key": "b", "value": "2"}]))
    assert rows(bus.replay(spark, path)) == [("a", "1")]
    writer.abort([lost, None])
    assert len(os.listdir(f"{path}/segments")) == 1
    with pytest.raises(Exception, match="mounted"):
        bus.Topic("s3://bucket/topic")
    with pytest.raises(Exception, match="producer"):
        bus.Bus({"path": path}).streamWriter(None, False)


def test_a_topic_is_followed_without_a_frame_for_every_item(spark, tmp_path, monkeypatch):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    rows = sorted(random_rows(120, 31), key=lambda r: r[1])
    monkeypatch.setattr(GroupedData, "transformWithStateInPandas", lambda *a, **k: pytest.fail("frames"))
    for part in (rows[:70], rows[70:]):
        df = obs(spark, part)
        bus.publish(df.select(F.col("market_hash_name").alias("key"), F.to_json(F.struct(*df.columns), lake.JSON_TIMES).alias("value")), source)
        heard = bus.subscribe(spark, source).select(F.from_json("value", OBSERVATION, lake.JSON_TIMES).alias("o")).select("o.*")
        q = bus.send(lake.to_messages(change_stream.detect_changes_stream(heard)), target, state, "changes", every=None)
        q.awaitTermination()
        assert q.exception() is None
    got = bus.replay(spark, target).select(F.from_json("value", change_stream.CHANGE, lake.JSON_TIMES).alias("c")).select("c.*")
    assert events(got) == follow(rows)


def test_writers_take_arrow_batches(spark, tmp_path, monkeypatch):
    """Rows one by one took most of a writer's time; batches fall to the same partitions in the same order, whatever their size."""
    assert isinstance(bus.Bus({"path": "x"}).writer(None, False), DataSourceArrowWriter)
    assert isinstance(bus.Bus({"path": "x", "producer": "p"}).streamWriter(None, False), DataSourceStreamArrowWriter)
    monkeypatch.setattr(bus, "ROWS", 7)
    pairs = [(f"k{i % 5}" if i % 11 else None, f"{i}" if i % 6 else None) for i in range(60)] + [("", "empty"), ("ключ", "é")]
    keys, values = map(list, zip(*pairs, strict=True))
    batch = pa.RecordBatch.from_pydict({"value": pa.array(values, pa.large_string()), "key": pa.array(keys, pa.large_string())})
    held = []
    for name, sent in (("rows", [{"key": k, "value": v} for k, v in pairs]), ("batches", [batch.slice(0, 40), batch.slice(40), batch.slice(0, 0)])):
        path = str(tmp_path / name)
        writer = bus.BusWriter({"path": path})
        writer.commit([writer.write(iter(sent)), writer.write(iter([]))])
        held.append(sorted(tuple(r) for r in bus.replay(spark, path).select("partition", "offset", F.coalesce("key", F.lit("-")), F.coalesce("value", F.lit("-"))).collect()))
    assert held[0] == held[1] and len(held[0]) == 62
    assert {(p, k) for p, _, k, _ in held[0]} == {(zlib.crc32(("" if k is None else k).encode()) % 4, "-" if k is None else k) for k, _ in pairs}
