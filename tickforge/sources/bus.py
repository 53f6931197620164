"""A message bus as a Spark data source: an append-only log of key and value in a folder that driver and executors mount.

``spark.read``, ``spark.readStream``, ``write`` and ``writeStream`` use it by the name ``tickbus`` after ``register(spark)``; the option ``path`` names the
topic.  Tasks write segments (Arrow files, one for each partition of the topic that they have rows for), which nobody sees until the driver publishes them all
with one commit record: the second phase.  Records are numbered without gaps and made by an exclusive link, so two writers never take the same number; a stream's
offset is the number of the last record that it has read, and the rows of a topic's partition have offsets of their own.

A streaming writer names itself (option ``producer``).  A record keeps the last batch of every producer, so a batch that is written again after a
restart is recognised and not published twice.  Segments of failed tasks or batches are never in a record, so never read.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

MESSAGE = "key string, value string, partition int, offset bigint"
_KEYED = pa.schema([("key", pa.string()), ("value", pa.string())])
_ARROW = pa.schema([*_KEYED, ("partition", pa.int32()), ("offset", pa.int64())])
#: Rows of a batch in a segment.
ROWS = 4096


class Topic:
    """The records and segments of one topic."""

    def __init__(self, path: str) -> None:
        if path.startswith("file:"):
            path = "/" + path.removeprefix("file:").lstrip("/")
        if "://" in path:
            raise ValueError(f"a topic is a mounted folder, not {path}")
        self.records, self.segments = f"{path}/records", f"{path}/segments"

    def last(self) -> int:
        """The number of the newest record, 0 if there is none."""
        try:
            return max((int(x.name) for x in os.scandir(self.records) if x.name.isdigit()), default=0)
        except FileNotFoundError:
            return 0

    def record(self, number: int) -> dict:
        if not number:
            return {"ends": {}, "producers": {}, "segments": []}
        with open(f"{self.records}/{number:020d}") as f:
            return json.load(f)

    def publish(self, segments: list[dict], producer: str | None = None, batch: int | None = None) -> int | None:
        """Make segments part of the topic, all at once; None if this producer's batch already is."""
        os.makedirs(self.records, exist_ok=True)
        while True:
            number = self.last()
            now = self.record(number)
            if producer is not None and now["producers"].get(producer, -1) >= batch:
                return None
            ends = dict(now["ends"])
            placed = []
            for s in sorted(segments, key=lambda s: (s["partition"], s["file"])):
                first = ends.get(str(s["partition"]), 0)
                placed.append(s | {"first": first})
                ends[str(s["partition"])] = first + s["rows"]
            producers = now["producers"] | ({} if producer is None else {producer: batch})
            draft = f"{self.records}/draft-{uuid.uuid4().hex}"
            with open(draft, "w") as f:
                json.dump({"ends": ends, "producers": producers, "segments": placed}, f)
            try:
                os.link(draft, f"{self.records}/{number + 1:020d}")  # fails if another writer was faster
                return number + 1
            except FileExistsError:
                continue
            finally:
                os.unlink(draft)

    def drop(self, segments: list[dict]) -> None:
        for s in segments:
            try:
                os.unlink(f"{self.segments}/{s['file']}")
            except FileNotFoundError:
                pass


@dataclass
class Segment(InputPartition):
    file: str
    partition: int
    first: int


@dataclass
class Written(WriterCommitMessage):
    segments: list


class _Reading:
    def __init__(self, options: dict) -> None:
        self.topic = Topic(options["path"])

    def segments(self, after: int, upto: int) -> list[Segment]:
        return [Segment(s["file"], s["partition"], s["first"]) for n in range(after + 1, upto + 1) for s in self.topic.record(n)["segments"]]

    def read(self, partition: Segment | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a topic without segments
            return
        at = partition.first
        with pa.OSFile(f"{self.topic.segments}/{partition.file}") as source, pa.ipc.open_file(source) as f:
            for i in range(f.num_record_batches):
                b = f.get_batch(i)
                n = b.num_rows
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([partition.partition] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())], schema=_ARROW)
                at += n


class BusReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Segment]:
        return self.segments(0, self.topic.last())


class BusStreamReader(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802 - names of the interface
        return {"record": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"record": self.topic.last()}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return self.segments(start["record"], end["record"])

    def commit(self, end: dict) -> None:
        pass


class _Writing:
    def __init__(self, options: dict) -> None:
        self.topic, self.partitions, self.producer = Topic(options["path"]), int(options.get("partitions", "4")), options.get("producer")

    def write(self, iterator) -> Written:
        """Segments of one task, from Arrow batches as Spark hands them on or from rows; equal keys go to one partition, in the order of their rows."""
        os.makedirs(self.topic.segments, exist_ok=True)
        task, files, rows = uuid.uuid4().hex, {}, {}
        try:
            for batch in self._batches(iterator):
                held = self._partitions(batch["key"])
                for p in np.unique(held).tolist():
                    if p not in files:
                        sink = pa.OSFile(f"{self.topic.segments}/{task}-{p}", "wb")
                        files[p] = sink, pa.ipc.new_file(sink, _KEYED)
                    some = batch.filter(pa.array(held == p))
                    files[p][1].write_batch(some)
                    rows[p] = rows.get(p, 0) + some.num_rows
        finally:
            for sink, f in files.values():
                f.close()
                sink.close()
        return Written([{"partition": p, "file": f"{task}-{p}", "rows": rows[p]} for p in files])

    @staticmethod
    def _batches(iterator) -> Iterator[pa.RecordBatch]:
        """``key, value`` in batches of bounded size."""
        for first in iterator:
            if isinstance(first, pa.RecordBatch):
                for at in range(0, first.num_rows, ROWS):
                    yield first.slice(at, ROWS).select(["key", "value"]).cast(_KEYED)
            else:
                some = [first, *islice(iterator, ROWS - 1)]
                yield pa.RecordBatch.from_pydict({c: [r[c] for r in some] for c in ("key", "value")}, schema=_KEYED)

    def _partitions(self, keys: pa.Array) -> np.ndarray:
        """The partition of each key, found once for each distinct one."""
        found = keys.dictionary_encode(null_encoding="encode")
        numbers = np.array([zlib.crc32((k or "").encode()) % self.partitions for k in found.dictionary.to_pylist()], dtype="int32")
        return numbers[found.indices.to_numpy()]

    @staticmethod
    def all_of(messages: list[Written | None]) -> list[dict]:
        return [s for m in messages if m is not None for s in m.segments]


class BusWriter(_Writing, DataSourceArrowWriter):
    def commit(self, messages: list[Written | None]) -> None:
        self.topic.publish(self.all_of(messages))

    def abort(self, messages: list[Written | None]) -> None:
        self.topic.drop(self.all_of(messages))


class BusStreamWriter(_Writing, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        written = self.all_of(messages)
        if self.topic.publish(written, self.producer, batchId) is None:
            self.topic.drop(written)

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        self.topic.drop(self.all_of(messages))


class Bus(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tickbus"

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema) -> BusReader:
        return BusReader(self.options)

    def streamReader(self, schema) -> BusStreamReader:  # noqa: N802
        return BusStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> BusWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return BusWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> BusStreamWriter:  # noqa: N802
        if not self.options.get("producer"):
            raise ValueError("a streaming writer needs the option producer, by which its batches are recognised")
        return BusStreamWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Bus)


def publish(messages: DataFrame, path: str, partitions: int = 4) -> None:
    """Append ``key, value`` rows to a topic, all at once."""
    register(messages.sparkSession)
    messages.select("key", "value").write.format("tickbus").option("path", path).option("partitions", partitions).mode("append").save()


def subscribe(spark: SparkSession, path: str) -> DataFrame:
    """A topic as a stream of ``key, value, partition, offset``, from its beginning."""
    register(spark)
    return spark.readStream.format("tickbus").option("path", path).load()


def replay(spark: SparkSession, path: str) -> DataFrame:
    """All that a topic holds now."""
    register(spark)
    return spark.read.format("tickbus").option("path", path).load()


def send(stream: DataFrame, path: str, checkpoint: str, producer: str, every: str | None = "30 seconds", partitions: int = 4) -> StreamingQuery:
    """A stream of ``key, value`` into a topic; ``every`` None takes what is there and stops."""
    register(stream.sparkSession)
    writer = stream.select("key", "value").writeStream.format("tickbus").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.option("producer", producer).option("partitions", partitions).outputMode("append")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
