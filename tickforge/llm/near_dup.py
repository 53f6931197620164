r"""Near-duplicate documents by circulant MinHash, confirmed on full shingle sets.

A document is the set of its distinct word shingles.  Two permutations of the shingle universe make all signature coordinates: the first
scatters the shingles, the second is applied after a circular shift by the coordinate's number, and each coordinate is the
minimum.  Coordinates are banded; documents that agree in a band are candidates; candidates are linked if the exact
Jaccard similarity of their full sets reaches the threshold; linked documents form components.

Copies and near copies come in large groups, so pairs of a group are never all formed as rows:

* documents with equal sets are one class from the start, whose representative alone takes part;
* buckets give a graph of candidates with one edge for each member, to the bucket's smallest one; the members of a connected part of that graph
  meet in one task, each set sent once, and every pair that could reach the threshold is compared there; only links
  leave the task;
* a part with more than ``PART`` shingles is not gathered.  There every bucket first compares its members with its smallest one, and then members that
  are still in different components within tiles of bounded size, one pair of tiles in a task; only links leave a task.

So no link that the bands offer is lost, whatever the size of a group.  With 180 coordinates in bands of 5, a pair at a similarity of 0.85
escapes all bands with a chance of 7e-10 (0.8: 6e-7).

Defined results: null text, and text without words, has an empty set and is linked with nothing; a document of fewer words than a shingle has one
shingle, its whole sequence; rows with the same id are the same document; a row with a null id is in no
component (null) and kept; ids may be of any type that has an order; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import arrow_batches, fresh, materialize
from .wordstream import BLANK, distinct_per_doc, hash_words, mix, slices, windows

COORDINATES, ROWS = 180, 5
#: Shingles of a part that one task may gather, and of a tile; rows of a table that may be broadcast (16 bytes each).
PART, TILE, SMALL = 2 << 20, 1 << 20, 500_000
_U = np.uint64


def circulant_minhash(shingles: np.ndarray, first: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """Signatures (documents by coordinates) of non-empty sets of 64-bit shingle hashes."""
    # First permutation: the well-mixed hash places a shingle in the universe of 2**32.
    at = (shingles >> _U(32)).astype(np.uint32)
    out = np.empty((len(first) - 1, k), np.uint32)
    v, w = np.empty_like(at), np.empty_like(at)
    for c in range(k):
        # Second permutation of the place, shifted circularly by the coordinate.
        np.subtract(at, np.uint32(c), out=v)
        for shift, odd in ((16, 0x7FEB352D), (15, 0x846CA68B)):
            np.right_shift(v, np.uint32(shift), out=w)
            np.bitwise_xor(v, w, out=v)
            np.multiply(v, np.uint32(odd), out=v)
        np.right_shift(v, np.uint32(16), out=w)
        np.bitwise_xor(v, w, out=v)
        out[:, c] = np.minimum.reduceat(v, first[:-1])
    return out


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket key for each band."""
    n, k = signatures.shape
    parts = signatures.reshape(n, k // rows, rows).astype(_U)
    key = np.broadcast_to(np.arange(k // rows, dtype=_U), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their offsets."""
    w = hash_words(texts, BLANK)
    return distinct_per_doc(*windows(w.hashes, w.first, width))


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``id, n, f1, f2, bands`` of rows ``id, text``: size, 128-bit fingerprint and bucket keys of each set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, first = shingle_sets(part.column("text"), width)
                n = np.diff(first)
                full = np.flatnonzero(n)
                f = np.zeros((2, len(n)), _U)
                bands = np.zeros((len(n), COORDINATES // ROWS), _U)
                if len(full):
                    starts = first[full]
                    f[0, full] = np.add.reduceat(mix(sets), starts)
                    f[1, full] = np.add.reduceat(mix(sets ^ _U(0x5851F42D4C957F2D)), starts)
                    bands[full] = band_keys(circulant_minhash(sets, np.append(starts, len(sets))))
                width_b = bands.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * width_b, pa.int32()), pa.array(bands.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), pa.array(f[0].view(np.int64)), pa.array(f[1].view(np.int64)), lists], names=["id", "n", "f1", "f2", "bands"]
                )

    return docs.mapInArrow(sketch, f"id {_kind(docs, 'id')}, n long, f1 long, f2 long, bands array<long>")


def _linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A forest of links: pairs of places in ``sets`` whose Jaccard similarity reaches ``percent``, enough to join all
    that the links join.

    A set is compared with all others at once, by counting over the lists of the sets that hold its shingles.  A set that is in
    the largest component so far is passed over, so a group of near copies costs little more than its exceptions.  As another
    component may become the largest later, sets passed over are compared in the end until all that never were lie in one
    component: a link between two of those joins nothing.  Memory is in proportion to the sets, and so is the work beside the shared shingles: a comparison touches only sets
    that share one, and of two components that join the smaller one gets the other's label.
    """
    n = np.array([len(x) for x in sets], np.int64)
    m = len(n)
    _, code, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m, dtype=np.int32), n)
    keep = df[code] >= 2  # others are in no intersection
    code, owner = code[keep], owner[keep]
    by_code = np.argsort(code, kind="stable")
    listed = owner[by_code]
    begin = np.concatenate([[0], np.cumsum(np.where(df >= 2, df, 0))])
    first = np.searchsorted(owner, np.arange(m + 1))
    label, compared = np.arange(m), np.zeros(m, bool)
    members: dict[int, list[int]] = {}  # of components of several sets
    top, top_size = -1, 1
    links: list[tuple[int, int]] = []

    def compare(i: int) -> None:
        nonlocal top, top_size
        compared[i] = True
        own = code[first[i] : first[i + 1]]
        many = begin[own + 1] - begin[own]
        at = np.repeat(begin[own] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        if len(at) < m:
            near, both = np.unique(listed[at], return_counts=True)
        else:
            both = np.bincount(listed[at], minlength=m)
            near = np.flatnonzero(both)
            both = both[near]
        hit = near[100 * both >= percent * (n[near] + n[i] - both)]
        one_each = hit[np.unique(label[hit], return_index=True)[1]]
        for j in one_each.tolist():
            mine, other = int(label[i]), int(label[j])
            if other != mine:
                links.append((i, j))
                a, b = members.pop(mine, [mine]), members.pop(other, [other])
                if len(a) < len(b):
                    a, b, mine = b, a, other
                label[b] = mine
                a.extend(b)
                members[mine] = a
                if len(a) > top_size:
                    top, top_size = mine, len(a)

    compare(int(np.argmax(np.bincount(owner, weights=df[code], minlength=m))))
    for i in range(m):
        if label[i] != top:
            compare(i)
    rest = np.flatnonzero(~compared)
    if len(rest):
        stay = rest[np.argmax(np.bincount(label[rest])[label[rest]])]
        for i in rest.tolist():
            if label[i] != label[stay]:
                compare(i)
    return links


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list]]:
    """Consecutive rows with equal keys, over the borders of batches: ``(key, [(rep, set)])``."""
    last, rows = None, []
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        reps, sets = batch.column("rep").to_pylist(), batch.column("set")
        for i, key in enumerate(zip(*columns, strict=True)):
            if key != last:
                if rows:
                    yield last, rows
                last, rows = key, []
            rows.append((reps[i], sets[i].values.to_numpy()))
    if rows:
        yield last, rows


def _sets(docs: DataFrame, wanted: DataFrame, width: int, keep: str) -> DataFrame:
    """``rep, set, <keep>`` for the documents that ``wanted`` (``rep``, ``keep``) names."""
    few = wanted.limit(SMALL + 1).count() <= SMALL
    rows = docs.join(F.broadcast(wanted) if few else wanted, docs["id"] == wanted["rep"]).select("rep", "text", keep)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, first = shingle_sets(part.column("text"), width)
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("rep"), lists, part.column(keep)], names=["rep", "set", keep])

    return rows.mapInArrow(build, f"rep {_kind(wanted, 'rep')}, set array<long>, {keep} {_kind(wanted, keep)}").filter(F.size("set") > 0)


def _to_lead(sets: list[np.ndarray], percent: int, lead: int) -> list[tuple[int, int]]:
    """Links of all sets with one of them."""
    own, out = sets[lead], []
    for i, x in enumerate(sets):
        if i != lead and 100 * min(len(x), len(own)) >= percent * max(len(x), len(own)):
            both = len(np.intersect1d(x, own, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(own) - both):
                out.append((i, lead))
    return out


def _join_parts(sets: DataFrame, keys: tuple[str, ...], percent: int, parts: int, to_lead: bool = False) -> DataFrame:
    """Links ``u, v`` within the groups of ``keys`` of rows ``rep, set``; ``to_lead``: only those with the set that the first key names."""
    schema = f"u {_kind(sets, 'rep')}, v {_kind(sets, 'rep')}"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v, kind = [], [], None

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field("rep").type
                yield b

        for key, rows in _groups(seen(), keys):
            found = [s for _, s in rows]
            lead = next((i for i, (r, _) in enumerate(rows) if r == key[0]), None) if to_lead else None
            links = [] if len(rows) < 2 or to_lead and lead is None else _to_lead(found, percent, lead) if to_lead else _linked(found, percent)
            for i, j in links:
                u.append(rows[i][0])
                v.append(rows[j][0])
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.array(u, kind), pa.array(v, kind)], names=["u", "v"])

    dealt = sets.repartition(parts, *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, schema)


def _large_parts(docs: DataFrame, entries: DataFrame, members: DataFrame, width: int, percent: int, parts: int) -> DataFrame:
    """Links ``u, v`` in the parts that no task may gather."""
    inside = materialize(entries.join(members.select("rep"), "rep", "left_semi"), "entries")
    sets = materialize(_sets(docs, members.select("rep", "part"), width, "part").select("rep", "set"), "sets")
    lead = inside.groupBy("key").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("size"))
    near = inside.join(lead.filter("size > 1"), "key").filter("rep <> lead").select("rep", "lead", "n").distinct()
    # The members of a leader are dealt to tiles, and the leader's set goes once to each.
    size = near.groupBy("lead").agg(F.ceil(F.sum("n") / F.lit(TILE)).alias("g"))
    mine = near.join(size, "lead").select("lead", F.pmod(F.xxhash64("rep"), F.col("g")).alias("t"), "rep")
    own = size.select("lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("t"), F.col("lead").alias("rep"))
    links = materialize(_join_parts(mine.unionByName(own).join(sets, "rep"), ("lead", "t"), percent, parts, to_lead=True), "links")
    # What a bucket's smallest member doesn't join is compared in tiles.
    label = connected_components(links)
    open_ = inside.join(label, inside["rep"] == label["node"], "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("label"))
    left = open_.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("total")).filter("size > 2 and lo < hi")
    tiles = open_.join(left, "key").withColumn("g", F.ceil(F.col("total") / F.lit(TILE))).withColumn("t", F.pmod(F.xxhash64("rep"), F.col("g")))
    tiles = tiles.select("key", "rep", F.col("t"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("o"))
    tiles = tiles.select("key", "rep", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"))
    return links.unionByName(_join_parts(tiles.join(sets, "rep"), ("key", "i", "j"), percent, parts))


def components_of(docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` of each row of ``docs``.

    ``width``: words of a shingle; ``percent``: least Jaccard similarity of a link, as a whole number of hundredths.
    ``component_id`` is the smallest id that links reach.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = materialize(sketches(rows, width), "sketch")
    classes = sketch.filter("n > 0 and id is not null").groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes, "classes")
    entries = classes.select("rep", "n", F.explode("bands").alias("key"))
    lead = entries.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).filter("lead < last")
    shared = materialize(entries.join(lead, "key").select("key", "rep", "n", "lead"), "buckets")
    part_of = connected_components(shared.filter("rep <> lead").select(F.col("rep").alias("u"), F.col("lead").alias("v")).distinct())
    sizes = shared.groupBy("rep").agg(F.first("n").alias("n"))
    part_of = materialize(part_of.join(sizes, part_of["node"] == sizes["rep"]).select("rep", "n", F.col("component").alias("part")), "parts")
    large = part_of.groupBy("part").agg(F.sum("n").alias("total")).filter(F.col("total") > PART)
    small = part_of.join(large, "part", "left_anti").select("rep", "part")
    links = _join_parts(_sets(rows, small, width, "part"), ("part",), percent, parts)
    if large.limit(1).count():
        links = links.unionByName(_large_parts(rows, shared.select("key", "rep", "n"), part_of.join(large, "part", "left_semi"), width, percent, parts))
    found = connected_components(links)
    copies = classes.filter("copies > 1").select("f1", "f2", "rep")
    out = sketch.select("id", "n", "f1", "f2").join(copies, ["f1", "f2"], "left").select("id", "n", F.when(F.col("n") > 0, F.coalesce("rep", "id")).otherwise(F.col("id")).alias("rep"))
    out = out.join(found, out["rep"] == found["node"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay if one document of each component does: the one with the smallest id."""
    name = fresh(docs, "gone")
    gone = components_of(docs, width, percent, id_col, text_col).filter(~F.col("kept")).select(F.col(id_col).alias(name)).distinct()
    few = (gone := materialize(gone, "gone")).limit(SMALL + 1).count() <= SMALL
    return docs.join(F.broadcast(gone) if few else gone, F.col(id_col) == F.col(name), "left_anti")
