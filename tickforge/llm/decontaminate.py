r"""Benchmark decontamination with a distributed positional inverted index.

The training documents are indexed once: each task turns its documents into shards of at most ``SHARD`` words, a shard being
its distinct terms with the ascending positions at which each stands, and the documents' borders.  The index is a table in the
shared folder.  Test items are searched in blocks of bounded size against all shards: for each window of an item the lists of its terms are intersected
after each is shifted by the term's place in the window, beginning with the two rarest terms of that shard.  What remains is an exact
phrase.  A window of which at least ``NEAR`` percent of the terms stand within ``SLOP`` words of their place, all in one document, is a proximity match: an
altered copy.  As so many terms must be there, one of the rarest few is, and their lists give the places to try.

A pass over the index shuffles nothing; only when the test items need several passes are a document's matches grouped.  Items of equal words are
searched once, and so are equal windows of a block; an item of more than ``CUT`` windows is cut into overlapping pieces; a block of items and pieces, ``BLOCK`` words in all on
average, goes to the tasks at once.  A task tries about ``PIECE`` places at a time, whatever repeats in items and documents.  Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z; a
window is ``WINDOW`` words, or all words of a shorter item.

Defined results: null or empty texts have no words; an item without words has no window; items with the same id count once; rows with
the same id are separate documents; a null id stays null; other columns are ignored; without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import arrow_batches, materialize
from .wordstream import ALNUM, hash_words, slices

WINDOW, SHARD, SLOP, NEAR = 10, 1 << 19, 10, 80
#: Words of test items that go to the tasks at once, about; more items are searched in more passes.
BLOCK = 1 << 18
#: Windows of a long item that stand in one block; candidate places that a task tries at once.
CUT, PIECE = 1 << 16, 1 << 20
_U = np.uint64

#: Numbers are little-endian bytes, which pass through Spark and Parquet unopened: int32 but for the terms' 64 bits.
INDEX = "ids array<{id}>, first binary, terms binary, ends binary, positions binary"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: one row per shard."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType

    def shard(ids: list, hashes: list, counts: list) -> pa.RecordBatch:
        h = np.concatenate(hashes) if hashes else np.zeros(0, _U)
        order = np.argsort(h, kind="stable")
        s = h[order]
        ends = np.flatnonzero(np.concatenate([s[1:] != s[:-1], [True]])) + 1 if len(s) else np.zeros(0, int)
        first = np.concatenate([[0], np.cumsum(counts)])
        ids = pa.concat_arrays(ids)
        packed = [pa.array([np.ascontiguousarray(x, dtype).tobytes()], pa.binary()) for x, dtype in ((first, "<i4"), (s[ends - 1], "<u8"), (ends, "<i4"), (order, "<i4"))]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *packed], names=["ids", "first", "terms", "ends", "positions"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, counts, size = [], [], [], 0
        for batch in batches:
            for part in slices(batch):
                w = hash_words(part.column("text"), ALNUM)
                if size and size + len(w.hashes) > SHARD:
                    yield shard(ids, hashes, counts)
                    ids, hashes, counts, size = [], [], [], 0
                ids.append(part.column("id"))
                hashes.append(w.hashes)
                counts.extend(w.counts.tolist())
                size += len(w.hashes)
        if ids:
            yield shard(ids, hashes, counts)

    index = rows.mapInArrow(build, INDEX.format(id=kind.simpleString()))
    return materialize(index.withColumn("shard", F.monotonically_increasing_id()), "postings", large_rows=True)


def item_words(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item, words array<long>, n``: the hashed words of each item that has any."""
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = hash_words(part.column("text"), ALNUM)
                lists = pa.ListArray.from_arrays(pa.array(w.first, pa.int32()), pa.array(w.hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("item"), lists, pa.array(w.counts, pa.int64())], names=["item", "words", "n"])

    return rows.mapInArrow(words, "item string, words array<long>, n long").filter(F.col("n") > 0)


def item_windows(rows: list, width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(windows, first, items)`` for each length of window: distinct windows as a matrix of term hashes; ``items[first[w]:first[w + 1]]`` are the items that have window ``w``."""
    by: dict[int, tuple[list, list]] = {}
    for i, r in enumerate(rows):
        w = np.array(r["words"], np.int64).view(_U)
        k = min(width, len(w))
        m, at = by.setdefault(k, ([], []))
        m.append(np.lib.stride_tricks.sliding_window_view(w, k))
        at.append(np.full(len(w) - k + 1, i))
    out = []
    for m, at in by.values():
        windows, which = np.unique(np.concatenate(m), axis=0, return_inverse=True)
        pairs = np.unique(which.reshape(-1).astype(np.int64) * len(rows) + np.concatenate(at))
        out.append((windows, np.searchsorted(pairs // len(rows), np.arange(len(windows) + 1)), pairs % len(rows)))
    return out


def _pieces(terms: np.ndarray, ends: np.ndarray, wins: np.ndarray, misses: int) -> Iterator[np.ndarray]:
    """Windows in parts whose candidate places, the lists of the rarest ``misses + 1`` terms, number about ``PIECE``; a window with more stands alone."""
    if len(terms):
        rarest = np.sort(_places(terms, ends, wins)[3], axis=1)
        tried = np.where((rarest == 0).sum(axis=1) <= misses, rarest[:, : misses + 1].sum(axis=1), 0)
        live = np.flatnonzero(tried)
        part = np.cumsum(tried[live]) // PIECE
        for x in np.split(live, np.flatnonzero(part[1:] != part[:-1]) + 1):
            if len(x):
                yield x


def _items_at(docs: np.ndarray, wins: np.ndarray, first: np.ndarray, items: np.ndarray, n_items: int) -> np.ndarray:
    """Distinct ``doc * n_items + item`` for the windows found in documents."""
    width = len(first)
    pairs = np.unique(docs.astype(np.int64) * width + wins)
    d, w = pairs // width, pairs % width
    many = first[w + 1] - first[w]
    at = np.repeat(first[w] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
    return np.unique(np.repeat(d, many) * n_items + items[at])


def _places(terms: np.ndarray, ends: np.ndarray, wins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each term of each window: is it in the shard, its place in ``terms``, where its list begins, how long that is."""
    at = np.minimum(np.searchsorted(terms, wins), len(terms) - 1)
    there = terms[at] == wins
    begin = np.where(at > 0, ends[at - 1], 0)
    return there, at, begin, np.where(there, ends[at] - begin, 0)


def _starts(key: np.ndarray, begin: np.ndarray, size: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(window, start)`` for each posting of one term (its number in the window) of each window."""
    row = np.arange(len(term))
    n = size[row, term]
    win = np.repeat(row, n)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return win, (key[begin[row, term][win] + inner] & 0xFFFFFFFF) - term[win]


def _find(terms: np.ndarray, ends: np.ndarray, key: np.ndarray, wins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(window, start)`` of exact phrases in one shard.

    ``key`` is ascending: a term's place in ``terms`` times 2**32, plus a position.
    """
    if not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    there, at, begin, size = _places(terms, ends, wins)
    live = np.flatnonzero(there.all(axis=1))
    at, begin, size = at[live], begin[live], size[live]
    rank = np.argsort(size, axis=1, kind="stable")
    win, start = _starts(key, begin, size, rank[:, 0])
    for r in range(1, wins.shape[1]):
        j = rank[win, r]
        want = (at[win, j].astype(np.int64) << 32) + start + j
        same = key[np.minimum(np.searchsorted(key, want), len(key) - 1)] == want
        win, start = win[same], start[same]
    return live[win], start


def _find_near(terms: np.ndarray, ends: np.ndarray, key: np.ndarray, first: np.ndarray, wins: np.ndarray, slop: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """``(window, document)`` of proximity matches, exact ones among them."""
    k = wins.shape[1]
    misses = k - -(-k * percent // 100)
    if not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    there, at, begin, size = _places(terms, ends, wins)
    live = np.flatnonzero((~there).sum(axis=1) <= misses)
    there, at, begin, size = there[live], at[live], begin[live], size[live]
    rank = np.argsort(size, axis=1, kind="stable")
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for anchor in range(misses + 1):
        term = rank[:, anchor]
        win, start = _starts(key, begin, size, term)
        doc = np.searchsorted(first, start + term[win], "right") - 1
        missed = np.zeros(len(win), np.int64)
        for r in range(k):
            j = rank[win, r]
            low, high = first[doc], first[doc + 1]
            place = np.clip(start + j, low, high)
            base = at[win, j].astype(np.int64) << 32
            i = np.searchsorted(key, base + place)
            up = key[np.minimum(i, len(key) - 1)] - base
            down = key[np.maximum(i - 1, 0)] - base
            # Other terms are 2**32 away.
            close = (up >= place) & (up < high) & (up - start - j <= slop) | (down < place) & (down >= low) & (start + j - down <= slop)
            missed += ~(close & there[win, j])
            keep = missed <= misses
            win, start, doc, missed = win[keep], start[keep], doc[keep], missed[keep]
        found.append((live[win], doc))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _search(batches: Iterator[pa.RecordBatch], groups: list, names: list[list[str]], slop: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            ids = batch.column(0)[r].values
            first, terms, ends, positions = (np.frombuffer(batch.column(c)[r].as_buffer(), dtype) for c, dtype in enumerate(("<i4", "<u8", "<i4", "<i4"), 1))
            first, ends = first.astype(np.int64), ends.astype(np.int64)
            lengths = np.diff(np.concatenate([[0], ends]))
            key = (np.repeat(np.arange(len(terms), dtype=np.int64), lengths) << 32) + positions
            hit = np.zeros(int(first[-1]) + 1, np.int64)
            found, near = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for wins, first_item, items in groups:
                k = wins.shape[1]
                for part in _pieces(terms, ends, wins, k - -(-k * percent // 100)):
                    w, s = _find(terms, ends, key, wins[part])
                    d = np.searchsorted(first, s, "right") - 1
                    inside = (s >= 0) & (s + k <= first[np.minimum(d + 1, len(first) - 1)])  # a phrase never spans two documents
                    w, s, d = w[inside], s[inside], d[inside]
                    np.add.at(hit, s, 1)
                    np.add.at(hit, s + k, -1)
                    found.append(_items_at(d, part[w], first_item, items, len(names)))
                    w, d = _find_near(terms, ends, key, first, wins[part], slop, percent)
                    near.append(_items_at(d, part[w], first_item, items, len(names)))
            found = np.unique(np.concatenate(found))
            near = np.setdiff1d(np.concatenate(near), found)
            covered = np.concatenate([[False], np.cumsum(hit[:-1]) > 0, [False]])
            # A run that reaches the end of a document stops there.
            begins = np.flatnonzero(covered[1:-1] & (~covered[:-2] | np.isin(np.arange(len(covered) - 2), first)))
            stops = np.flatnonzero(covered[1:-1] & (~covered[2:] | np.isin(np.arange(1, len(covered) - 1), first))) + 1
            of = np.searchsorted(first, begins, "right") - 1
            runs: list[list] = [[] for _ in range(len(first) - 1)]
            for d, a, b in zip(of.tolist(), (begins - first[of]).tolist(), (stops - first[of]).tolist(), strict=True):
                runs[d].append({"a": a, "b": b})
            lists: tuple[list, list] = ([set() for _ in runs], [set() for _ in runs])
            for to, pairs in zip(lists, (found, near), strict=True):
                for x in pairs.tolist():
                    to[x // len(names)].update(names[x % len(names)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(batch.column("shard")[r], len(runs)),
                    pa.array(np.arange(len(runs)), pa.int32()),
                    ids,
                    pa.array(np.diff(first)),
                    pa.array(runs, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                    *(pa.array([sorted(x) for x in one], pa.list_(pa.string())) for one in lists),
                ],
                names=["shard", "place", "id", "n_words", "runs", "items", "near_items"],
            )


def search(index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = WINDOW, slop: int = SLOP, percent: int = NEAR, id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_words, n_hit, items array<string>, near_items array<string>`` of every indexed document.

    Items are searched in blocks of about ``BLOCK`` words, one pass over the index for each.
    """
    spark = index.sparkSession
    kind = index.schema["ids"].dataType.elementType.simpleString()
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - width, F.lit(0)), F.lit(CUT).cast("long"))).alias("a")
    cut = item_words(items, item_col, text_col).select("item", "words", pieces).select("item", F.slice("words", F.col("a").cast("int") + 1, F.lit(CUT + width - 1)).alias("words"))
    sized = cut.withColumn("n", F.size("words")).groupBy("words", "n").agg(F.array_sort(F.collect_set(F.coalesce("item", F.lit("")))).alias("names"))
    sized = materialize(sized, "items")
    # Items of different words are dealt to blocks by hash; names count as words.
    total = sized.agg(F.coalesce(F.sum(F.col("n") + F.size("names")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-total // BLOCK))
    schema = f"shard long, place int, id {kind}, n_words long, runs array<struct<a:int,b:int>>, items array<string>, near_items array<string>"
    found = None
    for b in range(n_blocks):
        rows = sized.filter(F.pmod(F.xxhash64("words"), F.lit(n_blocks)) == b).collect()  # about BLOCK words
        block = spark.sparkContext.broadcast((item_windows(rows, width), [r["names"] for r in rows]))

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            return _search(batches, *block.value, slop, percent)

        one = index.mapInArrow(run, schema)
        found = one if found is None else found.unionByName(one)
    if n_blocks > 1:
        union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        found = found.groupBy("shard", "place").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), union("runs"), union("items"), union("near_items"))
    hit = F.aggregate(
        "runs",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["b"]).alias("end"), (acc["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(acc["end"], x["a"])).cast("long")).alias("n")
        ),
    )["n"]
    return found.select(F.col("id").alias(id_col), "n_words", hit.alias("n_hit"), "items", "near_items")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The digest of matches of every document."""
    found = search(build_index(docs, id_col, text_col), items, item_col, item_text, id_col=id_col)
    return found.select(
        id_col,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )
