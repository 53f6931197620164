"""Token counts of whole texts with a subword tokenizer, without shuffling pre-tokens.

A map-side lookup in two tiers.  The tokenizer's pre-tokens never cross ASCII white space, so a text's count
is the sum over its white-space separated pieces.  Tier one is a hash table of the lengths of the most frequent
pieces, of a fixed number of entries and so of a proven size, broadcast to all tasks.  Tier two is a bounded cache in each Python
worker: pieces missing from the table are encoded once per worker by the tokenizer itself.

The frequent pieces come from one pass over all texts: each task keeps a bounded summary of its commonest
short pieces, and only the summaries are shuffled and meet, a fixed number of entries for each task.  The table decides speed, never results.

Defined results: null and empty text have 0 bytes and 0 tokens; a null id stays null; rows that repeat are counted
each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import arrow_batches
from .wordstream import BLANK, KEEP, Words, hash_words, slices, text_bytes

#: Entries of the broadcast table; pieces in each task's summary; entries of each worker's cache.
TABLE, SUMMARY, CACHE = 1 << 16, 1 << 12, 400_000
#: Bytes of a piece that may be in the table; so what the driver gets is bounded too.
LONGEST = 64

_tokenizers: dict = {}
_cache: dict[str, dict[int, int]] = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _tokenizers[path] = t
    return _tokenizers[path]


def _lengths(path: str, pieces: list[str]) -> list[int]:
    return [len(e) for e in _tokenizer(path).encode_batch_fast(pieces, add_special_tokens=False)]


class LengthTable:
    """Open-addressed table from a piece's hash to its number of tokens, as two plain arrays."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(len(hashes), 1) * 2))))
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        self.probes = 1
        for h, n in zip(hashes.tolist(), lengths.tolist(), strict=True):
            at, k = h & int(self.mask), 1
            while self.values[at] >= 0:
                at, k = (at + 1) & int(self.mask), k + 1
            self.keys[at], self.values[at] = h, n
            self.probes = max(self.probes, k)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Lengths, -1 where absent."""
        at = h & self.mask
        out = np.where(self.keys[at] == h, self.values[at], -1)
        rest = np.flatnonzero((out < 0) & (self.values[at] >= 0))
        for _ in range(1, self.probes):
            if not len(rest):
                break
            slot = (at[rest] + np.uint64(1)) & self.mask
            at[rest] = slot
            hit = self.keys[slot] == h[rest]
            out[rest[hit]] = self.values[slot[hit]]
            rest = rest[~hit & (self.values[slot] >= 0)]
        return out


def _piece(w: Words, i: int) -> str:
    return w.data[w.start[i] : w.end[i]].tobytes().decode("utf-8", "surrogatepass")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The commonest pieces of one task, from counts that are cut back whenever they outgrow a bound."""
    counts: dict[int, list] = {}
    for batch in batches:
        for part in slices(batch):
            w = hash_words(part.column("text"), BLANK, KEEP)
            h, at, n = np.unique(w.hashes, return_index=True, return_counts=True)
            short = w.end[at] - w.start[at] <= LONGEST
            h, at, n = h[short], at[short], n[short]
            top = np.argsort(-n, kind="stable")[: 4 * SUMMARY]
            for x, i, k in zip(h[top].tolist(), at[top].tolist(), n[top].tolist(), strict=True):
                if x in counts:
                    counts[x][1] += k
                else:
                    counts[x] = [_piece(w, i), k]
            if len(counts) > 16 * SUMMARY:
                counts = dict(sorted(counts.items(), key=lambda c: -c[1][1])[: 4 * SUMMARY])
    best = sorted(counts.values(), key=lambda c: (-c[1], c[0]))[:SUMMARY]
    yield pa.RecordBatch.from_pydict(
        {"piece": pa.array([b[0] for b in best], pa.string()), "n": pa.array([b[1] for b in best], pa.int64())}
    )


def frequent_pieces(texts: DataFrame, size: int = TABLE) -> list[str]:
    """At most ``size`` frequent pieces of the column ``text``."""
    found = (
        texts.select("text")
        .mapInArrow(_summaries, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(size)
    )
    return [r["piece"] for r in found.collect()]


def token_counts(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    ``tokenizer`` is the path of a ``tokenizers`` JSON file, present on every machine.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    pieces = frequent_pieces(rows)
    if pieces:
        w = hash_words(pa.array(pieces, pa.string()), BLANK, KEEP)
        table = LengthTable(w.hashes, np.array(_lengths(tokenizer, pieces)))
    else:
        table = LengthTable(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    shared = spark.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        cache = _cache.setdefault(tokenizer, {})
        for batch in batches:
            for part in slices(batch):
                w = hash_words(part.column("text"), BLANK, KEEP)
                n = frequent.find(w.hashes).astype(np.int64)
                missing = np.flatnonzero(n < 0)
                if len(missing):
                    keys, at, back = np.unique(w.hashes[missing], return_index=True, return_inverse=True)
                    known = [cache.get(k, -1) for k in keys.tolist()]
                    lengths = np.array(known, np.int64)
                    new = np.flatnonzero(lengths < 0)
                    if len(new):
                        lengths[new] = _lengths(tokenizer, [_piece(w, missing[i]) for i in at[new].tolist()])
                        if len(cache) + len(new) > CACHE:
                            cache.clear()
                        cache.update(zip(keys[new].tolist(), lengths[new].tolist(), strict=True))
                    n[missing] = lengths[back]
                total = np.concatenate([[0], np.cumsum(n)])
                tokens = total[w.first[1:]] - total[w.first[:-1]]
                size = np.diff(text_bytes(part.column("text"))[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                    names=["id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
