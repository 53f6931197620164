"""Words of Arrow string batches as arrays of 64-bit hashes.

``hash_words`` lower-cases A-Z, splits the UTF-8 bytes at separator bytes and hashes each word, for a whole batch at once.  A word's
length and its first eight bytes are mixed by a bijection of 64 bits, then each further eight bytes are taken in and mixed again; words of over
``LONG`` bytes get a BLAKE2b digest instead.  Equal words always agree.  Two words of one length up to eight bytes never do; other pairs agree with a chance of
2**-64, whatever their structure (there is no sum or power that shifted or repeated parts could cancel in), unless somebody makes them on purpose.
So among ``n`` distinct words ``n * n / 2**65`` pairs are expected to agree: 3e-8 for a million, 0.03 for a billion.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
#: Words of more bytes are hashed one by one.
LONG = 256


def _separators(*spans: tuple[int, int]) -> np.ndarray:
    word = np.ones(256, dtype=bool)
    for a, b in spans:
        word[a : b + 1] = False
    return word


#: Word bytes of `[^\x20\x09-\x0D]+` and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing).
BLANK = _separators((0x20, 0x20), (0x09, 0x0D))
ALNUM = _separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEEP = np.arange(256, dtype=np.uint8)

_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with good avalanche."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


@dataclass
class Words:
    """``hashes[first[d]:first[d+1]]`` are the words of document ``d``; ``start``/``end`` give their
    bytes in ``data``."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words ``data[start:end]``."""
    size = end - start
    raw = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", raw, strides=(1,))  # the eight bytes that begin at each place
    h = mix(size.astype(_U) * _U(0x9E3779B97F4A7C15) + (eight[start] & _MASK[np.minimum(size, 8)]))
    more = np.flatnonzero(size > 8)
    for at in range(8, LONG, 8):
        if not len(more):
            break
        h[more] = mix(h[more] ^ (eight[start[more] + at] & _MASK[np.minimum(size[more] - at, 8)]))
        more = more[size[more] > at + 8]
    for i in np.flatnonzero(size > LONG).tolist():
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def hash_words(texts: pa.Array, word: np.ndarray = BLANK, fold: np.ndarray = LOWER) -> Words:
    raw, off = text_bytes(texts)
    data = fold[raw]
    inside = word[data]
    begins = off[:-1][off[:-1] < len(data)]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    edge[begins] = inside[begins]
    start = np.flatnonzero(edge)
    edge = inside.copy()
    edge[:-1] &= ~inside[1:]
    stops = off[1:] - 1
    stops = stops[stops >= 0]
    edge[stops] = inside[stops]
    end = np.flatnonzero(edge) + 1
    h = _hash(data, start, end) if len(start) else np.zeros(0, np.uint64)
    return Words(h, np.searchsorted(start, off), start, end, data)


def slices(batch: pa.RecordBatch, column: str = "text", size: int = 2 << 20, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text and at most ``rows`` rows; a longer document stands alone."""
    raw = text_bytes(batch.column(column))[1]
    at = 0
    while at < batch.num_rows:
        to = min(at + rows, max(at + 1, int(np.searchsorted(raw, raw[at] + size, "right")) - 1))
        yield batch.slice(at, to - at)
        at = to


def _step(acc: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (acc ^ (acc >> _U(29))) * _U(0xC2B2AE3D27D4EB4F) + h


def windows(h: np.ndarray, first: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, and the offsets of each document's runs.  With ``short`` a document of
    fewer words, but not none, has one run: all its words."""
    n = np.diff(first)
    runs = np.maximum(n - k + 1, 0)
    few = np.flatnonzero((n > 0) & (n < k)) if short else np.zeros(0, np.int64)
    runs[few] = 1
    out_first = np.concatenate([[0], np.cumsum(runs)]).astype(np.int64)
    out = np.empty(out_first[-1], np.uint64)
    if len(h) >= k:
        acc = h[: len(h) - k + 1].copy()
        for i in range(1, k):
            acc = _step(acc, h[i : len(h) - k + 1 + i])
        whole = np.repeat(n >= k, runs)
        at = np.repeat(first[:-1] - out_first[:-1], runs) + np.arange(len(out))
        out[whole] = mix(acc)[at[whole]]
    if len(few):
        acc = h[first[few]]
        for i in range(1, k - 1):
            live = np.flatnonzero(n[few] > i)
            acc[live] = _step(acc[live], h[first[few[live]] + i])
        out[out_first[few]] = mix(acc ^ n[few].astype(_U))
    return out, out_first


def distinct_per_doc(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document, and their offsets."""
    out = np.empty_like(values)
    size = 0
    counts = np.zeros(len(first), np.int64)
    for d, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True), 1):
        v = np.sort(values[a:b])
        if len(v) > 1:
            v = v[np.concatenate([[True], v[1:] != v[:-1]])]
        out[size : size + len(v)] = v
        size += len(v)
        counts[d] = size
    return out[:size].copy(), counts
