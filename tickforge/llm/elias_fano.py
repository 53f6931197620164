"""Elias-Fano sequences over numpy arrays, made to lie in memory-mapped files.

A non-decreasing sequence of ``n`` numbers below ``u`` takes about ``2 + log2(u / n)`` bits each: low bits are packed, high
bits are gaps in unary.  All queries take whole arrays: ``get`` reads values by place, ``next_geq`` finds the first place whose
value isn't below a bound (the successor).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_U = np.uint64
_ONE = _U(1)


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of ``bits`` bits, one after another, as 64-bit words and one spare word."""
    out = np.zeros(len(values) * bits // 64 + 2, _U)
    step = 1 << 18  # a multiple of 64 numbers fills whole words
    for a in range(0, len(values) if bits else 0, step):
        v = values[a : a + step]
        at = np.arange(len(v)) * bits
        off = (at & 63).astype(_U)
        # Every word holds the first bit of some number; bits of different numbers never meet, so that sums join them.
        first = -(-np.arange(0, int(at[-1]) + 1, 64) // bits)
        base = a * bits // 64
        out[base : base + len(first)] |= np.add.reduceat(v << off, first)
        over = np.flatnonzero(off + _U(bits) > 64)
        out[base + (at[over] >> 6) + 1] |= v[over] >> (_U(64) - off[over])
    return out


def _unpack(words: np.ndarray, bits: int, i: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(i), _U)
    at = i.astype(np.int64) * bits
    w, off = at >> 6, (at & 63).astype(_U)
    low = words[w] >> off
    # A shift by 64 is undefined: two steps.
    high = (words[w + 1] << (_U(63) - off)) << _ONE
    return (low | high) & _U((1 << bits) - 1)


def _in_word(w: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the ``r``-th one (from 0) within each word: the byte by sums of bytes, the bit by a table."""
    sums = w - ((w >> _ONE) & _U(0x5555555555555555))
    sums = (sums & _U(0x3333333333333333)) + ((sums >> _U(2)) & _U(0x3333333333333333))
    sums = ((sums + (sums >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _U(_EACH)
    r = r.astype(_U)
    byte = np.bitwise_count((((r * _U(_EACH)) | _U(0x8080808080808080)) - sums) & _U(0x8080808080808080)).astype(_U) << _U(3)
    r -= ((sums << _U(8)) >> byte) & _U(255)
    return byte.astype(np.int64) + _BIT[(r << _U(8)) | ((w >> byte) & _U(255))]


def _table() -> np.ndarray:
    out = np.zeros((8, 256), np.int64)
    for v in range(256):
        for r, place in enumerate(i for i in range(8) if v >> i & 1):
            out[r, v] = place
    return out.reshape(-1)


_EACH, _BIT = 0x0101010101010101, _table()


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Place of the ``k``-th (from 0) one, or zero with ``flip``; ``before``: how many stand before each word."""
    word = np.searchsorted(before, k.astype(before.dtype), "right") - 1
    w = words[word]
    return word * 64 + _in_word(~w if flip else w, k - before[word])


@dataclass
class EliasFano:
    n: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray  # before each word of `high`
    zeros: np.ndarray

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, (max(int(universe), 1) // max(n, 1)).bit_length() - 1)
        values = values.astype(_U)
        low = _pack(values & _U((1 << bits) - 1), bits)
        top = (values >> _U(bits)).astype(np.int64)
        size = n + (int(universe) >> bits) + 2
        flags = np.zeros(-(-size // 64) * 64 + 64, np.uint8)
        flags[top + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(_U)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))[:-1]])
        zeros = np.arange(len(high)) * 64 - ones
        kind = np.uint32 if len(flags) < 1 << 32 else np.int64
        return cls(n, bits, low, high, ones.astype(kind), zeros.astype(kind))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits], np.int64), self.low, self.high, self.ones, self.zeros]

    @classmethod
    def of(cls, arrays: list[np.ndarray]) -> EliasFano:
        head, low, high, ones, zeros = arrays
        return cls(int(head[0]), int(head[1]), low, high, ones, zeros)

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        top = _select(self.high, self.ones, i, False) - i
        return (top.astype(_U) << _U(self.bits)) | _unpack(self.low, self.bits, i)

    def next_geq(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is at least ``x`` (below the universe); ``n`` if there is none."""
        return self.find(x)[0]

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places as by ``next_geq``, and whether the value there is ``x``."""
        x = x.astype(_U)
        top = (x >> _U(self.bits)).astype(np.int64)
        want = x & _U((1 << self.bits) - 1)
        # The bucket of a high part lies between two zeros: one is selected, the next mostly ends a run in the same word.
        at = np.where(top > 0, _select(self.high, self.zeros, np.maximum(top - 1, 0), True) + 1, 0)
        lo = at - top
        gap = ~(self.high[at >> 6] >> (at & 63).astype(_U))  # zeros are shifted in above, and become ones
        run = np.bitwise_count((gap - _ONE) & ~gap).astype(np.int64)
        hi = lo + run
        over = np.flatnonzero(run + (at & 63) >= 64)
        if len(over):
            hi[over] = _select(self.high, self.zeros, top[over], True) - top[over]
        end = hi.copy()
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = _unpack(self.low, self.bits, mid) < want[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[lo[live] < hi[live]]
        there = lo < end
        there[there] = _unpack(self.low, self.bits, lo[there]) == want[there]
        return lo, there


def save(path: str, arrays: list[np.ndarray]) -> None:
    """Arrays one after another in a file of the shared folder, each on a 64-byte border, with a table in front."""
    from pyarrow import fs

    head = np.zeros((len(arrays) + 1, 4), np.int64)
    head[0, 0] = len(arrays)
    at = head.nbytes + 64
    parts = []
    for k, a in enumerate(arrays, 1):
        at = -(-at // 64) * 64
        head[k] = (ord(a.dtype.kind), a.dtype.itemsize, at, len(a))
        parts.append((at, a))
        at += a.nbytes
    where, name = fs.FileSystem.from_uri(path)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    with where.open_output_stream(name) as f:
        f.write(head.tobytes())
        done = head.nbytes
        for to, a in parts:
            f.write(b"\0" * (to - done))
            f.write(np.ascontiguousarray(a).tobytes())
            done = to + a.nbytes


def load(path: str) -> list[np.ndarray]:
    """The arrays of a file, memory-mapped: straight from a shared disk, else from a local copy that has no name and
    goes with the process."""
    import tempfile

    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path)
    if isinstance(where, fs.LocalFileSystem):
        raw = np.memmap(name, np.uint8, "r").view(np.ndarray)
    else:
        with tempfile.NamedTemporaryFile() as f, where.open_input_stream(name) as src:
            while part := src.read(1 << 22):
                f.write(part)
            f.flush()
            raw = np.memmap(f.name, np.uint8, "r").view(np.ndarray)
    n = int(raw[:8].view(np.int64)[0])
    head = raw[: (n + 1) * 32].view(np.int64).reshape(-1, 4)
    return [raw[at : at + size * length].view(f"{chr(kind)}{size}") for kind, size, at, length in head[1:].tolist()]
