r"""Periodic runs of words in each text, found by minimizers at several scales.

A run is a stretch of consecutive words that repeats with a smallest period ``q``, is at least ``max(LEAST, 2 * q)`` words long, and that no neighbouring
word extends.  All runs of a text are found, by the size of their period:

* periods under ``SHORT`` by comparing the text with itself at each such lag;
* periods from ``2**k`` to ``2**(k+1) - 1`` at scale ``k``.  Blocks of ``m = 2**(k-1)`` words have a hash; of every ``m + 1`` consecutive blocks
  the one with the least hash is picked.  Within a run the picks of a period are picked again one period on, so the pairs of picks with equal hashes at
  such a distance hold a seed for every run.  A seed is extended to both sides by binary search over hashes of 1, 2, 4, ... words;
* blocks that lie in a run already known of a period up to ``m / 3`` are never picked: equal picks so lie at least ``m / 3`` apart, and a pick has a dozen
  partners at most, however monotonous the text is.  A run whose halves hold such blocks alone joins two touching runs of one period; its lags are read from those.

Words are compared as themselves (numbered by a dictionary), blocks by 64-bit hashes.  A text is one row and never cut; beside its words a task holds 8 bytes a
word for each scale, for about ``SLICE`` bytes of text or one longer text.  There is no shuffle.

Defined results: null text, and text without words, has no runs; ids pass through as they are, null or repeated (every row is judged by itself); other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import arrow_batches
from .wordstream import mix, slices

#: Least length of a run in words; periods below this are found by direct comparison (a power of two); bytes of text worked on at once.
LEAST, SHORT, SLICE = 12, 32, 2 << 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_U = np.uint64


def _stretches(code: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what repeats at ``lag`` for long enough."""
    reach = max(len(code) - lag, 0)
    same = np.zeros(reach + 2, np.int8)
    same[1:-1] = code[len(code) - reach :] == code[:reach]
    edge = np.flatnonzero(same[1:] != same[:-1])
    start, stop = edge[::2], edge[1::2]
    enough = stop - start >= max(LEAST - lag, lag)
    return start[enough], stop[enough] + lag


def _twice(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of blocks of twice ``size`` words from those of ``size`` words."""
    return mix(h[: max(len(h) - size, 0)] * _U(0x9E3779B97F4A7C15) + h[size:])


def _ahead(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many words from ``x`` and from ``y`` on are equal (``x < y``)."""
    got = np.zeros(len(x), np.int64)
    top = len(levels) - 1
    for j in [top, *range(top, -1, -1)]:
        h, live = levels[j], np.arange(len(x))
        while len(live):
            live = live[y[live] + got[live] < len(h)]
            live = live[h[x[live] + got[live]] == h[y[live] + got[live]]]
            got[live] += 1 << j
            if j < top:
                break
    return got


def _behind(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many words just before ``x`` and just before ``y`` are equal."""
    got = np.zeros(len(x), np.int64)
    top = len(levels) - 1
    for j in [top, *range(top, -1, -1)]:
        h, live = levels[j], np.arange(len(x))
        while len(live):
            live = live[x[live] - got[live] >= 1 << j]
            at = got[live] + (1 << j)
            live = live[h[x[live] - at] == h[y[live] - at]]
            got[live] += 1 << j
            if j < top:
                break
    return got


def _picks(h: np.ndarray, width: int, idle: np.ndarray) -> np.ndarray:
    """Places of the least hash (the first of equals) in any ``width + 1`` consecutive places, ``width`` a power of two; ``idle`` places are never picked."""
    if len(h) <= width:
        return np.zeros(0, np.int64)
    bits = int(len(h)).bit_length()
    none = _U(0xFFFFFFFFFFFFFFFF)
    key = (h >> _U(bits)) << _U(bits) | np.arange(len(h), dtype=_U)
    key[idle] = none
    step = 1
    while step < width:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    key = np.minimum(key[:-1], key[1:])
    at = (key[key != none] & _U((1 << bits) - 1)).astype(np.int64)
    return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at


def _seeds(h: np.ndarray, picks: np.ndarray, span: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of picks with equal hashes, ``span`` to ``2 * span - 1`` apart; of pairs that chain up at one lag, only the first."""
    v = h[picks]
    order = np.lexsort((picks, v))
    p, v = picks[order], v[order]
    xs, lags = [], []
    for t in range(1, len(p)):
        gap = p[t:] - p[:-t]
        near = (v[t:] == v[:-t]) & (gap < 2 * span)
        if not near.any():
            break
        near &= gap >= span
        xs.append(p[:-t][near])
        lags.append(gap[near])
    if not xs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, lag = np.concatenate(xs), np.concatenate(lags)
    order = np.lexsort((x, lag))
    x, lag = x[order], lag[order]
    head = np.ones(len(x), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (x[1:] - x[:-1] > m)
    return x[head], lag[head]


def _phase(code: np.ndarray, a: int, b: int, period: int) -> int | None:
    """How far the period that begins at ``b`` is turned against the one that begins at ``a``; None if they aren't turns of each other."""
    twice, once, at = code[a : a + 2 * period].tobytes(), code[b : b + period].tobytes(), -1
    while (at := twice.find(once, at + 1)) >= 0:
        if at % code.itemsize == 0:
            return at // code.itemsize
    return None


def _touching(code: np.ndarray, runs: list[tuple[int, int, int]], span: int, m: int, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Seeds at lags of this scale from touching runs of one short period."""
    few = sorted((q, s, e) for s, e, q in runs if 3 * q <= m and e - s >= span)
    xs, lags = [], []
    for (q, s, e), (q2, s2, e2) in zip(few, few[1:], strict=False):
        if q != q2 or s2 > e:
            continue
        if (s, s2) not in known:
            known[s, s2] = _phase(code, s, s2, q)
        if known[s, s2] is None:
            continue
        lag = np.arange(span + (s2 - s - known[s, s2] - span) % q, 2 * span, q)
        x = np.maximum(s, s2 - lag)
        fits = np.minimum(e, e2 - lag) - x >= lag
        xs.append(x[fits])
        lags.append(lag[fits])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *xs]), np.concatenate([empty, *lags])


def find_runs(code: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)`` of texts that stand one after the other in ``code``, the longest first.

    ``sizes``: how many numbers each text takes.  Each text ends with a number that occurs once only, so nothing repeats over its end.
    """
    seen: set[tuple[int, int]] = set()
    runs: list[tuple[int, int, int]] = []

    def add(start: np.ndarray, end: np.ndarray, lag: np.ndarray) -> None:
        order = np.argsort(lag, kind="stable")  # the smallest period of a stretch comes first
        for s, e, q in zip(start[order].tolist(), end[order].tolist(), lag[order].tolist(), strict=True):
            if (s, e) not in seen:
                seen.add((s, e))
                runs.append((s, e, q))

    total = np.cumsum(sizes)
    for lag in range(1, SHORT):
        start, end = _stretches(code, lag)
        add(start, end, np.full(len(start), lag))
    levels = [mix(code.astype(_U) + _U(1))]
    phases: dict = {}
    span = SHORT
    while True:
        long = int(np.searchsorted(-sizes, -2 * span, "right"))  # texts that can hold such a run
        if not long:
            return runs
        n, m = int(total[long - 1]), span // 2
        levels = [h[: n - (1 << j) + 1] for j, h in enumerate(levels)]
        while 1 << (len(levels) - 1) < m:
            levels.append(_twice(levels[-1], 1 << (len(levels) - 1)))
        h = levels[-1]
        mark = np.zeros(len(h) + 1, np.int64)
        for s, e, q in runs:
            if 3 * q <= m <= e - s and e <= n:
                mark[s] += 1
                mark[e - m + 1] -= 1
        x, lag = _seeds(h, _picks(h, m, np.cumsum(mark[:-1]) > 0), span, m)
        x2, lag2 = _touching(code, runs, span, m, phases)
        x, lag = np.concatenate([x, x2]), np.concatenate([lag, lag2])
        start, end = x - _behind(levels, x, x + lag), x + lag + _ahead(levels, x, x + lag)
        fits = end - start >= 2 * lag
        add(start[fits], end[fits], lag[fits])
        span *= 2


def runs_of_texts(texts: list[str | None]) -> list[tuple[list[str], list[tuple[int, int, int]]]]:
    """For each text its words and its runs ``(start, length, period)`` by start, then period."""
    words = [WORD.findall(t) if t else [] for t in texts]
    order = sorted(range(len(words)), key=lambda d: -len(words[d]))
    number: dict = defaultdict(count().__next__)
    codes: list[int] = []
    for d in order:
        codes.extend(map(number.__getitem__, words[d]))
        codes.append(number[d])  # an end that no word equals
    sizes = np.array([len(words[d]) + 1 for d in order], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    found: list[list] = [[] for _ in texts]
    for s, e, q in find_runs(np.array(codes, np.int64), sizes):
        at = int(np.searchsorted(first, s, "right")) - 1
        found[order[at]].append((s - int(first[at]), e - s, q))
    return [(w, sorted(r, key=lambda x: (x[0], x[2]))) for w, r in zip(words, found, strict=True)]


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return " ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return " ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, runs, collapsed`` of each row: runs as an array of ``(start, length, period)`` in words, and the text without repetitions."""
    arrow_batches(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size=SLICE):
                found = runs_of_texts(part.column("text").to_pylist())
                flat = np.array([r for _, rs in found for r in rs], np.int64).reshape(-1, 3)
                ends = np.concatenate([[0], np.cumsum([len(rs) for _, rs in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(w) for w, _ in found], pa.int64()), lists, pa.array([collapse(w, rs) for w, rs in found], pa.string())],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(find, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_col``, where the texts of a tenth of the ids (by CRC-32) go on periodically from some word on; a null id isn't among them."""
    h = F.crc32(F.col(id_col).cast("string"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(h % 10 == 0, F.lit(False)).alias("hit"), F.floor(h / 10).cast("long").alias("g"))
    words = F.filter(F.split(F.when(F.col("hit"), F.col("text")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    rows = rows.withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - F.col("a") - 1), lambda i: F.get("words", (F.col("a") + i % F.col("p")).cast("int")))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), again), " ")
    return rows.select(F.col("id").alias(id_col), F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias(text_col))


def _line(r: Column) -> Column:
    return F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))


def run_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the number of runs, the longest one, and digests of all runs and of the collapsed text."""
    rows = periodic_runs(docs, id_col, text_col)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = rows.withColumn("best", best)
    return rows.select(
        id_col,
        "n_words",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(_line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
