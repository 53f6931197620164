r"""Language-model scores of whole texts with an Elias-Fano n-gram trie.

Training counts words, then longer n-grams level by level, and keeps every n-gram.  All counts are over the whole corpus: tasks combine
what they have seen, and one shuffle of a level, packed and dealt by context, adds them up where the files are built.  How many files a level has
follows from the counted tokens (``SHARD`` of them to a file), not from the session.

The model is a trie whose levels lie in files of the shared folder, a number of shards to a level:

* level 1: the sorted 64-bit hashes of the words in an Elias-Fano sequence, their exact counts, and their numbers, which are small for
  frequent words;
* level n: the contexts that have successors, monotone pointers to the range of each, and the successors' numbers, each range raised
  above the range before so that the whole shard is one monotone sequence; all three are Elias-Fano sequences.  Beside them 16-bit
  logarithms of the discounted probability of each successor and of the back-off weight of each context.

The number of an n-gram is ``place * shards + shard``, without gaps, so that raised numbers stay below ``words * contexts of a shard``.  Tasks map the
files into memory, so a worker holds only the pages that it touches, and look n-grams up by successor search in the range of their
context, many at once.  A context of over ``HOT`` occurrences is dealt to several shards by its successor, so no file grows with one context; the
driver, which gets those few contexts, joins what the files say about them.

Probabilities are interpolated absolute discounting, ``p(w|h) = (c(hw) - D) / c(h) + b(h) p(w|h')``, where ``b(h)`` is what
the successors leave; the last resort is ``(c + 1) / (N + V + 1)``, which is also the base score.  A text is its words
(A-Z lower-cased, ``[^\x20\x09-\x0D]+``) and one end.

Defined results: null text is empty, only an end; a null id is never held out; rows that repeat count each; without training rows every
token has probability 1 / (0 + 1); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .elias_fano import EliasFano, load, save
from .scratch import arrow_batches, materialize, new_folder
from .wordstream import BLANK, hash_words, mix, slices

ORDER, DISCOUNT = 3, 0.6
BEGIN, END = np.uint64(1), np.uint64(2)
#: Tokens (level 1: four for a word) to a file of the trie, about; occurrences of a context that is dealt to one file; tokens that a task combines
#: before it passes them on; range of a stored logarithm; bytes of text that are worked on at once.
SHARD, HOT, COMBINE, RANGE, SLICE = 4 << 20, 1 << 20, 4 << 20, 24.0, 4 << 20
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_VALUES = 10.0 ** (np.arange(1 << 16) * (-RANGE / 65535))
_files: dict[str, list[np.ndarray]] = {}


def _file(path: str) -> list[np.ndarray]:
    if path not in _files:
        if len(_files) > 4096:
            _files.clear()
        _files[path] = load(path)
    return _files[path]


def quantise(log10: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(-log10, 0, RANGE) * (65535 / RANGE)).astype(np.uint16)


def _edges(x: np.ndarray) -> np.ndarray:
    """Places where a new value begins."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(shard, places)``, places in ascending order."""
    if not len(shard):
        return
    if int(shard.max()) < 1 << 16:
        shard = shard.astype(np.uint16)
    order = np.argsort(shard, kind="stable")
    s = shard[order]
    begin = _edges(s)
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(s)], strict=True):
        yield int(s[a]), order[a:b]


@dataclass
class Hot:
    """Contexts that are dealt to several shards: sorted numbers, number of parts, occurrences, back-off weights."""

    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    parts: np.ndarray = field(default_factory=lambda: np.ones(0, np.int64))
    total: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    back: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def of(cls, ids: np.ndarray, total: np.ndarray, most: int) -> Hot:
        order = np.argsort(ids)
        return cls(ids[order], -(-total[order] // most), total[order], np.zeros(len(ids)))

    def find(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``context`` of hot ones, and which they are."""
        if not len(self.ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.ids, context), len(self.ids) - 1)
        hit = np.flatnonzero(self.ids[at] == context)
        return hit, at[hit]


@dataclass
class Model:
    """Where the levels lie (``paths[level - 1][shard]``), how many shards each has, and the hot contexts of each."""

    tokens: int = 0
    types: int = 0
    shards: list[int] = field(default_factory=list)
    paths: list[dict[int, str]] = field(default_factory=list)
    hot: list[Hot] = field(default_factory=list)

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(number, count)`` of word hashes; -1 and 0 for unknown ones."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for k, at in _by_shard(word_shard(hashes, self.shards[0])):
            if k in self.paths[0]:
                *seq, rank, n = _file(self.paths[0][k])
                place, there = EliasFano.of(seq).find(hashes[at])
                at, place = at[there], place[there]
                ids[at], counts[at] = rank[place].astype(np.int64) * self.shards[0] + k, n[place]
        return ids, counts

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.types + 1)

    def deal(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The shard of ``level`` that holds each pair of a context and a word."""
        key = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        hit, which = self.hot[level - 2].find(context)
        if len(hit):
            key[hit] += mix(word[hit].astype(np.uint64)) % self.hot[level - 2].parts[which].astype(np.uint64)
        return (mix(key) % np.uint64(self.shards[level - 1])).astype(np.int64)

    def successors(self, level: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(number, discounted probability, back-off weight)`` of pairs of a context of ``level - 1`` and a word, equal contexts side
        by side; an n-gram that never occurred has number -1 and probability 0, an unknown word is -1."""
        ids, gained, back = np.full(len(context), -1, np.int64), np.zeros(len(context)), np.ones(len(context))
        for k, at in _by_shard(self.deal(level, context, word)):
            if k not in self.paths[level - 1]:
                continue
            a = _file(self.paths[level - 1][k])
            contexts, pointers, follow = EliasFano.of(a[0:5]), EliasFano.of(a[5:10]), EliasFano.of(a[10:15])
            c = context[at]
            begin = _edges(c)
            run = np.diff(begin, append=len(c))
            place, there = contexts.find(c[begin].astype(np.uint64))
            at, run, place = at[np.repeat(there, run)], run[there], place[there]
            lo, hi = pointers.get(place).astype(np.int64), pointers.get(place + 1).astype(np.int64)
            raised = np.zeros(len(place), np.uint64)
            later = lo > 0
            raised[later] = follow.get(lo[later] - 1) + np.uint64(1)
            back[at] = np.repeat(_VALUES[a[15][place]], run)
            known = word[at] >= 0
            row = np.repeat(np.arange(len(place)), run)[known]
            at = at[known]
            if not len(at):
                continue
            target = word[at].astype(np.uint64) + raised[row]
            most = follow.get(np.array([follow.n - 1]))[0]
            found, equal = follow.find(np.minimum(target, most))
            hit = equal & (target <= most) & (found >= lo[row]) & (found < hi[row])
            at, found = at[hit], found[hit]
            ids[at], gained[at] = found * self.shards[level - 1] + k, _VALUES[a[16][found]]
        hit, which = self.hot[level - 2].find(context)
        back[hit] = self.hot[level - 2].back[which]
        return ids, gained, back


def word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _combined(context: np.ndarray, word: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct pairs and how often each occurs (``n`` times where it stands)."""
    own, bits = None, int(word.max()).bit_length() if len(word) else 0
    if len(context) and int(context.max()).bit_length() + bits > 63:
        own, context = np.unique(context, return_inverse=True)
    key = (context << bits) | word
    if n is None:
        key.sort()
        at = _edges(key)
        n = np.diff(at, append=len(key))
    else:
        order = np.argsort(key)
        key = key[order]
        at = _edges(key)
        n = np.add.reduceat(n[order], at) if len(at) else n
    key = key[at]
    context = key >> bits
    return context if own is None else own[context], key & ((1 << bits) - 1), n


def _pack(*columns: np.ndarray) -> bytes:
    """Numbers of sorted pairs as few bytes: the first as differences, all with bytes of equal weight side by side, without leading zeros."""
    head, planes = [len(columns[0])], []
    for c in (np.diff(columns[0], prepend=0), *columns[1:]):
        head.append(max(1, -(-int(c.max()).bit_length() // 8)))
        planes.append(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : head[-1]].T).reshape(-1))
    return np.array(head, "<i8").tobytes() + pa.compress(np.concatenate(planes), "zstd", asbytes=True)


def _unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    n, *width = np.frombuffer(blob[: 8 * columns + 8], "<i8").tolist()
    raw = np.frombuffer(pa.decompress(blob[8 * columns + 8 :], n * sum(width), "zstd"), np.uint8)
    out, at = [], 0
    for w in width:
        full = np.zeros((n, 8), np.uint8)
        full[:, :w] = raw[at : at + n * w].reshape(w, n).T
        out.append(full.view("<i8").reshape(-1))
        at += n * w
    return [np.cumsum(out[0]), *out[1:]]


@dataclass
class _Stream:
    """Texts as one sequence of word numbers of this slice: begin, words, end for each text.  The slice numbers its words in the order of
    their numbers in the model (``known``), and all unknown words are one word, the first, with -1."""

    known: np.ndarray
    counts: np.ndarray
    word: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, model: Model) -> _Stream:
        w = hash_words(texts, BLANK)
        distinct, at = np.unique(w.hashes, return_inverse=True)
        ids, n = model.words(np.concatenate([distinct, [BEGIN, END]]))
        known, place, number = np.unique(ids, return_index=True, return_inverse=True)
        word = np.empty(len(w.hashes) + 2 * len(texts), np.int64)
        first = w.first + 2 * np.arange(len(w.first))
        word[np.arange(len(w.hashes)) + 2 * w.docs() + 1] = number[at]
        word[first[:-1]], word[first[1:] - 1] = number[-2], number[-1]
        return cls(known, n[place], word, first)


@dataclass
class _Level:
    """The n-grams of one length in a sequence whose context is known: ``rows`` are the places of their last words, ``of`` says which
    distinct n-gram each is; the other arrays have one entry for each distinct n-gram."""

    rows: np.ndarray
    of: np.ndarray
    found: np.ndarray
    gained: np.ndarray
    back: np.ndarray


def _chain(s: _Stream, model: Model, levels: int) -> Iterator[_Level]:
    """The levels from 2 up.  Distinct n-grams are numbered along the way, so that each level sorts once."""
    begin = np.zeros(len(s.word), bool)
    begin[s.first[:-1]] = True
    number, known = s.word, s.known  # of the n-gram that ends at each place, and the model's number of each
    for level in range(2, levels + 1):
        context = np.full(len(s.word), -1, np.int64)
        context[1:] = number[:-1]
        rows = np.flatnonzero((context >= 0) & ~begin)
        rows = rows[known[context[rows]] >= 0]
        key = context[rows] * len(s.known) + s.word[rows]
        order = np.argsort(key)
        key = key[order]
        at = _edges(key)
        of = np.empty(len(key), np.int64)
        of[order] = np.repeat(np.arange(len(at)), np.diff(at, append=len(key)))
        left, right = np.divmod(key[at], len(s.known))
        found, gained, back = model.successors(level, known[left], s.known[right])
        yield _Level(rows, of, found, gained, back)
        number = np.full(len(s.word), -1, np.int64)
        number[rows] = of
        known = found


def _count_words(docs: DataFrame) -> DataFrame:
    """``w, n``: words by their hashes and how often each occurs, begins and ends among them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            h = np.sort(np.concatenate(hashes))
            at = _edges(h)
            w, n = h[at].view(np.int64), np.diff(at, append=len(h))
            for a in range(0, len(w), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(w[a : a + 100_000]), pa.array(n[a : a + 100_000])], names=["w", "n"])

        for batch in batches:
            for part in slices(batch, size=SLICE):
                hashes += [hash_words(part.column("text"), BLANK).hashes, np.repeat(np.array([BEGIN, END]), part.num_rows)]
                size += len(hashes[-2]) + len(hashes[-1])
                if size > COMBINE:
                    yield from out()
                    hashes, size = [], 0
        if size:
            yield from out()

    return docs.select("text").mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def _count_level(docs: DataFrame, model: Model, level: int) -> DataFrame:
    """``k, packed``: counted n-grams of ``level`` as numbers of context and word, dealt to shards.

    Each task combines its n-grams and passes those of a shard on as one packed value.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, words, size = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            c, w, n = _combined(np.concatenate(contexts), np.concatenate(words))
            shards, blobs = [], []
            for k, at in _by_shard(model.deal(level, c, w)):
                shards.append(k)
                blobs.append(_pack(c[at], w[at], n[at] - 1))
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(blobs, pa.binary())], names=["k", "packed"])

        for batch in batches:
            for part in slices(batch, size=SLICE):
                s = _Stream.of(part.column("text"), model)
                number, known = s.word, s.known
                for lower in _chain(s, model, level - 1):
                    number = np.full(len(s.word), -1, np.int64)
                    number[lower.rows] = lower.of
                    known = lower.found
                last = np.zeros(len(s.word), bool)
                last[s.first[1:] - 1] = True
                at = np.flatnonzero((number >= 0) & ~last)  # in training all words and contexts are known
                contexts.append(known[number[at]])
                words.append(s.known[s.word[at + 1]])
                size += len(at)
                if size > COMBINE:
                    yield from out()
                    contexts, words, size = [], [], 0
        if size:
            yield from out()

    return docs.select("text").mapInArrow(count, "k int, packed binary").repartition(model.shards[level - 1], "k")


#: A file: its shard, path; n-grams that will be hot contexts, with their counts; hot contexts in it, with how many successors each has in it.
_SAVED = "shard long, path string, ids array<long>, counts array<long>, contexts array<long>, spread array<long>"


def _saved(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 4]
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["shard", "path", "ids", "counts", "contexts", "spread"])


def _narrow(n: np.ndarray) -> np.ndarray:
    return n.astype(np.uint32 if not len(n) or n.max() < 1 << 32 else np.uint64)


def _save_words(vocabulary: DataFrame, shards: int, hot: int, folder: str) -> DataFrame:
    """A word's number is its rank among the words of its shard by frequency, times the shards, plus the shard."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)  # about SHARD words
        if not batches:
            return
        h = np.concatenate([b.column("w").to_numpy() for b in batches]).view(np.uint64)
        n = np.concatenate([b.column("n").to_numpy() for b in batches])
        out = []
        for k, at in _by_shard(word_shard(h, shards)):
            at = at[np.argsort(h[at])]
            own, count = h[at], n[at]
            rank = np.empty(len(at), np.int64)
            rank[np.lexsort((own, -count))] = np.arange(len(at))
            path = f"{folder}/words-{k}-{uuid.uuid4().hex}"
            save(path, [*EliasFano.build(own, (1 << 64) - 1).arrays(), _narrow(rank), _narrow(count)])
            many = np.flatnonzero(count > hot)
            out.append((k, path, (rank[many] * shards + k).tolist(), count[many].tolist(), [], []))
        yield _saved(out)

    dealt = vocabulary.repartition(shards, F.shiftrightunsigned("w", 32) % shards)  # as ``word_shard``: words of a shard meet
    return dealt.mapInArrow(build, _SAVED)


def write_level(folder: str, k: int, c: np.ndarray, w: np.ndarray, n: np.ndarray, model: Model, level: int, hot: int = HOT) -> tuple:
    """Write shard ``k`` of a level from sorted distinct pairs of a context and a word and their counts; a row of ``_SAVED``."""
    begin = _edges(c)
    context, size = c[begin], np.diff(begin, append=len(c))
    total = np.add.reduceat(n, begin)
    split, which = model.hot[level - 2].find(context)
    total[split] = model.hot[level - 2].total[which]
    last = w[begin + size - 1]
    raised = np.cumsum(last + 1) - last - 1
    follow = w + np.repeat(raised, size)
    path = f"{folder}/level{level}-{k}-{uuid.uuid4().hex}"
    save(
        path,
        [
            *EliasFano.build(context, int(context[-1]) + 1).arrays(),
            *EliasFano.build(np.append(begin, len(c)), len(c) + 1).arrays(),
            *EliasFano.build(follow, int(follow[-1]) + 1).arrays(),
            quantise(np.log10(DISCOUNT * size / total)),
            quantise(np.log10((n - DISCOUNT) / np.repeat(total, size))),
        ],
    )
    many = np.flatnonzero(n > hot)
    return k, path, (many * model.shards[level - 1] + k).tolist(), n[many].tolist(), context[split].tolist(), size[split].tolist()


def _save_level(dealt: DataFrame, model: Model, level: int, hot: int, folder: str) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed: dict[int, list[bytes]] = {}
        for batch in batches:
            for k, blob in zip(batch.column("k").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                packed.setdefault(k, []).append(blob)
        out = []
        while packed:
            k, blobs = packed.popitem()
            c, w, n = (np.concatenate(x) for x in zip(*(_unpack(b, 3) for b in blobs), strict=True))
            out.append(write_level(folder, k, *_combined(c, w, n + 1), model, level, hot))
        yield _saved(out)

    return dealt.mapInArrow(build, _SAVED)


def train(docs: DataFrame, order: int = ORDER, shard: int = SHARD, hot: int = HOT) -> Model:
    """The model of the column ``text`` of ``docs``.  The driver gets one row for each file."""
    spark = docs.sparkSession
    arrow_batches(spark)
    folder, model = new_folder(spark, "trie"), Model()
    kept = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")  # a level's shuffle files go once its files are built
    try:
        for level in range(1, order + 1):
            if level == 1:
                vocabulary = materialize(_count_words(docs), "words")
                real = F.col("w") != int(BEGIN)
                sizes = vocabulary.filter(real).agg(F.count(F.lit(1)).alias("types"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
                model.types, model.tokens = sizes["types"], sizes["tokens"]
                model.shards.append(max(1, -(-4 * model.types // shard)))
                files = _save_words(vocabulary, model.shards[0], hot, folder).collect()
            else:
                model.shards.append(max(1, -(-model.tokens // shard)))
                files = _save_level(_count_level(docs, model, level), model, level, hot, folder).collect()
                split = model.hot[-1]
                for f in files:
                    at = np.searchsorted(split.ids, np.array(f["contexts"], np.int64))
                    split.back[at] += DISCOUNT * np.array(f["spread"]) / split.total[at]
            model.paths.append({f["shard"]: f["path"] for f in files})
            ids, counts = (np.array([x for f in files for x in f[c]], np.int64) for c in ("ids", "counts"))
            model.hot.append(Hot.of(ids, counts, hot))
    finally:
        spark.conf.unset(_CLEAN) if kept is None else spark.conf.set(_CLEAN, kept)
    return model


def score(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """``id_col, n_tokens, n_known, base_score, score`` of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, size=SLICE):
                s = _Stream.of(part.column("text"), model)
                p = model.base(s.counts)
                base, p, known = np.log10(p)[s.word], p[s.word], (s.counts > 0)[s.word].astype(np.int64)
                for level in _chain(s, model, len(model.paths)):
                    p[level.rows] = level.gained[level.of] + level.back[level.of] * p[level.rows]
                p[s.first[:-1]], base[s.first[:-1]], known[s.first[:-1]] = 1.0, 0.0, 0  # a begin is no token
                sums = [np.add.reduceat(x, s.first[:-1]) for x in (known, base, np.log10(p))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(s.first) - 1, pa.int64()), *map(pa.array, sums)], names=["id", "n_tokens", "n_known", "base_score", "score"]
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id", modulus: int = 7, remainder: int = 2):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Scores of all rows under the model of the rows that aren't held out."""
    training = docs.filter(~held_out(id_col)).select(F.col(text_col).alias("text"))
    model = train(training, order)
    scored = score(docs, model, id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
