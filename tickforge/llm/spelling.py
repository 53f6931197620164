r"""Groups of spelling variants: words one edit apart, found in a bidirectional FM-index.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.  Then one of the halves of either word stands unchanged at its
end of the other word, so near words are found by two searches over a text of all words between delimiters: match the left half and the delimiter before it
exactly and extend to the right with one error, or match the right half and the delimiter after it and extend to the left.  A search
holds intervals of suffix ranks in the index of the text and in that of the reversed text, in step with each other, so that it can change
direction: it matches a half from its inner end outwards, then turns.

The vocabulary is dealt out so that no task needs all of it: a word is indexed under each prefix and each suffix that can be the unchanged half of a
near word (two of each at most), and asks under its own halves only.  Halves are dealt to shards of about ``SHARD`` symbols, each with an index of its own.  A half that more
than ``BLOCK`` words share is cut into blocks, and its words ask in all of them; every search takes steps in proportion to the word and what it finds, however large the
block.  What leaves a shard is one row for each word that asked there.

A word's form is its most frequent near word, if that occurs at least twice as often; roots follow forms to the last one by doubling pointers, a few joins
whatever the length of the chains.

Defined results: null and empty texts have no words; a null id counts as empty where ids matter; repeated rows count each; other columns are ignored; an empty table gives an empty
result; ties of frequency go to the first word in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import arrow_batches, materialize

LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT = 5, 3
#: Symbols of a shard's text, about; words of one half that stand in one shard; ranks apart at which the index keeps counts; states worked on at once.
SHARD, BLOCK, STEP, STATES = 1 << 20, 50_000, 64, 1 << 14


class Ranks:
    """Suffix ranks of a circular text, and how often each symbol precedes those below a rank."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        n = len(text)
        rank, size = text.astype(np.int64), 1
        while True:
            order = np.argsort(pair := rank * (n + symbols) + np.roll(rank, -size), kind="stable")
            new = np.concatenate([[0], np.cumsum(pair[order][1:] != pair[order][:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            size *= 2
            if size >= n or new[-1] == n - 1:
                break
        self.suffix = order
        self.before = text[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        blocks = n // STEP + 1
        padded = np.full(blocks * STEP, symbols, text.dtype)
        padded[:n] = self.before
        self.blocks = padded.reshape(blocks, STEP)
        counts = np.bincount(np.repeat(np.arange(blocks), STEP)[:n] * symbols + self.before, minlength=blocks * symbols).reshape(blocks, symbols)
        at = np.cumsum(counts, axis=0) - counts
        self.counts = at.astype(np.int32)
        self.less = (np.cumsum(at, axis=1) - at).astype(np.int32)

    def count(self, symbol: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of the symbols before the ranks below ``rank`` are ``symbol``, and how many are less."""
        same, less = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for a in range(0, len(rank), STATES):
            c, r = symbol[a : a + STATES], rank[a : a + STATES]
            b = r // STEP
            row = self.blocks[b]
            inside = np.arange(STEP) < (r % STEP)[:, None]
            same[a : a + STATES] = self.counts[b, c] + ((row == c[:, None]) & inside).sum(1)
            less[a : a + STATES] = self.less[b, c] + ((row < c[:, None]) & inside).sum(1)
        return same, less


class Intervals:
    """Where patterns occur: ranks ``there[i] : there[i] + size[i]`` in the index that extends them, ``back`` the first rank in the other one."""

    def __init__(self, there: np.ndarray, back: np.ndarray, size: np.ndarray) -> None:
        self.there, self.back, self.size = there, back, size

    def of(self, which: np.ndarray) -> Intervals:
        return Intervals(self.there[which], self.back[which], self.size[which])

    def turned(self) -> Intervals:
        return Intervals(self.back, self.there, self.size)

    def extended(self, ranks: Ranks, symbol: np.ndarray) -> Intervals:
        """With one more symbol on the side of ``ranks``; what doesn't occur has no size."""
        same, less = ranks.count(symbol, self.there)
        upto, below = ranks.count(symbol, self.there + self.size)
        return Intervals(ranks.first[symbol] + same, self.back + below - less, upto - same)


def _branches(ranks: Ranks, at: Intervals, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """``(state, symbol)`` of the symbols other than the delimiter that can follow; where an interval is wide, of all symbols."""
    narrow = np.flatnonzero(at.size <= symbols)
    many = at.size[narrow]
    state = np.repeat(narrow, many)
    row = np.repeat(at.there[narrow] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
    code = np.unique(state * symbols + ranks.before[row])
    wide = np.flatnonzero(at.size > symbols)
    state, symbol = code // symbols, code % symbols
    state = np.concatenate([state, np.repeat(wide, symbols)])
    symbol = np.concatenate([symbol, np.tile(np.arange(symbols), len(wide))])
    return state[symbol > 0], symbol[symbol > 0]


def _one_error(out: Ranks, turn: Ranks, flat: np.ndarray, begin: np.ndarray, length: np.ndarray, half: np.ndarray, symbols: int) -> tuple[np.ndarray, Intervals]:
    """Queries and intervals of the words that agree with a query's first ``half`` symbols and have one error after them.

    ``flat[begin:begin + length]`` are queries, each followed by the delimiter 0.  ``out`` extends to the side where queries begin, ``turn`` to the other.
    """
    query = np.arange(len(begin))
    n = len(out.suffix)
    at = Intervals(np.zeros(len(query), np.int64), np.zeros(len(query), np.int64), np.full(len(query), n))
    left = half.copy()
    while True:  # the half from its inner end outwards, and the delimiter
        going = np.flatnonzero(left >= 0)
        if not len(going):
            break
        symbol = np.where(left[going] > 0, flat[begin[going] + np.maximum(left[going] - 1, 0)], 0)
        new = at.of(going).extended(out, symbol)
        at.there[going], at.back[going], at.size[going] = new.there, new.back, new.size
        left[going] -= 1
    at, i = at.turned(), half.copy()
    hit_query, hit_at = [], []
    errors: list[tuple[np.ndarray, np.ndarray, Intervals]] = []
    while len(query):
        # One error here: another symbol, one more symbol, or one less.
        state, symbol = _branches(turn, at, symbols)
        here = flat[begin[query[state]] + i[state]]
        state, symbol, here = (x[symbol != here] for x in (state, symbol, here))
        new = at.of(state).extended(turn, symbol)
        state, here, new = state[new.size > 0], here[new.size > 0], new.of(new.size > 0)
        replaced = here > 0
        errors += [(query[state[replaced]], i[state[replaced]] + 1, new.of(replaced)), (query[state], i[state], new)]
        inside = i < length[query]
        dropped = np.flatnonzero(inside & ((i == half[query]) | (flat[begin[query] + i] != flat[begin[query] + i - 1])))
        errors.append((query[dropped], i[dropped] + 1, at.of(dropped)))
        # No error here.
        on = np.flatnonzero(inside)
        at = at.of(on).extended(turn, flat[begin[query[on]] + i[on]])
        query, i = query[on][at.size > 0], i[on][at.size > 0] + 1
        at = at.of(at.size > 0)
    query = np.concatenate([np.zeros(0, np.int64), *(q for q, _, _ in errors)])
    i = np.concatenate([np.zeros(0, np.int64), *(x for _, x, _ in errors)])
    at = Intervals(*(np.concatenate([np.zeros(0, np.int64), *(getattr(a, f) for _, _, a in errors)]) for f in ("there", "back", "size")))
    while len(query):
        at = at.extended(turn, flat[begin[query] + i])
        found = at.size > 0
        end = found & (i == length[query])
        hit_query.append(query[end])
        hit_at.append(at.of(end).turned())
        on = found & ~end
        query, i, at = query[on], i[on] + 1, at.of(on)
    there, back, size = (np.concatenate([np.zeros(0, np.int64), *(getattr(a, f) for a in hit_at)]) for f in ("there", "back", "size"))
    return np.concatenate([np.zeros(0, np.int64), *hit_query]), Intervals(there, back, size)


def near_words(words: list[str], ask: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(in ask, in words)`` of near words that share the asking word's left half, or (``right``) its right half and not the left one.

    ``words`` are distinct.  A left half is the shorter one.
    """
    spelled = "\0" + "\0".join(words)
    points = np.frombuffer(spelled.encode("utf-32-le", "surrogatepass"), np.uint32)
    asked = np.frombuffer(("\0".join(ask) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.unique(np.concatenate([points, asked]))  # the delimiter is the first
    kind = np.uint8 if len(letters) < 255 else np.int32
    text, flat = np.searchsorted(letters, points).astype(kind), np.searchsorted(letters, asked).astype(np.int64)
    length = np.array([len(w) for w in ask], np.int64)
    begin = np.concatenate([[0], np.cumsum(length + 1)[:-1]]).astype(np.int64)
    forward, backward = Ranks(text, len(letters)), Ranks(text[::-1].copy(), len(letters))
    starts = np.flatnonzero(text == 0)
    word_at = np.cumsum(text == 0) - 1
    n = len(text)
    if right:
        turned = np.zeros_like(flat)
        for b, m in zip(begin.tolist(), length.tolist(), strict=True):
            turned[b : b + m] = flat[b : b + m][::-1]
        query, at = _one_error(backward, forward, turned, begin, length, length - length // 2, len(letters))
        # There a hit begins, read backwards, with the delimiter after the word.
        word = word_at[(n - 1 - backward.suffix[at.there] - 1) % n]
        half = length[query] // 2
        size = np.append(starts[1:], n)[word] - starts[word] - 1
        same, step = size >= half, 0
        while True:
            live = np.flatnonzero(same & (half > step))
            if not len(live):
                break
            same[live] = text[starts[word[live]] + 1 + step] == flat[begin[query[live]] + step]
            step += 1
        return query[~same], word[~same]
    query, at = _one_error(forward, backward, flat, begin, length, length // 2, len(letters))
    return query, word_at[forward.suffix[at.there]]


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, word`` of each run of letters in the texts, A-Z lower-cased."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("word")).select("id", F.translate("word", UPPER, SMALL).alias("word"))


def drop_letters(words: DataFrame) -> DataFrame:
    """Rows ``id, word`` with one code point missing in one of 97, as the CRC-32 of id and word has it."""
    rows = words.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))))
    at = (F.col("h") % F.length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return rows.select("id", F.when(F.col("h") % 97 == 0, shorter).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words of at least ``min_length`` (four or more) code points that occur ``min_count`` times."""
    counted = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _dealt(vocab: DataFrame, shards: int) -> DataFrame:
    """``shard, ends, word, n, given, asks``: where each word is indexed (``given``), and where it asks."""
    size = F.length("word")
    halves = lambda f: F.array_distinct(F.array(*(f((size + d).cast("int")).cast("int") for d in (-1, 0, 1))))
    part: dict[bool, tuple[Column, Column]] = {
        False: (halves(lambda s: F.floor(s / 2)), F.floor(size / 2)),
        True: (halves(lambda s: s - F.floor(s / 2)), size - F.floor(size / 2)),
    }
    sides = []
    for ends, (all_, own) in part.items():
        rows = vocab.select("word", "n", own.cast("int").alias("own"), F.explode(all_).alias("many"))
        rows = rows.filter(F.col("many") <= F.length("word"))
        half = F.substring("word", F.length("word") - F.col("many") + 1, F.col("many")) if ends else F.substring("word", F.lit(1), F.col("many"))
        sides.append(rows.select(F.lit(ends).alias("ends"), half.alias("half"), "word", "n", (F.col("many") == F.col("own")).alias("asks")))
    rows = sides[0].unionByName(sides[1])
    hot = rows.groupBy("ends", "half").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > BLOCK).select(F.col("ends").alias("e"), F.col("half").alias("h"), F.ceil(F.col("size") / F.lit(BLOCK)).alias("g"))
    rows = rows.join(hot, (rows["ends"] == hot["e"]) & (rows["half"] == hot["h"]), "left").withColumn("g", F.coalesce("g", F.lit(1).cast("long")))
    own_block = F.pmod(F.xxhash64("word"), F.col("g"))
    blocks = F.when(F.col("asks"), F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).otherwise(F.array(own_block))
    rows = rows.withColumn("mine", own_block).withColumn("block", F.explode(blocks))
    return rows.select(F.pmod(F.xxhash64("ends", "half", "block"), F.lit(shards)).alias("shard"), "ends", "word", "n", (F.col("block") == F.col("mine")).alias("given"), "asks")


def _answers(ends: bool, rows: list[tuple[str, int, bool, bool]]) -> tuple[list, list, list, list]:
    """For each word of a shard that has near words there: how many, and the most frequent one.

    A word that asks in several shards may meet a near word again where that is indexed under its other half; only a meeting under the asking word's half counts.
    """
    index, under = {}, {}
    for w, n, given, asks in rows:
        if given:
            index[w] = n
            under[w] = under.get(w, 0) | (1 if asks else 2)  # its own half, the other one
    ask = sorted({w for w, _, _, asks in rows if asks})
    words = sorted(index)
    if not words or not ask:
        return [], [], [], []
    query, near = near_words(words, ask, ends)
    half, asked = (np.array([(len(w) + ends) // 2 for w in ws], np.int64) for ws in (words, ask))
    met = np.array([under[w] for w in words], np.int64)[near] & np.where(half[near] == asked[query], 1, 2) > 0
    query, near = query[met], near[met]
    n = np.array([index[w] for w in words], np.int64)
    order = np.lexsort((near, -n[near], query))
    query, near = query[order], near[order]
    who, first, many = np.unique(query, return_index=True, return_counts=True)
    best = near[first].tolist()
    return [ask[i] for i in who.tolist()], many.tolist(), [words[i] for i in best], n[best].tolist()


def near_counts(vocab: DataFrame) -> DataFrame:
    """``word, n_near, top, top_n`` of the words ``word, n`` that have near words."""
    arrow_batches(vocab.sparkSession)
    symbols = vocab.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    shards = max(1, -(-4 * symbols // SHARD))
    rows = _dealt(vocab, shards).repartition(shards, "shard").sortWithinPartitions("shard", "ends")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[tuple[bool, list]]:
            last, held = None, []
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("shard", "ends", "word", "n", "given", "asks")]
                for shard, ends, *row in zip(*columns, strict=True):
                    if (shard, ends) != last:
                        if held:
                            yield last[1], held
                        last, held = (shard, ends), []
                    held.append(tuple(row))
            if held:
                yield last[1], held

        for ends, held in groups():
            word, many, top, top_n = _answers(ends, held)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(many, pa.int64()), pa.array(top, pa.string()), pa.array(top_n, pa.int64())], names=["word", "n_near", "top", "top_n"])

    found = rows.mapInArrow(search, "word string, n_near long, top string, top_n long")
    best = F.min(F.struct((-F.col("top_n")).alias("n"), F.col("top").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", F.col("best.w").alias("top"), (-F.col("best.n")).alias("top_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the rows ``word, form`` (null: none), whose forms form no circle."""
    steps = materialize(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        up = steps.select(F.col("word").alias("w"), F.col("root").alias("r"))
        new = materialize(steps.join(up, steps["root"] == up["w"]).select("word", F.col("r").alias("root"), (F.col("r") != F.col("root")).alias("moved")), "roots")
        steps = new.select("word", "root")
        if not new.filter("moved").limit(1).count():
            return steps


def group_variants(vocab: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the distinct words ``word, n``."""
    vocab = materialize(vocab, "vocabulary")
    near = near_counts(vocab).withColumnRenamed("word", "w")
    rows = vocab.join(near, vocab["word"] == near["w"], "left")
    twice = F.col("top_n") >= 2 * F.col("n")
    rows = rows.select(
        "word", F.when(twice, F.col("top")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(twice, F.col("top_n")).alias("form_n")
    )
    rows = materialize(rows, "forms")
    root = roots(rows).withColumnRenamed("word", "w")
    return rows.join(root, rows["word"] == root["w"]).select("word", "form", "root", "n", "n_near", "form_n")
