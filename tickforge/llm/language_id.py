r"""Language identification with hyperdimensional profiles.

Every character has a random vector of +1 and -1.  An n-gram is bound as the product of its characters' vectors, each
permuted (rotated) by its distance from the n-gram's end; a text's vector is the bundle (sum) of its n-grams, and a language's prototype the
bundle of its training texts.  A text gets the language whose prototype has the largest cosine to the text's vector, after the mean of
all prototypes, which carries no information, is taken from both.

Learning is one pass: each task bundles its texts per language into integer vectors and Spark adds them up, so the
result doesn't depend on the order of rows.  What reaches the driver are the prototypes: ``DIMENSIONS`` numbers for each language.

Texts are lower-cased, everything but letters and combining marks becomes one space, and texts begin and end with one.  Defined results: null text or text
without a letter (marks alone aren't one) is ``und`` with score 0; without any learned language every text is ``und``; null labels teach nothing; ties
go to the first language by name; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import arrow_batches
from .wordstream import slices

GRAM, DIMENSIONS = 3, 1024
#: Texts, and distinct n-grams, that are bundled at once; they bound a task's dense matrices.
ROWS, COLUMNS = 512, 2048
UNKNOWN = "und"

_letters: list[np.ndarray] = []
_vectors: dict[int, np.ndarray] = {}


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """For each code point itself if n-grams take it (letters, and the marks that stand with them), else a space; and whether it is a letter."""
    if not _letters:
        kind = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
        taken = np.fromiter((k in "LM" for k in kind), bool, 0x110000)
        _letters.append(np.where(taken, np.arange(0x110000, dtype=np.int32), 32).astype(np.int32))
        _letters.append(np.fromiter((k == "L" for k in kind), bool, 0x110000))
    return _letters[0], _letters[1]


def letter_vector(code: int) -> np.ndarray:
    """The random vector of a character, the same on every machine."""
    if code not in _vectors:
        bits = np.random.Generator(np.random.PCG64(code + 7_000_003)).integers(0, 2, DIMENSIONS)
        _vectors[code] = (2 * bits - 1).astype(np.int8)
    return _vectors[code]


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(doc, gram, n, chars)``: each text's distinct n-grams, as base-``len(chars)`` numbers over the batch's characters."""
    lines, lengths = [], []
    for t in texts:
        t = " " + t.lower() + " " if t else "  "
        lines.append(t)
        lengths.append(len(t))
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _kinds()[0][codes]
    doc = np.repeat(np.arange(len(lines)), lengths)
    # One space for each run of others; a run never joins two texts.
    blank = codes == 32
    again = np.zeros(len(codes), bool)
    again[1:] = blank[1:] & blank[:-1] & (doc[1:] == doc[:-1])
    codes, doc = codes[~again], doc[~again]
    chars, small = np.unique(codes, return_inverse=True)
    base = len(chars)
    g = small[: len(small) - GRAM + 1].astype(np.int64)
    for i in range(1, GRAM):
        g = g * base + small[i : len(small) - GRAM + 1 + i]
    one = doc[: len(g)] == doc[GRAM - 1 :]
    g, doc = g[one], doc[: len(one)][one]
    first = np.searchsorted(doc, np.arange(len(lines) + 1))
    docs, grams, ns = [], [], []
    for d, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        u, n = np.unique(g[a:b], return_counts=True)
        grams.append(u)
        ns.append(n)
        docs.append(np.full(len(u), d))
    return np.concatenate(docs), np.concatenate(grams), np.concatenate(ns), chars


def gram_vectors(grams: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Bound vectors of n-grams: the product of rotated letter vectors."""
    letters = np.stack([letter_vector(int(c)) for c in chars]) if len(chars) else np.zeros((0, DIMENSIONS), np.int8)
    out, rest = None, grams
    for back in range(GRAM):
        v = np.roll(letters, back, axis=1)[rest % len(chars)]
        out = v if out is None else out * v
        rest = rest // len(chars)
    return out


def bundle(texts: list[str | None], groups: np.ndarray | None = None, n_groups: int | None = None) -> np.ndarray:
    """The vector of each text, or the sum for each group of texts."""
    doc, gram, n, chars = gram_counts(texts)
    rows = doc if groups is None else groups[doc]
    size = len(texts) if groups is None else n_groups
    out = np.zeros((size, DIMENSIONS), np.float64)
    used, col = np.unique(gram, return_inverse=True)
    for a in range(0, len(used), COLUMNS):
        part = (col >= a) & (col < a + COLUMNS)
        counts = np.zeros((size, min(COLUMNS, len(used) - a)), np.float32)
        np.add.at(counts, (rows[part], col[part] - a), n[part].astype(np.float32))
        out += counts @ gram_vectors(used[a : a + COLUMNS], chars).astype(np.float32)
    return out


def prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """One bundled vector per language from rows ``text, lang``."""
    arrow_batches(labelled.sparkSession)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, size=1 << 20, rows=ROWS):
                names, groups = np.unique(np.array(part.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
                for name, v in zip(names, bundle(part.column("text").to_pylist(), groups, len(names)), strict=True):
                    total[str(name)] = total.get(str(name), 0) + v
        for name, v in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * DIMENSIONS), pa.array(np.arange(DIMENSIONS), pa.int32()), pa.array(np.rint(v).astype(np.int64))], names=["lang", "i", "v"]
            )

    parts = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    sums = parts.mapInArrow(learn, "lang string, i int, v long").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():  # DIMENSIONS rows for each language
        out.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["i"]] = r["v"]
    return dict(sorted((k, v) for k, v in out.items() if np.any(v)))


def predict_language(docs: DataFrame, learned: dict[str, np.ndarray], text_col: str = "text", out_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score from 0 to 1: (1 + cosine) / 2 against the best prototype.

    Only ``text_col`` goes through the prediction; the other columns are carried along.
    """
    arrow_batches(docs.sparkSession)
    names = list(learned)
    unit = np.stack([v / np.linalg.norm(v) for v in learned.values()]) if names else np.zeros((0, DIMENSIONS))
    mean = unit.mean(axis=0) if len(names) > 1 else np.zeros(DIMENSIONS)
    centred = unit - mean
    centred = (centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)).T
    fields = docs.schema.fields

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = _kinds()[1]
        for batch in batches:
            for part in slices(batch, text_col, size=1 << 20, rows=ROWS):
                texts = part.column(text_col).to_pylist()
                v = bundle(texts)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                v -= mean
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                known = np.array([bool(t) and bool(is_letter[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)].any()) for t in texts], bool)
                if names:
                    cosine = v @ centred
                    best = cosine.argmax(axis=1) if len(texts) else np.zeros(0, int)
                    score = np.clip((1 + cosine[np.arange(len(texts)), best]) / 2, 0, 1)
                else:
                    best, score, known = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts), bool)
                said = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(said, pa.string()), pa.array(np.where(known, score, 0.0))], names=[*(f.name for f in fields), out_col, score_col]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.mapInArrow(predict, f"{schema}, `{out_col}` string, `{score_col}` double")


def held_out(id_col: str = "doc_id", modulus: int = 3, remainder: int = 1):
    """True for rows that learning never sees; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col, held_out, lang_pred, score``, learned from the rows that aren't held out."""
    rows = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("_out"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    learned = prototypes(rows.filter(~F.col("_out")).select("text", "lang"))
    said = predict_language(rows.select("_id", "_out", "text"), learned)
    return said.select(F.col("_id").alias(id_col), F.col("_out").alias("held_out"), "lang_pred", "score")
