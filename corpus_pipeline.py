"""A training corpus from raw documents, in five stages that each apply one operator to all that the stage before kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes every stage as Parquet in the shared folder and reads it back for the next.

1. ``language_id``: documents without a recognisable language go; a missing ``lang`` is filled in.
2. ``near_dup``: of near duplicates (five-word shingles, similarity of at least 0.8) the one with the smallest id stays.
3. ``decontamination``: documents that hold a passage of a benchmark item go; what decides is a row's text alone, so rows that share an id, or have none, go or stay each by
   itself.
4. ``pii``: personal data is masked and ``n_chars`` follows the text.
5. ``mixing``: sources are mixed to their target weights; the result is the plan of the mix, one row per document.

Defined results for all stages: a null or empty text, or one without a letter, has no language and goes in the first stage; a null id, source or ``lang`` is a value like others
(a null id is in no group of near duplicates and so stays there); rows with one id are one document to the second stage, and rows of their own to the others; equal rows are each
treated alike; texts are read whole, however long; columns that ``documents`` hasn't are carried through to the last stage, whatever their names; an empty table gives an
empty one.  Ties go to the smallest id, or, for mixing, to the order of the ids' MD5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import decontaminate, language_id, mixing, near_dup, pii
from tickforge.llm.scratch import fresh, materialize

#: The stages have no SQL form: hyperdimensional profiles and MinHash aren't expressible.
ORACLE_SQL = None
#: Rows of a list of text digests (64 bytes each) that may be broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 100_000


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a letter and so a language; where ``lang`` is null it is the predicted one.  Learned from the rows of ``docs`` with a ``lang`` that aren't held
    out; if there are none, no language can be told and every row goes."""
    learned = language_id.prototypes(docs.filter(~language_id.held_out()).select("text", "lang"))
    pred, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    said = language_id.predict_language(docs, learned, "text", pred, score)
    kept = said.filter(F.col(pred) != language_id.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", pred)).select(*docs.columns)


def stage_near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows but those of documents that are linked, over any number of links, with a document of a smaller id.  Null ids and texts without words are linked with nothing."""
    return near_dup.keep_one(docs, width=5, percent=80)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no passage of a benchmark item; ids aren't looked at."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    name = fresh(docs, "hit")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    found = decontaminate.search(decontaminate.build_index(docs.select(digest.alias("doc_id"), "text")), items)
    hit = materialize(found.filter("n_hit > 0").select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    few = hit.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(hit) if few else hit, digest == F.col(name), "left_anti")


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with personal data and secrets in its text masked and ``n_chars`` the length of that; a null text stays null."""
    return pii.redact(docs, length_col="n_chars")


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each row of ``docs``: how many of its words the mix takes, and where in training they are read."""
    return mixing.mix_sources(docs)


STAGES = [
    ("language_id", stage_language_id),
    ("near_dup", stage_near_dup),
    ("decontamination", stage_decontamination),
    ("pii", stage_pii),
    ("mixing", stage_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
