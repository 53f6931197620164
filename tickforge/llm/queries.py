"""The numbered operators applied to their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, language_id, licenses, lm_score, mixing, near_dup, periodic_runs, pii, quality_rules, simhash, spelling, token_counts, url_filter
from .oracles import ORACLES

TOKENIZER, TOKEN_LIMIT = "word_bpe_49k.json", 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), TOKEN_LIMIT)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components_of(table(spark, sf_dir, "documents"), width=3, percent=85)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(periodic_runs.repeat_tails(table(spark, sf_dir, "documents")))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_documents(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.drop_letters(spelling.words_of(table(spark, sf_dir, "documents")))
    return spelling.group_variants(spelling.vocabulary(words))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_lm_score,
        op3_pii,
        op4_near_dup,
        op5_quality_rules,
        op6_mixing,
        op7_language_id,
        op8_decontamination,
        op9_url_filters,
        op10_license_scans,
        op11_periodic_runs,
        op12_document_fingerprints,
        op13_spelling_variants,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
