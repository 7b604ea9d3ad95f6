"""The registered queries of the training-data operators: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import (
    ann,
    bloom_lm,
    bpe,
    jaccard_join,
    langid,
    lexical_search,
    mixing,
    periodic_runs,
    pii,
    quality_mil,
    quality_rules,
    token_counts,
    toxicity,
)
from ledgerlake.llm.common import table

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op4_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(table(spark, sf_dir, "documents"))


def op12_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.corpus_scores(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_quality_rules": op2_quality_rules,
    "op3_bpe": op3_bpe,
    "op4_quality_mil": op4_quality_mil,
    "op5_langid": op5_langid,
    "op6_mixing": op6_mixing,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_ann": op10_ann,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_bloom_lm": op12_bloom_lm,
    "op13_lexical_search": op13_lexical_search,
}
