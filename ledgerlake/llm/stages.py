"""The pipeline's stages: (spark, docs, sf_dir) -> DataFrame, each one operator applied to `docs`.

Defined cases: columns beside those of `documents` are dropped; a null, empty or blank text stays in
every stage but the mix, which takes no words from it; texts of any length are handled whole;
repeated rows are rows of their own (the join stage keeps one of them); nulls in doc_id, lang, source
or n_chars are values like others; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, jaccard_join, mixing, pii, toxicity
from ledgerlake.llm.common import table
from ledgerlake.llm.queries import BYTE_BPE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score below the threshold. The classifier learns from
    the labelled rows of these documents outside the held-out fold."""
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, out="_toxic").filter(F.col("_toxic") < toxicity.PREDICT_AT).select(*COLUMNS)


def one_per_near_duplicate_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest doc_id; texts without words stay."""
    return jaccard_join.one_per_component(docs.select(*COLUMNS))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; spans are replaced by their kind, n_chars follows the text."""
    found = pii.find_pii(docs.select(*COLUMNS), out="_pii").withColumn("_text", pii.redact(F.col("text"), F.col("_pii")))
    chars = F.when(F.size("_pii") > 0, F.length("_text")).otherwise(F.col("n_chars")).cast("long")
    return found.select("doc_id", F.col("_text").alias("text"), "lang", "source", chars.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix draws, a row for each copy of a document."""
    return mixing.mixed_texts(docs.select(*COLUMNS))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests of the ids and of the decoded text for each row."""
    return bpe.encoded(docs.select("doc_id", "text"), public_tokenizers.path(BYTE_BPE))
