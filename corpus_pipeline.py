"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import stages
from ledgerlake.llm.common import table
from ledgerlake.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.drop_toxic),
    ("ngram_jaccard_join", stages.one_per_near_duplicate_group),
    ("pii", stages.redact_pii),
    ("mixing", stages.mix_sources),
    ("bpe", stages.encode_tokens),
]

# A trained classifier comes first, so SQL cannot state the rows; tests/llm
# hold every stage against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order. Each result is a Parquet table in a fresh folder
    below the shared spark.checkpoint.dir, which cuts the lineage."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}_{name}")
        docs = spark.read.parquet(f"{base}/{k}_{name}")
    return docs
