"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import shuffles_released as shuffles_released

# Fixed by the task: what separates words, as a regular expression class body.
WORD_BREAK = r"\x20\x09-\x0D"
WORD = rf"[^{WORD_BREAK}]+"
FOLDS, HELD_OUT_FOLD = 4, 2
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id written as text, modulo 4 (a null id counts as an empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == HELD_OUT_FOLD


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """The maximal runs of non-separators, in order; empty for null or blank text.

    A separator-delimited split leaves an empty string only before a leading
    or after a trailing separator run, so those two ends are all that is cut.
    """
    parts = F.split(F.coalesce(text, F.lit("")), f"[{WORD_BREAK}]+", -1)
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """size(words(text)) without building the filtered array."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{WORD_BREAK}]+", -1)
    return bind(parts, lambda p: (F.size(p)
                                  - F.when(F.get(p, F.lit(0)) == "", 1).otherwise(0)
                                  - F.when((F.size(p) > 1) & (F.element_at(p, -1) == ""), 1).otherwise(0))).cast("long")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id, text, y and weight: at most `per_class` labelled documents of each
    class outside the held-out fold, those with the smallest hash of their id.
    The weight restores the classes' shares. Only the ids of the sample, a
    bounded table, are broadcast."""
    known = (labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(label).alias("y")))
    totals = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    drawn = None
    for y, total in sorted(totals.items()):
        part = (known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
                .withColumn("weight", F.lit(max(1.0, total / per_class))))
        drawn = part if drawn is None else drawn.union(part)
    if drawn is None:
        drawn = known.withColumn("weight", F.lit(1.0))
    # One text for an id that repeats.
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"), F.max("weight").alias("weight")))


def small_batches(spark: SparkSession) -> None:
    """Session setting for steps that hand whole texts to Python: at most BATCH_ROWS rows a batch. A task holds a
    batch several times (Arrow on both sides, strings, arrays), and a worker that serves several stages
    keeps that memory. A lower setting stays. Results do not depend on it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "0")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
