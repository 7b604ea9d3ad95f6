"""Chronological train / validation / test split on distinct dates.

The cut dates are picked from the sorted set of distinct dates. That set is
bounded by the calendar span of the data (one entry per distinct day at
most), not by the row count, so it is gathered in one small aggregate and
handed to the row-level projection as a scalar subquery: no join, no
driver round trip, and the plan stays lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import DATE_COL, TRAIN_FRACTION, VALIDATION_FRACTION
from ledgerlake.functions import date_string
from ledgerlake.operators.quantiles import grouped_median


def _cut_index(n: Column, fraction: float) -> Column:
    """1-based position of the cut: int(n * fraction) in IEEE doubles; an index
    of 0 wraps to the last date (Python's index -1)."""
    k = F.floor(n.cast("double") * F.lit(fraction).cast("double")).cast("int")
    return F.when(k == 0, n).otherwise(k)


def split_cuts(df: DataFrame, date: str = DATE_COL) -> DataFrame:
    """One row: number of distinct dates and the two cut dates."""
    dates = df.where(F.col(date).isNotNull()).agg(F.array_sort(F.collect_set(date)).alias("d"))
    n = F.size("d")
    return dates.select(
        n.alias("n_dates"),
        F.element_at("d", _cut_index(n, TRAIN_FRACTION)).alias("train_end_date"),
        F.element_at("d", _cut_index(n, VALIDATION_FRACTION)).alias("validation_end_date"),
    )


def split_label(date_col: Column, cuts: Column) -> Column:
    train_end = cuts.getField("train_end_date")
    val_end = cuts.getField("validation_end_date")
    return (F.when(date_col <= train_end, F.lit("train"))
            .when(date_col <= val_end, F.lit("validation"))
            .otherwise(F.lit("test")))


def chronological_split(df: DataFrame, date: str = DATE_COL, label: str = "split") -> DataFrame:
    """Add the split label: train up to the 70 % date, validation up to the
    85 % date, test after (C1). Rows with a missing date are labelled test."""
    cuts = split_cuts(df, date).select(F.struct("train_end_date", "validation_end_date")).scalar()
    return df.withColumn(label, split_label(F.col(date), cuts))


def split_notes(df: DataFrame, date: str = DATE_COL) -> DataFrame:
    """The cut dates as yyyy-MM-dd strings."""
    return split_cuts(df, date).select(date_string("train_end_date").alias("train_end_date"),
                                       date_string("validation_end_date").alias("validation_end_date"))


def split_summary(df: DataFrame, label: str = "split", target: str = "target_next_niq_growth",
                  entity: str = "gvkey_str", date: str = DATE_COL, security: str | None = None) -> DataFrame:
    """Per split: rows, distinct companies (and securities), first/last date,
    target mean and exact median (A7, A8). The medians are searched when this is called."""
    # Entities (and securities) first, so that distinct counts and sums are over their keys, not over the rows.
    ids = [entity, *([security] if security else [])]
    keys = df.groupBy(label, *ids).agg(
        F.count(F.lit(1)).alias("n"), F.min(date).alias("first"), F.max(date).alias("last"),
        F.sum(target).alias("sum"), F.count(target).alias("known"))
    aggs = [F.sum("n").alias("rows"), F.count_distinct(entity).alias("companies")]
    if security:
        aggs.append(F.count_distinct(security).alias("permnos"))
    aggs += [
        date_string(F.min("first")).alias("start_date"),
        date_string(F.max("last")).alias("end_date"),
        F.try_divide(F.sum("sum"), F.sum("known")).alias("target_mean"),
    ]
    med = grouped_median(df.select(label, target), [label], [target]).withColumnRenamed(target, "target_median")
    return keys.groupBy(label).agg(*aggs).join(med, label, "left")
