"""Impossible-value treatment and its audit table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import (
    FLOW_RULE,
    NONNEGATIVE_FLOW_COLUMNS,
    NONNEGATIVE_STOCK_COLUMNS,
    STOCK_RULE,
)


def _rules(df: DataFrame) -> list[tuple[str, str]]:
    present = set(df.columns)
    return ([(c, STOCK_RULE) for c in NONNEGATIVE_STOCK_COLUMNS if c in present]
            + [(c, FLOW_RULE) for c in NONNEGATIVE_FLOW_COLUMNS if c in present])


def treat_invalid_values(df: DataFrame) -> DataFrame:
    """Negative stocks and non-negative flows become missing."""
    return df.withColumns({c: F.when(F.col(c) < 0, None).otherwise(F.col(c))
                           for c, _ in _rules(df)})


def invalid_value_audit(df: DataFrame) -> DataFrame:
    """(column, rule, invalid_count) for every treated column, zero counts
    included — one aggregate pass, then an unpivot of a single row (A4)."""
    rules = _rules(df)
    counts = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c, _ in rules])
    stacked = counts.unpivot([], [c for c, _ in rules], "column", "invalid_count")
    rule_of = F.create_map(*[x for c, r in rules for x in (F.lit(c), F.lit(r))])
    return stacked.select("column", rule_of[F.col("column")].alias("rule"),
                          F.col("invalid_count").cast("long").alias("invalid_count"))
