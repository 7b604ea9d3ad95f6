"""Deduplication.

All row-picking dedupes are aggregations with map-side partial aggregation
(sort-based, since the buffers hold whole rows): a hot key (one key or
one set of exact copies holding a large share of all rows) is combined
map-side by the partial aggregate before the shuffle, so no task ever has
to hold or sort a whole hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import DATE_COL, ENTITY_KEY
from ledgerlake.operators.standardize import ROW_ORDER, value_columns

_ROW = "_row"
_RANK = "_rank"


def non_missing_count(cols: list[str]) -> Column:
    """Number of non-missing values across `cols`."""
    return sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))


def dedupe_exact(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (D1). With a file-order column the first
    occurrence's position is kept."""
    cols = value_columns(df)
    if ROW_ORDER in df.columns:
        return df.groupBy(*cols).agg(F.min(ROW_ORDER).alias(ROW_ORDER)).select(df.columns)
    return df.distinct()


def exact_duplicate_count(df: DataFrame) -> DataFrame:
    """rows − distinct rows, as one row."""
    cols = value_columns(df)
    return (df.groupBy(*cols).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("exact_duplicate_rows")))


def key_duplicate_metrics(df: DataFrame, keys=(ENTITY_KEY, DATE_COL)) -> DataFrame:
    """Surplus rows over the key and number of keys holding more than one row."""
    per_key = df.groupBy(*keys).count()
    return per_key.agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_key_rows_before_resolution"),
        F.count_if(F.col("count") > 1).alias("duplicate_key_groups_before_resolution"),
        F.count(F.lit(1)).alias("rows_after_duplicate_resolution"),
    )


def _pick_one(df: DataFrame, keys: list[str], rank: Column, highest: bool) -> DataFrame:
    """Keep one row per key: the one with the largest (or smallest) `rank`.

    `rank` must be a total order within a key for a deterministic result."""
    cols = df.columns
    packed = df.select(*keys, F.struct(*cols).alias(_ROW), rank.alias(_RANK))
    pick = F.max_by if highest else F.min_by
    return (packed.groupBy(*keys)
            .agg(pick(_ROW, _RANK).alias(_ROW))
            .select(*[F.col(f"{_ROW}.{c}").alias(c) for c in cols]))


def dedupe_most_complete(df: DataFrame, keys=(ENTITY_KEY, DATE_COL)) -> DataFrame:
    """One row per key: most non-missing values wins; ties go to the first
    row in file order when the scan recorded it, else to the smallest row by
    value, which is deterministic under any partitioning (D3).

    Applied to raw rows this also removes exact duplicates: copies are equal,
    so picking any of them gives the same output as D1 followed by D3."""
    cols = value_columns(df)
    nn = non_missing_count(cols)
    if ROW_ORDER in df.columns:
        return _pick_one(df, list(keys), F.struct((-nn).alias("nn"), F.col(ROW_ORDER).alias("tie")), highest=False)
    # The row is its own tie-break: it travels once, as part of the rank.
    row = F.min(F.struct((-nn).alias("_nn"), *cols)).alias(_ROW)
    return df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(row).select(
        *[F.col(f"{_ROW}.{c}").alias(c) for c in df.columns])


def dedupe_cusip_month(monthly: DataFrame, prefer_known_cap: bool = False,
                       keys=("cusip8", "month_end"), cap: str = "crsp_market_cap_last",
                       tie: str = "PERMNO") -> DataFrame:
    """One price row per (cusip8, month_end).

    Default: a missing market cap beats any value, then the largest cap,
    ties to the largest security id — the order a stable ascending sort on
    cap with missing last and keep-last produces. `prefer_known_cap=True`
    lets known caps win instead."""
    cap_c = F.col(cap)
    missing_first = cap_c.isNull() if not prefer_known_cap else cap_c.isNotNull()
    rank = F.struct(missing_first.alias("m"), cap_c.alias("cap"), F.col(tie).alias("tie"))
    return _pick_one(monthly, list(keys), rank, highest=True)


def cusip_month_metrics(monthly: DataFrame, keys=("cusip8", "month_end")) -> DataFrame:
    per_key = monthly.groupBy(*keys).count()
    return per_key.agg(
        F.sum("count").cast("long").alias("crsp_monthly_rows_before_cusip_dedupe"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("crsp_duplicate_cusip_month_rows"),
        F.count(F.lit(1)).alias("crsp_monthly_rows"),
    )
