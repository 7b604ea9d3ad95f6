"""Typing and standardisation of the raw quarterly panel.

Every function is a narrow projection or filter: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import DATE_COL, ENTITY_KEY, STRING_COLUMNS
from ledgerlake.functions import clean_string, entity_key, parse_date, to_double

ROW_ORDER = "_row_order"  # optional file-order column attached by the CSV scan


def value_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW_ORDER]


def type_quarterly(df: DataFrame, string_columns=STRING_COLUMNS) -> DataFrame:
    """Clean text columns, parse the period date, derive the entity key and
    coerce every remaining column to a number (P1–P4). Rows are not dropped."""
    dtypes = dict(df.dtypes)
    out = []
    for name in df.columns:
        if name == ROW_ORDER:
            out.append(F.col(name))
        elif name in string_columns:
            out.append(clean_string(name).alias(name))
        elif name == DATE_COL:
            out.append(parse_date(name, dtypes[name]).alias(name))
        elif name == ENTITY_KEY:
            continue
        else:
            out.append(to_double(name, dtypes[name]).alias(name))
    if "gvkey" in df.columns:
        key = entity_key(clean_string("gvkey"))
    else:
        key = F.lit(None).cast("string")
    out.append(key.alias(ENTITY_KEY))
    return df.select(out)


def drop_bad_keys(df: DataFrame, key: str = ENTITY_KEY, date: str = DATE_COL) -> DataFrame:
    """Drop rows whose entity key or date is missing (P5)."""
    return df.na.drop(subset=[key, date])


def standardize_quarterly(df: DataFrame) -> DataFrame:
    return drop_bad_keys(type_quarterly(df))


def standardize_metrics(typed: DataFrame) -> DataFrame:
    """Counts of the typing stage, one aggregate pass over the typed frame."""
    return typed.agg(
        F.count(F.lit(1)).alias("typed_rows"),
        F.count_if(F.col(DATE_COL).isNull()).alias("invalid_datadate_rows"),
        F.count_if(F.col(ENTITY_KEY).isNull()).alias("missing_gvkey_rows"),
        F.count_if(F.col(DATE_COL).isNull() | F.col(ENTITY_KEY).isNull()).alias("rows_dropped_bad_key_or_date"),
    )
