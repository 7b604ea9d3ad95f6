"""Feature engineering of the quarterly panel.

`engineer_features` is a single projection over one shared entity window:
one shuffle by entity, one sort, one Window operator, everything else
stays in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import (
    CATEGORICAL_FEATURES,
    CLUSTER_FEATURES,
    CORE_NUMERIC_COLUMNS,
    DATE_COL,
    NUMERIC_FEATURES,
    TARGET_COL,
)
from ledgerlake.functions import (
    calendar_quarter,
    clip_lower,
    finite_or_null,
    missing_flag,
    positive_flag,
    safe_divide,
    sic2,
    sic_division,
)
from ledgerlake.operators import panel_windows as pw
from ledgerlake.operators.standardize import ROW_ORDER


def calendar_features(date: str = DATE_COL) -> dict:
    d = F.col(date)
    return {
        "calendar_year": F.year(d),
        "calendar_quarter": calendar_quarter(d),
        "calendar_month": F.month(d),
        "is_calendar_year_end": (F.month(d) == 12).cast("int"),
    }


def industry_features() -> dict:
    return {"sic2": sic2("sic"), "sic_division": sic_division("sic")}


def ratio_features(cols: set[str]) -> dict:
    """The 16 level/ratio features (P12); `/` is safe division.
    Expects `oancfq_approx` and `capxq_approx` to be computable columns."""
    c = F.col
    book = c("atq") - c("ltq")
    rst = c("rstcheq") if "rstcheq" in cols else F.lit(None).cast("double")
    return {
        "book_equity_proxy": book,
        "log_assets": F.log1p(clip_lower("atq", 0.0)),
        "liabilities_to_assets": safe_divide("ltq", "atq"),
        "debt_to_assets": safe_divide("dlttq", "atq"),
        "equity_to_assets": safe_divide(book, c("atq")),
        "current_ratio": safe_divide("actq", "lctq"),
        "cash_like_to_assets": safe_divide(rst, c("atq")),
        "roa": safe_divide("niq", "atq"),
        "roe_proxy": safe_divide(c("niq"), book),
        "profit_margin": safe_divide("niq", "saleq"),
        "ebitda_margin": safe_divide("oibdpq", "saleq"),
        "gross_margin": safe_divide(c("saleq") - c("cogsq"), c("saleq")),
        "sgna_to_sales": safe_divide("xsgaq", "saleq"),
        "asset_turnover": safe_divide("saleq", "atq"),
        "operating_cf_to_assets": safe_divide("oancfq_approx", "atq"),
        "capex_to_assets": safe_divide("capxq_approx", "atq"),
    }


GROWTH_COLUMNS = ["sales_growth_qoq", "niq_growth_qoq", "asset_growth_qoq",
                  "days_to_next_observation", "target_next_niq", TARGET_COL, "target_next_sale_growth"]


def window_features(df: DataFrame) -> DataFrame:
    """Calendar, industry, YTD differencing, growth and next-quarter targets: one Window operator."""
    cols = set(df.columns)
    w = pw.entity_window()
    base = [F.col(c) for c in df.columns if c != ROW_ORDER]

    stage1 = {**calendar_features(), **industry_features()}
    stage1["oancfq_approx"] = pw.ytd_to_quarter("oancfy", "oancfy" in cols, w)
    stage1["capxq_approx"] = pw.ytd_to_quarter("capxy", "capxy" in cols, w, floor_zero=True)
    return df.select(*base, *[e.alias(k) for k, e in stage1.items()],
                     pw.growth_qoq("saleq", w).alias("sales_growth_qoq"),
                     pw.growth_qoq("niq", w).alias("niq_growth_qoq"),
                     pw.growth_qoq("atq", w).alias("asset_growth_qoq"),
                     pw.days_to_next(w).alias("days_to_next_observation"),
                     F.lead("niq", 1).over(w).alias("target_next_niq"),
                     pw.next_row_growth("niq", w).alias(TARGET_COL),
                     pw.next_row_growth("saleq", w).alias("target_next_sale_growth"))


def row_features(win: DataFrame, apart: tuple[str, ...] = ()) -> DataFrame:
    """Ratios and missing flags, each from its own row of the window features (or of those columns of them
    that the ratios read); finally every ±Inf/NaN becomes missing (P13). Columns `apart` stay as they are."""
    cols = {c for c in win.columns if c not in apart}
    flags = {f"{c}_missing": missing_flag(c) for c in CORE_NUMERIC_COLUMNS if c in cols}
    out = win.select(*[c for c in win.columns if c in cols and c not in GROWTH_COLUMNS],
                     *[e.alias(k) for k, e in ratio_features(cols).items()],
                     *[e.alias(k) for k, e in flags.items()], *[c for c in GROWTH_COLUMNS if c in cols],
                     positive_flag(TARGET_COL).alias("target_earnings_growth_positive"), *apart)
    return replace_non_finite(out, apart)


def engineer_features(df: DataFrame) -> DataFrame:
    """Calendar, industry, YTD differencing, ratios, missing flags, growth and
    next-quarter targets; finally every ±Inf/NaN becomes missing (P13).
    Window expressions first, ratios read them after."""
    return row_features(window_features(df))


def replace_non_finite(df: DataFrame, apart: tuple[str, ...] = ()) -> DataFrame:
    """±Inf / NaN → missing over every floating column (P13) that is not `apart`."""
    return df.select([finite_or_null(c).alias(c) if t in ("double", "float") and c not in apart else F.col(c)
                      for c, t in df.dtypes])


def missing_flags(df: DataFrame) -> DataFrame:
    """`<col>_missing` indicators for the core columns."""
    return df.withColumns({f"{c}_missing": missing_flag(c) for c in CORE_NUMERIC_COLUMNS if c in df.columns})


def feature_columns(columns: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Numeric, categorical and clustering feature lists over the columns that
    exist (P22): listed numerics plus every `*_missing` indicator."""
    present = set(columns)
    numeric = [c for c in NUMERIC_FEATURES if c in present]
    numeric += [c for c in columns if c.endswith("_missing")]
    categorical = [c for c in CATEGORICAL_FEATURES if c in present]
    cluster = [c for c in CLUSTER_FEATURES if c in present]
    return numeric, categorical, cluster


def model_rows(df: DataFrame, target: str = TARGET_COL) -> DataFrame:
    """Rows that carry a target."""
    return df.where(F.col(target).isNotNull())
