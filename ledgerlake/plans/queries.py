"""Registered queries: one callable (spark, sf_dir) → DataFrame per operator.

Each query reads the driver tables through the fixture views and runs the
library's own operators over whole tables. Computed doubles are rounded to
6 decimals at the very end, identically in the oracle SQL, so that the
comparison does not depend on floating-point summation order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.constants import (
    CATEGORICAL_FEATURES,
    CLUSTER_FEATURES,
    CORE_NUMERIC_COLUMNS,
    CORRELATION_FEATURES,
    NUMERIC_FEATURES,
    PRICE_CATEGORICAL_FEATURES,
    PRICE_NUMERIC_FEATURES,
    PRICE_TARGET_COL,
    TARGET_COL,
)
from ledgerlake.functions import categorical_clean, parse_date
from ledgerlake.operators import dedupe as dd
from ledgerlake.operators import profile as pf
from ledgerlake.operators.features import feature_columns, model_rows, row_features, window_features
from ledgerlake.operators.invalid import invalid_value_audit, treat_invalid_values
from ledgerlake.operators.prep import category_levels, join_levels, numeric_params, transform_numeric
from ledgerlake.operators.prices import (
    daily_profile,
    join_market,
    market_series,
    monthly_aggregates,
    monthly_returns,
    trailing_and_forward_returns,
    type_daily,
)
from ledgerlake.operators.split import split_notes, split_summary
from ledgerlake.operators.standardize import ROW_ORDER, standardize_metrics, standardize_quarterly, type_quarterly
from ledgerlake.operators.unsupervised import cluster_profile, component_residuals, covariance, explained_variance
from ledgerlake.plans import model_frame as mf
from ledgerlake.plans import prices as pp
from ledgerlake.plans import quarterly
from ledgerlake.plans.stages import Stages, Tables
from ledgerlake.sources import fixtures
from ledgerlake.session import path_exists, scratch_path
from ledgerlake.sources.csv_scan import apply_csv_missing, read_daily_csv, read_quarterly_csv
from ledgerlake.sources.discovery import discover_source, duplicate_files

D = 6
KEY = ["gvkey_str", "datadate"]
MKEY = ["PERMNO", "month_end"]


def round_half_up(c, d: int = D):
    """floor(x * 10^d + 0.5) / 10^d: plain IEEE arithmetic, so every engine
    gives the same double (decimal-string rounding differs on exact halves)."""
    scale = float(10 ** d)
    return (F.floor(F.col(c) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def rounded(df: DataFrame, d: int = D) -> DataFrame:
    """Round every double column of a result."""
    return df.select([round_half_up(c, d).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- shared stage builders ---------------------------------------------------

def raw_q(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.panel_q_raw(spark, sf)


def typed_q(spark, sf):
    return standardize_quarterly(raw_q(spark, sf))


def deduped_q(spark, sf):
    return dd.dedupe_most_complete(typed_q(spark, sf))


STAGES = Stages()


def _stage(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame], keep: bool = True) -> DataFrame:
    """A frame read by many queries: built once per input, and kept unless `keep` is false.

    The wide frames (panel, link, price model) are not kept: at some GB three copies of 100 columns
    would fill the executors' memory, whatever few columns a query asks for. Queries that read their
    rows more than once (cut dates, then rows; passes of a fit) keep the columns that they need."""
    return STAGES.frame(spark, (fixtures.source_key(spark, sf), name), build, keep)


def engineered(spark: SparkSession, sf: str) -> DataFrame:
    return _stage(spark, sf, "engineered", lambda: quarterly.engineered_panel(raw_q(spark, sf)), keep=False)


def model(spark: SparkSession, sf: str, cols: list[str] | None = None) -> DataFrame:
    """The labelled model rows. With `cols`, these columns (and the key and target) of the rows are
    kept, for a query that reads them more than once."""
    if cols is None:
        return quarterly.model_frame(engineered(spark, sf))
    own = list(dict.fromkeys([*KEY, *cols, TARGET_COL]))
    kept = _stage(spark, sf, f"model {','.join(own)}", lambda: model_rows(engineered(spark, sf)).select(*own))
    return quarterly.model_frame(kept)


def cluster_model(spark, sf):
    """The model rows with the clustering features."""
    _, _, cols = feature_columns(engineered(spark, sf).columns)
    return model(spark, sf, cols)


def typed_d(spark, sf):
    return type_daily(fixtures.panel_d(spark, sf))


def monthly_raw(spark, sf):
    """Monthly aggregates, read twice by everything below: the daily rows are scanned once."""
    return _stage(spark, sf, "monthly", lambda: monthly_aggregates(typed_d(spark, sf)))


def monthly_joined(spark, sf):
    return monthly_returns(monthly_raw(spark, sf))


def monthly_final(spark, sf):
    return _stage(spark, sf, "monthly_final", lambda: dd.dedupe_cusip_month(monthly_joined(spark, sf)), keep=False)


def merged(spark, sf):
    return _stage(spark, sf, "merged", lambda: pp.linked_panel(engineered(spark, sf), monthly_final(spark, sf)), keep=False)


def price_model(spark, sf, cols: list[str] | None = None):
    """The labelled linked rows with a price target; with `cols`, these columns of them are kept (as in `model`)."""
    if cols is None:
        return _stage(spark, sf, "price_model", lambda: pp.price_model_frame(merged(spark, sf)), keep=False)
    own = list(dict.fromkeys([*KEY, *cols, PRICE_TARGET_COL]))
    kept = _stage(spark, sf, f"price_model {','.join(own)}",
                  lambda: merged(spark, sf).where(F.col(PRICE_TARGET_COL).isNotNull()).select(*own))
    return pp.price_model_frame(kept)


def _eng_cols(spark, sf, cols):
    return rounded(engineered(spark, sf).select(*KEY, *cols))


# --- sources -----------------------------------------------------------------

def q_scan_quarterly(spark, sf):
    """Quarterly panel as CSV text → missing spellings → typed, keyed rows."""
    text = apply_csv_missing(fixtures.as_text(raw_q(spark, sf)))
    return rounded(standardize_quarterly(text))


def q_scan_daily(spark, sf):
    """Daily price panel as CSV text → missing spellings → typed columns."""
    text = apply_csv_missing(fixtures.as_text(fixtures.panel_d(spark, sf)))
    t = type_daily(text)
    return rounded(t.select("PERMNO", "PERMCO", "HdrCUSIP", "PrimaryExch", "ShareType", "Ticker",
                            "DlyCalDt", "DlyPrc", "DlyRet", "DlyVol", "ShrOut"))


def _csv_folder(spark, sf, name, build) -> str:
    """The panel as CSV files in the shared scratch folder, written once a session and input:
    every field quoted where it must be, and a note column of quotes, commas and line breaks."""
    tag = hashlib.sha256(f"{spark.sparkContext.applicationId} {fixtures.source_key(spark, sf)}".encode()).hexdigest()[:16]
    path = scratch_path(spark, f"csv-{tag}-{name}")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        text = fixtures.as_text(build())
        key = F.coalesce(F.col(text.columns[0]), F.lit("none"))
        note = F.when(F.crc32(key.cast("binary")) % 3 > 0, F.concat(F.lit('say "'), key, F.lit('",\n'), F.repeat(F.lit("\n"), F.length(key)), key))
        text.withColumn("note", note).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def q_scan_quarterly_csv(spark, sf):
    """Quarterly CSV files with quoted line breaks, read in splits → typed, keyed rows."""
    raw = read_quarterly_csv(spark, _csv_folder(spark, sf, "quarterly", lambda: raw_q(spark, sf)))
    return rounded(standardize_quarterly(raw.drop("note", ROW_ORDER)))


def q_scan_daily_csv(spark, sf):
    """Daily CSV files with quoted line breaks, read in splits → typed columns."""
    raw = read_daily_csv(spark, _csv_folder(spark, sf, "daily", lambda: fixtures.panel_d(spark, sf)))
    return rounded(type_daily(raw).select("PERMNO", "PERMCO", "HdrCUSIP", "PrimaryExch", "ShareType", "Ticker",
                                          "DlyCalDt", "DlyPrc", "DlyRet", "DlyVol", "ShrOut"))


def q_discover_source(spark, sf):
    """Largest input file whose columns include the required set (S3)."""
    return discover_source(spark, sf, ["l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"],
                           fmt="parquet", exclude=["orders.parquet"])


def q_duplicate_files(spark, sf):
    """Exact duplicate input files by size then SHA-256."""
    return duplicate_files(spark, sf, pattern="*.parquet")


# --- projections / scalar functions -----------------------------------------

def q_clean_strings(spark, sf):
    """Text cleaning of the descriptive columns."""
    t = type_quarterly(raw_q(spark, sf))
    return t.select(F.col("gvkey_str"), "datadate", "gvkey", "costat", "curcdq", "cusip")


def q_parse_dates(spark, sf):
    """Period dates from text, bad → missing."""
    text = raw_q(spark, sf).select("gvkey", F.col("datadate").cast("string").alias("datadate_text"))
    return text.select("gvkey", "datadate_text", parse_date("datadate_text").alias("datadate"))


def q_entity_key(spark, sf):
    """Entity key: first digit run, zero-padded to 6."""
    t = type_quarterly(raw_q(spark, sf))
    return t.select("gvkey", "gvkey_str")


def q_coerce_numeric(spark, sf):
    """Numeric coercion of text columns, unparseable → missing."""
    text = fixtures.as_text(raw_q(spark, sf))
    return rounded(type_quarterly(text).drop("costat", "curcdq", "cusip"))


def q_drop_bad_keys(spark, sf):
    """Typing counts: bad dates, missing keys, dropped rows (P5)."""
    return standardize_metrics(type_quarterly(raw_q(spark, sf)))


def q_invalid_to_null(spark, sf):
    """Impossible negatives → missing."""
    t = treat_invalid_values(deduped_q(spark, sf))
    return rounded(t.select(*KEY, "actq", "atq", "dlttq", "lctq", "ltq", "rstcheq", "rstcheltq",
                            "saleq", "cogsq", "xsgaq", "capxy"))


def q_calendar_features(spark, sf):
    """Calendar year, quarter, month, year-end flag."""
    return _eng_cols(spark, sf, ["calendar_year", "calendar_quarter", "calendar_month", "is_calendar_year_end"])


def q_sic2(spark, sf):
    """Two-digit industry."""
    return _eng_cols(spark, sf, ["sic", "sic2"])


def q_sic_division(spark, sf):
    """Industry division (P10)."""
    return _eng_cols(spark, sf, ["sic", "sic_division"])


RATIOS = ["book_equity_proxy", "log_assets", "liabilities_to_assets", "debt_to_assets", "equity_to_assets",
          "current_ratio", "cash_like_to_assets", "roa", "roe_proxy", "profit_margin", "ebitda_margin",
          "gross_margin", "sgna_to_sales", "asset_turnover", "operating_cf_to_assets", "capex_to_assets"]


def q_financial_ratios(spark, sf):
    """The 16 level/ratio features with safe division."""
    return _eng_cols(spark, sf, RATIOS)


def q_missing_flags(spark, sf):
    """Missing indicators of the core columns after treatment."""
    return _eng_cols(spark, sf, [f"{c}_missing" for c in CORE_NUMERIC_COLUMNS])


def q_categorical_clean(spark, sf):
    """Categorical inputs: missing → "Unknown" (P18)."""
    e = engineered(spark, sf)
    cats = [c for c in CATEGORICAL_FEATURES if c in e.columns]
    return e.select(*KEY, *[categorical_clean(c).alias(c) for c in cats])


def q_model_rows(spark, sf):
    """Rows carrying the next-quarter target."""
    return rounded(model_rows(engineered(spark, sf)).select(*KEY, TARGET_COL))


def q_drop_bad_price_keys(spark, sf):
    """Price-side drop of rows missing security, day, link key or month, with counts."""
    p = daily_profile(typed_d(spark, sf))
    return p.select("crsp_raw_rows", "crsp_rows_dropped_bad_key_or_date",
                    F.date_format("crsp_min_date", "yyyy-MM-dd").alias("crsp_min_date"),
                    F.date_format("crsp_max_date", "yyyy-MM-dd").alias("crsp_max_date"),
                    "crsp_unique_permnos", "crsp_unique_cusip8")


def q_cusip8_panel(spark, sf):
    """Panel-side link key."""
    m = merged(spark, sf)
    return m.select(*KEY, "cusip", "cusip8", "month_end")


def q_cusip8_price(spark, sf):
    """Price-side link key."""
    return typed_d(spark, sf).select("PERMNO", "DlyCalDt", "HdrCUSIP", "cusip8")


def q_price_scalars(spark, sf):
    """abs price, market cap, dollar volume, month end, 1 + floored return."""
    return rounded(typed_d(spark, sf).select("PERMNO", "DlyCalDt", "price_abs", "market_cap",
                                             "dollar_volume", "month_end", "ret_plus"), 4)


# --- dedupe -------------------------------------------------------------------

def q_dedupe_exact(spark, sf):
    """Exact duplicate rows removed after typing."""
    return rounded(dd.dedupe_exact(typed_q(spark, sf)))


def q_dup_key_metrics(spark, sf):
    """Exact-duplicate count and key-duplicate metrics."""
    typed = typed_q(spark, sf)
    exact = dd.exact_duplicate_count(typed)
    keys = dd.key_duplicate_metrics(dd.dedupe_exact(typed))
    return pf.attach_scalars(exact, keys)


def q_dedupe_most_complete(spark, sf):
    """One row per (entity, date): most complete wins (D3)."""
    return rounded(deduped_q(spark, sf))


def q_dedupe_cusip_month(spark, sf):
    """One monthly price row per (cusip8, month)."""
    return rounded(monthly_final(spark, sf).select(
        "cusip8", "month_end", "PERMNO", "crsp_market_cap_last", "crsp_ret_1m", PRICE_TARGET_COL), 4)


# --- windows -------------------------------------------------------------------

def q_ytd_to_quarter(spark, sf):
    """Year-to-date → quarterly differences."""
    return _eng_cols(spark, sf, ["oancfy", "capxy", "oancfq_approx", "capxq_approx"])


def q_growth_qoq(spark, sf):
    """Growth over the previous row of the entity."""
    return _eng_cols(spark, sf, ["sales_growth_qoq", "niq_growth_qoq", "asset_growth_qoq"])


def q_next_quarter_target(spark, sf):
    """Next-row targets with the 45–190 day gap rule."""
    return _eng_cols(spark, sf, ["days_to_next_observation", "target_next_niq", TARGET_COL,
                                 "target_next_sale_growth", "target_earnings_growth_positive"])


def q_daily_to_monthly(spark, sf):
    """Daily → monthly aggregation per (security, month) (A5)."""
    m = monthly_raw(spark, sf)
    return rounded(m.select(*MKEY, "cusip8", "crsp_ticker", "permco", "primary_exch", "share_type",
                            "crsp_obs_days", "crsp_ret_1m", "crsp_vol_1m", "crsp_avg_volume_1m",
                            "crsp_avg_dollar_volume_1m", "crsp_price_last", "crsp_market_cap_last",
                            "crsp_date_last", "crsp_log_ret_1m"), 4)


def q_trailing_returns(spark, sf):
    """Trailing 3/6/12-month compounded returns with minimum observations."""
    m = trailing_and_forward_returns(monthly_raw(spark, sf))
    return rounded(m.select(*MKEY, "crsp_ret_3m", "crsp_ret_6m", "crsp_ret_12m"))


def q_forward_returns(spark, sf):
    """Forward 3-month compounded return."""
    m = trailing_and_forward_returns(monthly_raw(spark, sf))
    return rounded(m.select(*MKEY, "target_crsp_return_3m"))


def q_market_mean(spark, sf):
    """Equal-weight market return per month."""
    return rounded(market_series(monthly_raw(spark, sf)).select("month_end", "market_ret_1m"))


def q_market_forward(spark, sf):
    """Market forward 3-month return over the monthly market series."""
    return rounded(market_series(monthly_raw(spark, sf)).select("month_end", "market_return_fwd_3m"))


def q_market_join(spark, sf):
    """Monthly rows ⟕ market series on month."""
    m = monthly_raw(spark, sf)
    j = join_market(trailing_and_forward_returns(m), market_series(m))
    return rounded(j.select(*MKEY, "market_return_fwd_3m"))


def q_excess_return_target(spark, sf):
    """Forward return minus market forward return."""
    return rounded(monthly_joined(spark, sf).select(*MKEY, "target_crsp_return_3m", "market_return_fwd_3m",
                                                    PRICE_TARGET_COL))


# --- joins ----------------------------------------------------------------------

def q_panel_price_join(spark, sf):
    """Quarterly panel ⟕ monthly prices on (cusip8, month_end)."""
    m = merged(spark, sf)
    return rounded(m.select(*KEY, "cusip8", "month_end", "PERMNO", "permco", "crsp_ticker", "primary_exch",
                            "share_type", "crsp_obs_days", "crsp_ret_1m", "crsp_ret_3m", "crsp_ret_12m",
                            "crsp_price_last", PRICE_TARGET_COL), 4)


def q_write_back(spark, sf):
    """Split labels written back onto the full panel, missing off the model rows."""
    return mf.write_back(engineered(spark, sf)).select(*KEY, "split")


# --- aggregations / profiles -----------------------------------------------------

def q_panel_profile(spark, sf):
    """Engineered panel profile (A1)."""
    return pf.panel_profile(engineered(spark, sf))


def q_missingness(spark, sf):
    """Missingness of every engineered column (A2)."""
    return rounded(pf.missingness(engineered(spark, sf)))


def q_high_missing(spark, sf):
    """Columns more than 90 % missing (A3)."""
    return rounded(pf.high_missing(pf.missingness(engineered(spark, sf))))


def q_invalid_audit(spark, sf):
    """Invalid-value audit (A4)."""
    return invalid_value_audit(deduped_q(spark, sf))


def q_feature_correlations(spark, sf):
    """Pairwise Pearson correlations over the model rows (A10)."""
    return rounded(pf.feature_correlations(model(spark, sf, CORRELATION_FEATURES)))


def q_missingness_top20(spark, sf):
    """Top-20 missingness (%) of the panel after the split/cluster write-back."""
    _, art = _clustered(spark, sf)
    wb = mf.write_back(engineered(spark, sf), art)
    return rounded(pf.top_missing(pf.missingness(wb)))


def q_price_profile(spark, sf):
    """Price scan / dedupe profile."""
    t = typed_d(spark, sf)
    return pf.price_profile(daily_profile(t), dd.cusip_month_metrics(monthly_joined(spark, sf)),
                            monthly_final(spark, sf), PRICE_TARGET_COL)


def q_merge_profile(spark, sf):
    """Link profile: rows, matched, model rows, rows per split."""
    # Read for the counts, the cut dates and the labels.
    linked = _stage(spark, sf, "linked", lambda: merged(spark, sf).select("datadate", "PERMNO", PRICE_TARGET_COL))
    return pf.merge_profile(linked, pp.price_model_frame(linked), PRICE_TARGET_COL)


# --- split ---------------------------------------------------------------------

def q_chronological_split(spark, sf):
    """Train / validation / test label on distinct-date cuts."""
    return model(spark, sf, KEY).select(*KEY, "split")


def q_split_cuts(spark, sf):
    """The two cut dates of the quarterly split (C1 notes)."""
    return split_notes(model_rows(engineered(spark, sf)))


def q_split_summary(spark, sf):
    """Split summary of the next-quarter earnings-growth target."""
    return rounded(split_summary(model(spark, sf, KEY)))


def q_price_split(spark, sf):
    """Chronological split of the linked rows with a price target."""
    return price_model(spark, sf, ["PERMNO"]).select(*KEY, "PERMNO", "crsp_split")


def q_price_split_summary(spark, sf):
    """Split summary of the excess-return target."""
    s = split_summary(price_model(spark, sf, ["PERMNO"]), label="crsp_split", target=PRICE_TARGET_COL, security="PERMNO")
    return rounded(s)


# --- preprocessing ------------------------------------------------------------

def _cluster_params(spark, sf):
    tr = mf.train_rows(cluster_model(spark, sf))
    _, _, cols = feature_columns(tr.columns)
    return tr, numeric_params(tr, cols)


def q_impute_median(spark, sf):
    """Training medians of the clustering features (M1)."""
    tr, p = _cluster_params(spark, sf)
    return rounded(p.table(spark).select("feature", "median"))


def q_clip_quantiles(spark, sf):
    """Training 1 % / 99 % quantiles of the imputed values (M2)."""
    tr, p = _cluster_params(spark, sf)
    return rounded(p.table(spark).select("feature", "lower", "upper"))


def q_standard_scale(spark, sf):
    """Training mean and population std of the clipped values (M3)."""
    tr, p = _cluster_params(spark, sf)
    return rounded(p.table(spark).select("feature", "mean", "scale"))


def q_numeric_pipeline(spark, sf):
    """Impute → clip → scale applied to every model row (M4)."""
    m = cluster_model(spark, sf)
    _, _, cols = feature_columns(m.columns)
    p = numeric_params(mf.train_rows(m), cols)
    return rounded(transform_numeric(m, p).select(*KEY, *cols), 4)


def q_one_hot_levels(spark, sf):
    """Training level table with infrequent pooling of the categorical inputs (M5)."""
    cats = [c for c in CATEGORICAL_FEATURES if c in engineered(spark, sf).columns]
    return category_levels(mf.train_rows(model(spark, sf, cats)), cats)


def q_one_hot_rows(spark, sf):
    """The training level and slot of every model row's categorical inputs, by joins (M5)."""
    cats = [c for c in CATEGORICAL_FEATURES if c in engineered(spark, sf).columns]
    m = model(spark, sf, cats)
    coded = join_levels(m, category_levels(mf.train_rows(m), cats), cats)
    return coded.select(*KEY, *[x for c in cats for x in (f"{c}_level", f"{c}_slot")])


_FITS: dict = {}


def forget(spark: SparkSession) -> None:
    """Release what queries of this session keep: persisted stages and fitted models."""
    STAGES.release(spark)
    _FITS.clear()


def _fit(spark, sf, rows: Callable[[], DataFrame], restarts=None):
    key = (spark.sparkContext.applicationId, sf, restarts)
    if key not in _FITS:
        _, _FITS[key] = mf.fit_clusters(rows(), restarts=restarts)
    return _FITS[key]


def _clustered(spark, sf, restarts=None, cols=None):
    """Model rows (the clustering features, or `cols` beside them) with cluster features. The fit
    (numeric pipeline, PCA, k-means restarts on the training rows) is done once per session and
    input folder and reused, as a fitted model is."""
    m = cluster_model(spark, sf)
    art = _fit(spark, sf, lambda: m, restarts)
    from ledgerlake.operators.unsupervised import add_cluster_features
    return add_cluster_features(model(spark, sf, [*art.features, *cols]) if cols else m, art), art


def q_feature_vectors(spark, sf):
    """Fitted preprocessor (numeric + one-hot) → feature vectors of the model rows (M6)."""
    num, cat, _ = feature_columns(engineered(spark, sf).columns)
    m, _ = _clustered(spark, sf, restarts=None, cols=[*num, *cat])
    num, cat, _ = feature_columns(m.columns)  # with the cluster features
    pipe = mf.fit_preprocessor(mf.train_rows(m), num, cat)
    out = pipe.transform(m)
    return out.select(*KEY, "split", vector_to_array("features").alias("features"))


def q_pca_features(spark, sf):
    """Two sign-fixed principal components of the scaled clustering features (M7)."""
    m, _ = _clustered(spark, sf, restarts=None)
    return rounded(m.select(*KEY, "cluster_pca1", "cluster_pca2"))


def q_kmeans_clusters(spark, sf):
    """k-means (k=6, seeded restarts, lowest cost) labels for every model row (M8)."""
    m, _ = _clustered(spark, sf)
    return m.select(*KEY, "split", "finance_cluster")


def q_cluster_profile(spark, sf):
    """Per-cluster training medians and counts."""
    m, art = _clustered(spark, sf, restarts=None)
    return cluster_profile(mf.train_rows(m), art.features)


def q_cluster_profile_by_quarter(spark, sf):
    """A9 over the training rows with the calendar quarter in the label's place,
    so that the medians and counts can be compared in SQL."""
    tr = mf.train_rows(cluster_model(spark, sf)).withColumn("finance_cluster", F.concat(F.lit("cluster_"), F.quarter("datadate").cast("string")))
    return rounded(cluster_profile(tr, CLUSTER_FEATURES))


def q_pca_explained_variance(spark, sf):
    """PCA explained-variance ratios, measured on the training rows."""
    m, art = _clustered(spark, sf, restarts=None)
    return explained_variance(mf.train_rows(m), art)


def q_pca_covariance(spark, sf):
    """Covariance of the scaled clustering features over the training rows (M7)."""
    tr, p = _cluster_params(spark, sf)
    c = covariance(tr.select(*[p.scaled(c).alias(c) for c in p.cols]), p.cols)
    return rounded(c.select("feature_a", "feature_b", "covariance"))


def q_pca_residuals(spark, sf):
    """Residual of each principal component as an eigenvector of the training covariance (M7)."""
    m, art = _clustered(spark, sf, restarts=None)
    return rounded(component_residuals(mf.train_rows(m), art))


def q_plot_sample(spark, sf):
    """Seeded sample of at most 25,000 plottable model rows."""
    m, _ = _clustered(spark, sf, restarts=None)
    return pf.plot_sample(m).select(*KEY, "finance_cluster", "cluster_pca1", "cluster_pca2")


def _price_train(spark, sf, cols):
    """Columns of the linked training rows, before cluster features are written back."""
    return mf.train_rows(price_model(spark, sf, cols), "crsp_split")


def q_price_one_hot_levels(spark, sf):
    """Level table of the price model's categorical inputs, fitted on the linked training rows (M9)."""
    cats = [c for c in [*CATEGORICAL_FEATURES, *PRICE_CATEGORICAL_FEATURES] if c in merged(spark, sf).columns]
    return category_levels(_price_train(spark, sf, cats), cats)


def q_price_numeric_params(spark, sf):
    """Numeric parameters of the price model's inputs, fitted on the linked training rows,
    but for the two principal components (M9)."""
    num, _, _ = feature_columns(merged(spark, sf).columns)
    cols = [*num, *PRICE_NUMERIC_FEATURES]
    return rounded(numeric_params(_price_train(spark, sf, cols), cols).table(spark), 4)


def q_price_numeric_pipeline(spark, sf):
    """Price-model preprocessor fitted on the linked training rows (M9): parameters
    of the numeric pipeline over panel + price features.

    Every step ends in a table, so that the panel is computed once and disk holds one step at a time. The tables hold
    the columns that the features are computed from, and the features of a row follow after the link."""
    read = {*KEY, "cusip", TARGET_COL, *CORE_NUMERIC_COLUMNS, *NUMERIC_FEATURES}
    prices = (PRICE_TARGET_COL, *PRICE_NUMERIC_FEATURES)
    with Tables(spark) as tables:
        final = tables.write("prices", pp.monthly_prices(fixtures.panel_d(spark, sf), stage=lambda m: tables.write("monthly", m)))
        tables.drop("monthly")
        windows = window_features(quarterly.cleaned_panel(tables.write("raw", raw_q(spark, sf))))
        panel = tables.write("panel", windows.select([c for c in windows.columns if c in read]))
        tables.drop("raw")
        art = _fit(spark, sf, lambda: quarterly.model_frame(row_features(panel)))
        linked = tables.write("linked", pp.linked_panel(panel, final).where(F.col(PRICE_TARGET_COL).isNotNull())
                              .select(*panel.columns, *prices))
        wb = mf.write_back(row_features(linked, prices), art, panel=row_features(panel))
        num, _, _ = feature_columns(wb.columns)
        num = num + [c for c in PRICE_NUMERIC_FEATURES if c not in num]
        tr = mf.train_rows(pp.price_model_frame(wb.select("datadate", PRICE_TARGET_COL, *num)), "crsp_split")
        return rounded(numeric_params(tr, num).table(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources
    "scan_quarterly": q_scan_quarterly,
    "scan_daily": q_scan_daily,
    "scan_quarterly_csv": q_scan_quarterly_csv,
    "scan_daily_csv": q_scan_daily_csv,
    "discover_source": q_discover_source,
    "duplicate_files": q_duplicate_files,
    # projections
    "clean_strings": q_clean_strings,
    "parse_dates": q_parse_dates,
    "entity_key": q_entity_key,
    "coerce_numeric": q_coerce_numeric,
    "drop_bad_keys": q_drop_bad_keys,
    "invalid_to_null": q_invalid_to_null,
    "calendar_features": q_calendar_features,
    "sic2": q_sic2,
    "sic_division": q_sic_division,
    "financial_ratios": q_financial_ratios,
    "missing_flags": q_missing_flags,
    "categorical_clean": q_categorical_clean,
    "model_rows": q_model_rows,
    "drop_bad_price_keys": q_drop_bad_price_keys,
    "cusip8_panel": q_cusip8_panel,
    "cusip8_price": q_cusip8_price,
    "price_scalars": q_price_scalars,
    # dedupe
    "dedupe_exact": q_dedupe_exact,
    "dup_key_metrics": q_dup_key_metrics,
    "dedupe_most_complete": q_dedupe_most_complete,
    "dedupe_cusip_month": q_dedupe_cusip_month,
    # windows
    "ytd_to_quarter": q_ytd_to_quarter,
    "growth_qoq": q_growth_qoq,
    "next_quarter_target": q_next_quarter_target,
    "daily_to_monthly": q_daily_to_monthly,
    "trailing_returns": q_trailing_returns,
    "forward_returns": q_forward_returns,
    "market_mean": q_market_mean,
    "market_forward": q_market_forward,
    "market_join": q_market_join,
    "excess_return_target": q_excess_return_target,
    # joins
    "panel_price_join": q_panel_price_join,
    "write_back": q_write_back,
    # profiles
    "panel_profile": q_panel_profile,
    "missingness": q_missingness,
    "high_missing": q_high_missing,
    "invalid_audit": q_invalid_audit,
    "feature_correlations": q_feature_correlations,
    "missingness_top20": q_missingness_top20,
    "price_profile": q_price_profile,
    "merge_profile": q_merge_profile,
    # split
    "chronological_split": q_chronological_split,
    "split_cuts": q_split_cuts,
    "split_summary": q_split_summary,
    "price_split": q_price_split,
    "price_split_summary": q_price_split_summary,
    # preprocessing / unsupervised
    "impute_median": q_impute_median,
    "clip_quantiles": q_clip_quantiles,
    "standard_scale": q_standard_scale,
    "numeric_pipeline": q_numeric_pipeline,
    "one_hot_levels": q_one_hot_levels,
    "one_hot_rows": q_one_hot_rows,
    "price_one_hot_levels": q_price_one_hot_levels,
    "price_numeric_params": q_price_numeric_params,
    "feature_vectors": q_feature_vectors,
    "pca_features": q_pca_features,
    "kmeans_clusters": q_kmeans_clusters,
    "cluster_profile": q_cluster_profile,
    "cluster_profile_by_quarter": q_cluster_profile_by_quarter,
    "pca_covariance": q_pca_covariance,
    "pca_residuals": q_pca_residuals,
    "pca_explained_variance": q_pca_explained_variance,
    "plot_sample": q_plot_sample,
    "price_numeric_pipeline": q_price_numeric_pipeline,
}
