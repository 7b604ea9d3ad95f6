"""End-to-end run: raw CSV inputs → cleaned panel, splits, fitted artifacts,
monthly prices, linked panel and audit tables under one output folder.

Long lineages are cut by writing each reused stage as a table in the output
folder and reading it back (reliable on a cluster where executors can be
lost; no local checkpoints, no machine-local folders).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.constants import PRICE_CATEGORICAL_FEATURES, PRICE_NUMERIC_FEATURES, PRICE_TARGET_COL
from ledgerlake.operators import dedupe as dd
from ledgerlake.operators import profile as pf
from ledgerlake.operators.features import feature_columns
from ledgerlake.operators.invalid import invalid_value_audit
from ledgerlake.operators.prices import daily_profile, daily_to_monthly, drop_bad_price_keys, monthly_returns, type_daily
from ledgerlake.operators.split import split_notes, split_summary
from ledgerlake.operators.standardize import standardize_metrics, type_quarterly
from ledgerlake.operators.unsupervised import cluster_profile
from ledgerlake.plans import model_frame as mf
from ledgerlake.plans import prices as pp
from ledgerlake.plans import quarterly
from ledgerlake.sources import sinks
from ledgerlake.constants import PRICE_REQUIRED_COLUMNS
from ledgerlake.sources.csv_scan import read_daily_csv, read_quarterly_csv
from ledgerlake.sources.discovery import discover_source, duplicate_files, file_fingerprint


def _stage(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    sinks.write_table(df, path)
    return spark.read.parquet(path)


def source_profile(spark: SparkSession, quarterly_file: str) -> tuple[DataFrame, str | None]:
    """Fingerprint of the raw quarterly file, byte-identical copies of it in
    its folder, and the largest other CSV there with the price columns
    (S3, S4). Returns (one-row profile, detected price file or None)."""
    folder, name = os.path.split(quarterly_file)
    fp = file_fingerprint(spark, quarterly_file).first()
    dups = [r["path"].rsplit("/", 1)[-1] for r in duplicate_files(spark, folder, "*.csv").collect()
            if r["sha256"] == fp["sha256"] and not r["path"].endswith("/" + name)]
    found = discover_source(spark, folder, PRICE_REQUIRED_COLUMNS, fmt="csv", exclude=[name]).collect()
    price = found[0]["path"] if found else None
    prof = spark.createDataFrame(
        [(fp["sha256"], int(fp["length"]), dups, price.rsplit("/", 1)[-1] if price else None)],
        "raw_sha256 string, raw_bytes long, raw_duplicate_files array<string>, crsp_file_detected string")
    return prof, price


def data_profile(engineered: DataFrame, raw: DataFrame, standard: DataFrame, model: DataFrame, art) -> DataFrame:
    """One row on the whole run (K3): rows and dates, dropped and duplicate rows,
    cut dates and rows of the splits, feature lists, columns that are mostly
    missing, explained variance."""
    numeric, categorical, cluster_cols = feature_columns(model.columns)
    splits = model.agg(F.count(F.lit(1)).alias("model_rows"),
                       *[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in ("train", "validation", "test")])
    mostly = pf.high_missing(pf.missingness(engineered)).agg(F.array_sort(F.collect_list("column")).alias("high_missing_columns"))
    lists = {"numeric_features": numeric, "categorical_features": categorical, "cluster_features": cluster_cols}
    return pf.attach_scalars(
        pf.panel_profile(engineered), standardize_metrics(type_quarterly(raw)), dd.exact_duplicate_count(standard),
        dd.key_duplicate_metrics(standard), splits, split_notes(model), mostly).select(
            "*", *[F.array(*map(F.lit, v)).alias(k) for k, v in lists.items()],
            F.array(*map(F.lit, art.explained_variance_ratio)).alias("pca_explained_variance_ratio"))


def run(spark: SparkSession, quarterly_path: str, out: str, daily_path: str | None = None,
        raw_quarterly: DataFrame | None = None, raw_daily: DataFrame | None = None,
        discover_prices: bool = False) -> dict:
    """Run all flows; returns the output paths. Raw frames may be passed in
    instead of CSV paths (e.g. parquet inputs). With `discover_prices`, a
    single quarterly CSV file is fingerprinted, copies of it are listed and
    the price file is looked up in the same folder when none is given."""
    p = lambda name: os.path.join(out, name)
    raw = raw_quarterly if raw_quarterly is not None else read_quarterly_csv(spark, quarterly_path)
    if discover_prices and quarterly_path:
        prof, detected = source_profile(spark, quarterly_path)
        sinks.write_profile_json(prof, p("source_profile"))
        daily_path = daily_path or detected

    # Flow A
    engineered = _stage(spark, quarterly.engineered_panel(raw), p("engineered_panel"))
    standard = quarterly.standardize_quarterly(raw)
    sinks.write_audit_csv(invalid_value_audit(dd.dedupe_most_complete(standard)), p("invalid_values"))
    sinks.write_audit_csv(pf.missingness(engineered).orderBy(F.col("missing_pct").desc(), "column"),
                          p("missingness"))

    # Flow B
    model = quarterly.model_frame(engineered)
    model, art = mf.fit_clusters(model)
    model = _stage(spark, model, p("model_frame"))
    numeric, categorical, cluster_cols = feature_columns(model.columns)
    train = mf.train_rows(model)
    prep = mf.fit_preprocessor(train, numeric, categorical)
    sinks.save_model(prep, p("preprocessing_pipeline"))
    sinks.save_clusters(spark, art, p("clusters"))
    sinks.write_profile_json(data_profile(engineered, raw, standard, model, art), p("data_profile"))
    sinks.write_partitioned_splits(model, p("splits"), "split")
    sinks.write_audit_csv(split_summary(model), p("split_summary"))
    sinks.write_audit_csv(cluster_profile(train, art.features), p("cluster_profiles"))
    written_back = _stage(spark, mf.write_back(engineered, art), p("cleaned_panel"))
    sinks.write_audit_csv(pf.top_missing(pf.missingness(written_back)), p("missingness_top20"))
    sinks.write_audit_csv(pf.feature_correlations(model), p("feature_correlations"))
    result = {"engineered": p("engineered_panel"), "model": p("model_frame"), "splits": p("splits")}

    # Flow C
    if raw_daily is not None or daily_path:
        daily = raw_daily if raw_daily is not None else read_daily_csv(spark, daily_path)
        typed = type_daily(daily)
        aggregated = _stage(spark, daily_to_monthly(drop_bad_price_keys(typed)), p("monthly_aggregates"))
        monthly = _stage(spark, monthly_returns(aggregated), p("monthly_before_dedupe"))
        final = _stage(spark, dd.dedupe_cusip_month(monthly), p("monthly_prices"))
        merged = _stage(spark, pp.linked_panel(written_back, final), p("merged_panel"))
        pmodel = pp.price_model_frame(merged)
        sinks.write_partitioned_splits(pmodel, p("price_splits"), "crsp_split")
        pnum = numeric + [c for c in PRICE_NUMERIC_FEATURES if c not in numeric]
        pcat = categorical + [c for c in PRICE_CATEGORICAL_FEATURES if c not in categorical]
        sinks.save_model(mf.fit_preprocessor(mf.train_rows(pmodel, "crsp_split"), pnum, pcat),
                         p("price_preprocessing_pipeline"))
        sinks.write_audit_csv(split_summary(pmodel, "crsp_split", PRICE_TARGET_COL, security="PERMNO"),
                              p("price_split_summary"))
        sinks.write_profile_json(pf.price_profile(daily_profile(typed), dd.cusip_month_metrics(monthly),
                                                  final, PRICE_TARGET_COL), p("price_profile"))
        sinks.write_profile_json(pf.attach_scalars(pf.merge_profile(merged, pmodel, PRICE_TARGET_COL),
                                                   split_notes(pmodel)), p("merge_profile"))
        result.update({"monthly": p("monthly_prices"), "merged": p("merged_panel")})
    return result
