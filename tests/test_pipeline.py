"""End-to-end pipeline on the smallest driver tables, feature lists, P13."""

import math
import os
import tempfile

from pyspark.sql import functions as F

from ledgerlake.constants import PRICE_CATEGORICAL_FEATURES, PRICE_NUMERIC_FEATURES
from ledgerlake.operators.features import feature_columns, replace_non_finite
from ledgerlake.operators.link import link_prices
from ledgerlake.plans import pipeline
from ledgerlake.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_feature_lists_counts():
    cols = (["actq", "atq", "cogsq", "dlttq", "lctq", "ltq", "niq", "oibdpq", "saleq", "xsgaq", "capxq_approx",
             "oancfq_approx", "calendar_year", "calendar_month", "is_calendar_year_end", "book_equity_proxy",
             "log_assets", "liabilities_to_assets", "debt_to_assets", "equity_to_assets", "current_ratio",
             "cash_like_to_assets", "roa", "roe_proxy", "profit_margin", "ebitda_margin", "gross_margin",
             "sgna_to_sales", "asset_turnover", "operating_cf_to_assets", "capex_to_assets", "sales_growth_qoq",
             "niq_growth_qoq", "asset_growth_qoq", "cluster_pca1", "cluster_pca2", "costat", "curcdq", "sic2",
             "sic_division", "calendar_quarter", "finance_cluster", "gvkey_str", "datadate"]
            + [f"{c}_missing" for c in ["actq", "atq", "cogsq", "dlttq", "lctq", "ltq", "niq", "oibdpq", "saleq",
                                        "xsgaq", "capxy", "oancfy", "rstcheq"]])
    num, cat, clu = feature_columns(cols)
    assert (len(num), len(cat), len(clu)) == (49, 6, 14)
    pnum = num + [c for c in PRICE_NUMERIC_FEATURES if c not in num]
    pcat = cat + [c for c in PRICE_CATEGORICAL_FEATURES if c not in cat]
    assert (len(pnum), len(pcat)) == (59, 8)


def test_non_finite_become_missing(spark):
    df = spark.createDataFrame([(math.inf, 1.0), (-math.inf, float("nan")), (2.0, None)], "a double, b double")
    out = replace_non_finite(df).collect()
    assert [r["a"] for r in out] == [None, None, 2.0] and [r["b"] for r in out] == [1.0, None, None]


def test_link_keeps_rows_and_salts_missing_keys(spark):
    panel = spark.createDataFrame([("000001", "2020-01-31", " c1234567 "), ("000002", "2020-01-31", None)],
                                  "gvkey_str string, datadate string, cusip string") \
        .withColumn("datadate", F.to_date("datadate"))
    monthly = spark.createDataFrame([("C1234567", "2020-01-31", 7)], "cusip8 string, month_end string, PERMNO int") \
        .withColumn("month_end", F.to_date("month_end"))
    out = {r["gvkey_str"]: r for r in link_prices(panel, monthly).collect()}
    assert out["000001"]["PERMNO"] == 7 and out["000002"]["PERMNO"] is None and out["000002"]["cusip8"] is None
    plan = link_prices(panel, monthly)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan


def test_end_to_end_pipeline(spark):
    out = tempfile.mkdtemp(prefix="ll-e2e-")
    res = pipeline.run(spark, None, out, raw_quarterly=fixtures.panel_q_raw(spark, SF),
                       raw_daily=fixtures.panel_d(spark, SF))
    eng = spark.read.parquet(res["engineered"])
    merged = spark.read.parquet(res["merged"])
    assert eng.count() == merged.count() == 1244          # link never fans out
    splits = spark.read.parquet(res["splits"])
    assert {r["split"] for r in splits.select("split").distinct().collect()} <= {"train", "validation", "test"}
    assert os.path.exists(os.path.join(out, "preprocessing_pipeline", "metadata"))
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(os.path.join(out, "preprocessing_pipeline"))
    vecs = model.transform(splits).select("features").limit(5).collect()
    assert len(vecs) == 5
    prof = spark.read.json(os.path.join(out, "data_profile")).first()
    assert prof.train_rows + prof.validation_rows + prof.test_rows == prof.model_rows == splits.count()
    assert prof.missing_gvkey_rows > 0 and prof.invalid_datadate_rows > 0 and prof.exact_duplicate_rows > 0
    assert prof.duplicate_key_rows_before_resolution > 0 and prof.train_end_date < prof.validation_end_date
    assert len(prof.numeric_features) > 40 and len(prof.cluster_features) == 14 and len(prof.pca_explained_variance_ratio) == 2
    assert "rstcheltq" in prof.high_missing_columns
    audit = spark.read.option("header", True).csv(os.path.join(out, "invalid_values"))
    assert audit.filter("invalid_count > 0").count() > 0
    from ledgerlake.operators.unsupervised import add_cluster_features
    from ledgerlake.sources.sinks import load_clusters
    names = ["finance_cluster", "cluster_pca1", "cluster_pca2"]
    keys = ["gvkey_str", "datadate"]
    again = add_cluster_features(spark.read.parquet(res["model"]).drop(*names), load_clusters(spark, os.path.join(out, "clusters")))
    assert (sorted(map(tuple, again.select(*keys, *names).collect()))
            == sorted(map(tuple, spark.read.parquet(res["model"]).select(*keys, *names).collect())))


def test_end_to_end_from_csv_files(spark):
    """The whole run starting at the CSV connectors: header-only text scans,
    missing spellings, typing, dedupe with file-order ties, link."""
    d = tempfile.mkdtemp(prefix="ll-csv-")
    q_csv, p_csv = os.path.join(d, "quarterly"), os.path.join(d, "daily")
    fixtures.as_text(fixtures.panel_q_raw(spark, SF)).coalesce(1).write.option("header", True).csv(q_csv)
    fixtures.as_text(fixtures.panel_d(spark, SF)).coalesce(1).write.option("header", True).csv(p_csv)
    res = pipeline.run(spark, q_csv, os.path.join(d, "out"), daily_path=p_csv)
    eng = spark.read.parquet(res["engineered"])
    assert eng.count() == 1244
    assert eng.select("gvkey_str", "datadate").distinct().count() == 1244
    assert spark.read.parquet(res["merged"]).count() == 1244
    monthly = spark.read.parquet(res["monthly"])
    assert monthly.count() == monthly.select("cusip8", "month_end").distinct().count()


def test_end_to_end_discovers_price_file_and_fingerprints(spark):
    """Single CSV files in one folder: the price file is found by its header,
    the raw file is fingerprinted and its byte-identical copy is listed."""
    import hashlib
    import json
    import shutil

    d = tempfile.mkdtemp(prefix="ll-disc-")
    q_file = os.path.join(d, "quarterly.csv")
    fixtures.as_text(fixtures.panel_q_raw(spark, SF)).toPandas().to_csv(q_file, index=False)
    fixtures.as_text(fixtures.panel_d(spark, SF)).toPandas().to_csv(os.path.join(d, "prices.csv"), index=False)
    shutil.copy(q_file, os.path.join(d, "quarterly_copy.csv"))
    out = os.path.join(d, "out")
    res = pipeline.run(spark, q_file, out, discover_prices=True)
    assert "merged" in res and spark.read.parquet(res["merged"]).count() == 1244
    prof = [json.loads(line) for f in sorted(os.listdir(os.path.join(out, "source_profile")))
            if f.endswith(".json") for line in open(os.path.join(out, "source_profile", f))][0]
    assert prof["raw_sha256"] == hashlib.sha256(open(q_file, "rb").read()).hexdigest()
    assert prof["raw_duplicate_files"] == ["quarterly_copy.csv"]
    assert prof["crsp_file_detected"] == "prices.csv"
