"""The price model's numeric pipeline goes through tables that are dropped, and gives the parameters of the wide frame."""
import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.prep import numeric_params
from ledgerlake.plans import queries as q
from ledgerlake.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_price_pipeline_leaves_nothing_and_equals_the_wide_frame(spark, monkeypatch):
    fit = q.mf.fit_clusters
    monkeypatch.setattr(q.mf, "fit_clusters", lambda rows, restarts=None: fit(rows, restarts=1))
    q.forget(spark)
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    got = {r.feature: r[1:] for r in q.q_price_numeric_pipeline(spark, SF).collect()}
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept
    folder = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    assert not [n for n in (os.listdir(folder) if os.path.isdir(folder) else []) if n.startswith("steps-")]
    (art,) = q._FITS.values()
    wide = q.mf.write_back(q.engineered(spark, SF), art)
    num, _, _ = q.feature_columns(wide.columns)
    num += [c for c in q.PRICE_NUMERIC_FEATURES if c not in num]
    linked = q.pp.linked_panel(wide, q.monthly_final(spark, SF))
    want = q.rounded(numeric_params(q.mf.train_rows(q.pp.price_model_frame(linked), "crsp_split"), num).table(spark)).collect()
    assert {*got} == {r.feature for r in want}
    for r in want:
        assert got[r.feature] == pytest.approx(r[1:], rel=1e-9, abs=2e-6), r.feature
    q.forget(spark)


def test_a_part_of_the_panel_is_labelled_by_the_dates_of_all_of_it(spark):
    rows = [(f"{i % 4}", f"20{10 + i // 4}-03-31", float(i) if i % 5 else None) for i in range(40)]
    panel = spark.createDataFrame(rows, f"gvkey_str string, d string, {q.TARGET_COL} double").withColumn("datadate", F.to_date("d"))
    part = panel.filter("gvkey_str = '1' AND datadate > '2014-01-01'")
    want = q.mf.write_back(panel).filter("gvkey_str = '1' AND datadate > '2014-01-01'").collect()
    assert sorted(map(str, q.mf.write_back(part, panel=panel).collect())) == sorted(map(str, want))


def test_columns_apart_stay_as_they_are(spark):
    from ledgerlake.operators.features import row_features

    columns = ["atq", "ltq", "dlttq", "actq", "lctq", "niq", "saleq", "oibdpq", "cogsq", "xsgaq", "oancfq_approx", "capxq_approx", q.TARGET_COL]
    df = spark.createDataFrame([tuple([float("inf")] * (len(columns) + 1))], [*columns, "price"])
    row = row_features(df, ("price",)).first()
    assert row.price == float("inf") and row.atq is None and row.ltq is None
