"""The wide frames of both panels: what a row costs, and what is kept of it."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators.prices import daily_to_monthly
from ledgerlake.plans import queries as q
from ledgerlake.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_a_daily_row_is_hashed_once(spark):
    day = dt.date(2020, 1, 31)
    rows = [(1, day, day, "c1", "t", 5, "N", "NS", 0.1, 1.1, 3.0, 4.0, price, None) for price in (2.0, 7.0, None)]
    daily = spark.createDataFrame(rows, "PERMNO int, DlyCalDt date, month_end date, cusip8 string, Ticker string, PERMCO int, PrimaryExch string, "
                                        "ShareType string, DlyRet double, ret_plus double, DlyVol double, dollar_volume double, price_abs double, market_cap double")
    monthly = daily_to_monthly(daily)
    assert monthly._jdf.queryExecution().optimizedPlan().toString().count("xxhash64") == 1
    last = daily.filter("price_abs IS NOT NULL").orderBy(F.xxhash64(*daily.columns).desc()).first()
    (got,) = monthly.collect()
    assert got.crsp_price_last == last.price_abs and got.crsp_obs_days == 3 and got.crsp_market_cap_last is None


def test_wide_projections_are_split_into_methods_that_get_compiled(spark):
    fixtures.panel_q_raw(spark, SF)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_the_model_frame_is_not_kept_beside_the_panel(spark):
    q.forget(spark)
    assert q.model(spark, SF).count() == q.engineered(spark, SF).filter(F.col(q.TARGET_COL).isNotNull()).count()
    assert [name for _, name in q.STAGES.keys()] == ["engineered"]
    q.forget(spark)
