"""Scalar functions on literal rows (the traps of the missing-value rules)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from ledgerlake import functions as L


def col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_clean_string(spark):
    assert col(spark, ["  x\t", " none ", "<na>", "", None], "string", L.clean_string) == ["X", None, None, None, None]


def test_parse_date(spark):
    got = col(spark, ["2020-01-31", "2020-02-30", "01/31/2020"], "string", L.parse_date)
    assert got == [dt.date(2020, 1, 31), None, None]


def test_entity_key(spark):
    assert col(spark, ["GV12", "1234567", "ab", None], "string", L.entity_key) == ["000012", "1234567", None, None]


def test_zfill_keeps_sign_and_never_truncates(spark):
    assert col(spark, ["-5", "7", "12345"], "string", lambda c: L.zfill(c, 3)) == ["-05", "007", "12345"]


def test_coerce_numeric(spark):
    got = col(spark, ["1d", "1f", " 2 ", "1e3", "1,000", "abc", "NaN", "inf"], "string", L.coerce_numeric)
    assert got[:7] == [None, None, 2.0, 1000.0, None, None, None]
    assert got[7] == math.inf  # infinities survive until the final finite check


def test_sic2(spark):
    assert col(spark, [2834.0, None, 50.0, 6021.0], "double", L.sic2) == ["28", None, "00", "60"]


def test_sic_division(spark):
    vals = [None, 99.0, 100.0, 1499.0, 1800.0, 2000.0, 5199.0, 5200.0, 6800.0, 9000.0, 9100.0, 9730.0]
    exp = ["Unknown", "Other", "Agriculture", "Mining", "Other", "Manufacturing", "Wholesale", "Retail",
           "Other", "Other", "Public Administration", "Other"]
    assert col(spark, vals, "double", L.sic_division) == exp


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 1e-10), (1.0, None), (1.0, -2.0)], "n double, d double")
    got = [r[0] for r in df.select(L.safe_divide("n", "d")).collect()]
    assert got == [None, None, None, -0.5]


def test_log_assets_clip_keeps_null(spark):
    got = col(spark, [None, -3.0, 1.0], "double", lambda c: F.log1p(L.clip_lower(c, 0.0)))
    assert got[0] is None and got[1] == 0.0 and abs(got[2] - math.log(2)) < 1e-15


def test_stable_growth(spark):
    df = spark.createDataFrame([(3.0, -1.0), (3.0, 0.0)], "c double, p double")
    assert [r[0] for r in df.select(L.stable_growth("c", "p")).collect()] == [2.0, 3.0]


def test_month_end(spark):
    assert col(spark, [dt.date(2020, 2, 3)], "date", L.month_end) == [dt.date(2020, 2, 29)]


def test_link_keys(spark):
    assert col(spark, ["C1234", "ab"], "string", L.price_link_key) == ["000C1234", None]
    assert col(spark, [" c1234567890 "], "string", L.panel_link_key) == ["C1234567"]


def test_csv_missing_tokens(spark):
    got = col(spark, ["NA", "n/a", "x", "Nan"], "string", L.csv_missing_to_null)
    assert got == [None, None, "x", "Nan"]
