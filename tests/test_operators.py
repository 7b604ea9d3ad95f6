"""Frame operators on literal rows: dedupe, aggregation, windows, split, prep."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators.dedupe import dedupe_cusip_month, dedupe_most_complete
from ledgerlake.operators.features import engineer_features
from ledgerlake.operators.prep import InfrequentOneHot, NumericParams, category_levels
from ledgerlake.operators.prices import daily_to_monthly, forward_sum, trailing_sum
from ledgerlake.operators.split import chronological_split, split_cuts

D = dt.date


def test_d4_null_cap_wins_by_default(spark):
    df = spark.createDataFrame([("C", D(2020, 1, 31), 1, 5.0), ("C", D(2020, 1, 31), 2, None),
                                ("C", D(2020, 1, 31), 3, 9.0)],
                               "cusip8 string, month_end date, PERMNO int, crsp_market_cap_last double")
    assert dedupe_cusip_month(df).first()["PERMNO"] == 2
    assert dedupe_cusip_month(df, prefer_known_cap=True).first()["PERMNO"] == 3


def test_d4_ties_go_to_largest_security(spark):
    df = spark.createDataFrame([("C", D(2020, 1, 31), 1, 9.0), ("C", D(2020, 1, 31), 2, 9.0),
                                ("C", D(2020, 1, 31), 3, 5.0)],
                               "cusip8 string, month_end date, PERMNO int, crsp_market_cap_last double")
    assert dedupe_cusip_month(df).first()["PERMNO"] == 2


def test_d3_most_complete_row_wins(spark):
    df = spark.createDataFrame([("000001", D(2020, 3, 31), 1.0, None), ("000001", D(2020, 3, 31), 1.0, 2.0),
                                ("000001", D(2020, 3, 31), 1.0, 2.0)],
                               "gvkey_str string, datadate date, atq double, niq double")
    out = dedupe_most_complete(df).collect()
    assert len(out) == 1 and out[0]["niq"] == 2.0


def test_d3_same_result_for_any_partitioning(spark):
    rows = [("%06d" % (i % 7), D(2020, 3, 31), float(i % 3), None if i % 2 else float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "gvkey_str string, datadate date, atq double, niq double")
    a = sorted(map(tuple, dedupe_most_complete(df.repartition(1)).collect()))
    b = sorted(map(tuple, dedupe_most_complete(df.repartition(7)).collect()))
    assert a == b


def test_a5_monthly_returns(spark):
    rows = [(1, D(2020, 1, 2), 1.0), (1, D(2020, 1, 3), None), (2, D(2020, 1, 2), None)]
    df = spark.createDataFrame(rows, "PERMNO int, DlyCalDt date, DlyRet double")
    df = df.withColumns({
        "month_end": F.last_day("DlyCalDt"), "ret_plus": F.lit(1.0) + F.col("DlyRet"),
        "cusip8": F.lit("C"), "Ticker": F.lit("T"), "PERMCO": F.lit(1), "PrimaryExch": F.lit("N"),
        "ShareType": F.lit("NS"), "DlyVol": F.lit(1.0), "dollar_volume": F.lit(1.0), "price_abs": F.lit(1.0),
        "market_cap": F.lit(1.0)})
    m = {r["PERMNO"]: r for r in daily_to_monthly(df).collect()}
    assert m[1]["crsp_obs_days"] == 1 and m[1]["crsp_ret_1m"] == 1.0
    assert m[2]["crsp_obs_days"] == 0 and m[2]["crsp_ret_1m"] is None


def _series(spark, values):
    rows = [(1, D(2020, 1, 1) + dt.timedelta(days=31 * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "PERMNO int, month_end date, x double")


def test_w4_trailing_min_periods(spark):
    df = _series(spark, [1.0, None, 3.0, 4.0])
    got = [r["s"] for r in df.withColumn("s", trailing_sum("x", 3, 2)).orderBy("month_end").collect()]
    assert got == [None, None, 4.0, 7.0]


def test_w5_forward_needs_all_three(spark):
    df = _series(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    got = [r["s"] for r in df.withColumn("s", forward_sum("x", 3)).orderBy("month_end").collect()]
    assert got == [9.0, 12.0, 15.0, None, None, None]
    df = _series(spark, [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0])
    got = [r["s"] for r in df.withColumn("s", forward_sum("x", 3)).orderBy("month_end").collect()]
    assert got == [None, None, 15.0, 18.0, None, None, None]


def _panel(spark, rows):
    schema = ("gvkey_str string, datadate date, sic double, atq double, ltq double, niq double, saleq double, "
              "cogsq double, oibdpq double, xsgaq double, actq double, lctq double, dlttq double, "
              "oancfy double, capxy double, rstcheq double")
    return spark.createDataFrame(rows, schema)


def _row(d, oancfy=None, niq=1.0, capxy=None):
    return ("000001", d, 2834.0, 10.0, 4.0, niq, 5.0, 2.0, 1.0, 1.0, 3.0, 2.0, 1.0, oancfy, capxy, 1.0)


def test_w1_ytd_difference(spark):
    ds = [D(2020, 3, 31), D(2020, 6, 30), D(2020, 9, 30), D(2020, 12, 31)]
    df = _panel(spark, [_row(d, y) for d, y in zip(ds, [2.0, 5.0, None, 9.0])])
    got = [r["oancfq_approx"] for r in engineer_features(df).orderBy("datadate").collect()]
    assert got == [2.0, 3.0, None, 9.0]


def test_w1_new_year_restarts(spark):
    ds = [D(2020, 12, 31), D(2021, 3, 31)]
    df = _panel(spark, [_row(d, y) for d, y in zip(ds, [8.0, 2.0])])
    assert [r["oancfq_approx"] for r in engineer_features(df).orderBy("datadate").collect()] == [8.0, 2.0]


def test_w3_gap_rule(spark):
    base = D(2020, 1, 1)
    ds = [base, base + dt.timedelta(days=44), base + dt.timedelta(days=89),
          base + dt.timedelta(days=279), base + dt.timedelta(days=470)]
    df = _panel(spark, [_row(d) for d in ds])
    out = engineer_features(df).orderBy("datadate").collect()
    assert [r["days_to_next_observation"] for r in out] == [44, 45, 190, 191, None]
    kept = [r["target_next_niq_growth"] is not None for r in out]
    assert kept == [False, True, True, False, False]
    assert out[0]["target_next_niq"] == 1.0  # the raw next value is never masked


def test_plan_one_exchange_for_all_entity_windows(spark):
    df = _panel(spark, [_row(D(2020, 3, 31), 1.0)])
    plan = engineer_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") + plan.count("Window(") >= 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_c1_cut_positions(spark):
    expect = {1: (1, 1), 2: (1, 1), 10: (7, 8), 90: (62, 76), 180: (125, 153)}
    for n, (ti, vi) in expect.items():
        ds = [D(2000, 1, 1) + dt.timedelta(days=i) for i in range(n)]
        df = spark.createDataFrame([(d,) for d in ds], "datadate date")
        cut = split_cuts(df).first()
        assert cut["train_end_date"] == ds[ti - 1], n
        assert cut["validation_end_date"] == ds[vi - 1], n
    df = spark.createDataFrame([(d,) for d in [D(2000, 1, 1), D(2000, 1, 2)]], "datadate date")
    labels = [r["split"] for r in chronological_split(df).orderBy("datadate").collect()]
    assert labels == ["train", "test"]  # n = 2: no validation rows


def test_m1_m2_m3(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (2.0, None, 5.0), (3.0, None, 5.0), (4.0, None, 5.0)],
                               "a double, b double, c double")
    p = NumericParams(df, ["a", "b", "c"])
    assert p.median["a"] == 2.5 and p.median["b"] == 0.0
    assert abs(p.lower["a"] - 1.03) < 1e-12 and abs(p.upper["a"] - 3.97) < 1e-12
    scaled = df.select(p.scaled("c").alias("c")).collect()
    assert all(r["c"] == 0.0 for r in scaled)


def test_m5_infrequent_pooling(spark):
    rows = [("a",)] * 19 + [("b",)] * 20 + [("c",)] * 25
    df = spark.createDataFrame(rows, "x string")
    lv = {r["level"]: r for r in category_levels(df, ["x"]).collect()}
    assert lv["a"]["encoded_level"] == "__infrequent__" and lv["b"]["slot"] == 0 and lv["c"]["slot"] == 1
    assert lv["a"]["slot"] == 2
    model = InfrequentOneHot(inputCols=["x"], outputCols=["v"]).fit(df)
    test = spark.createDataFrame([("a",), ("b",), ("zzz",)], "x string")
    vecs = {r["x"]: r["v"].toArray().tolist() for r in model.transform(test).collect()}
    assert vecs["a"] == [0.0, 0.0, 1.0] and vecs["b"] == [1.0, 0.0, 0.0] and vecs["zzz"] == [0.0, 0.0, 0.0]
