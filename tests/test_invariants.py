"""Invariants: determinism over partitionings, no leakage, monotone split,
window algebra, and no Python UDF in any registered query plan."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators.dedupe import dedupe_cusip_month
from ledgerlake.operators.prep import NumericParams
from ledgerlake.operators.prices import daily_to_monthly, forward_sum, trailing_sum
from ledgerlake.operators.split import chronological_split

D = dt.date
SF = "/root/testdata/sf0.001"


def _daily(spark, parts):
    rows = []
    for i in range(400):
        day = D(2020, 1 + i % 3, 1 + i % 27)
        rows.append((i % 11, day, None if i % 7 == 0 else (i % 13) / 100.0, f"c{i % 5}", float(i % 17),
                     None if i % 9 == 0 else float(i % 4)))
    df = spark.createDataFrame(rows, "PERMNO int, DlyCalDt date, DlyRet double, cusip8 string, price_abs double, "
                                     "market_cap double")
    df = df.withColumns({"month_end": F.last_day("DlyCalDt"), "ret_plus": F.lit(1.0) + F.col("DlyRet"),
                         "Ticker": F.lit("T"), "PERMCO": F.lit(1), "PrimaryExch": F.lit("N"),
                         "ShareType": F.lit("NS"), "DlyVol": F.lit(2.0), "dollar_volume": F.lit(3.0)})
    return df.repartition(parts)


def _canon(rows):
    """Picked values and counts exactly; floating aggregates (sums, products,
    deviations) to 12 significant digits, since their last bits depend on the
    order partial results are combined in."""
    def c(v):
        return float(f"{v:.12g}") if isinstance(v, float) else v
    return sorted(tuple(c(v) for v in r) for r in rows)


def test_a5_and_d4_same_for_any_partitioning(spark):
    a = _canon(daily_to_monthly(_daily(spark, 1)).collect())
    b = _canon(daily_to_monthly(_daily(spark, 7)).collect())
    assert a == b
    m1 = dedupe_cusip_month(daily_to_monthly(_daily(spark, 1)))
    m7 = dedupe_cusip_month(daily_to_monthly(_daily(spark, 7)))
    assert _canon(m1.collect()) == _canon(m7.collect())


def test_fit_sees_training_rows_only(spark):
    rows = [(D(2020, 1, 1) + dt.timedelta(days=i), float(i % 10)) for i in range(100)]
    df = chronological_split(spark.createDataFrame(rows, "datadate date, x double"))
    altered = df.withColumn("x", F.when(F.col("split") != "train", F.lit(1e9)).otherwise(F.col("x")))
    p1 = NumericParams(df.where("split = 'train'"), ["x"]).values()
    p2 = NumericParams(altered.where("split = 'train'"), ["x"]).values()
    assert p1 == p2


def test_split_labels_monotone_in_date(spark):
    rows = [(D(2020, 1, 1) + dt.timedelta(days=i % 37),) for i in range(300)]
    out = chronological_split(spark.createDataFrame(rows, "datadate date")).collect()
    order = {"train": 0, "validation": 1, "test": 2}
    by_date = sorted((r["datadate"], order[r["split"]]) for r in out)
    assert all(a[1] <= b[1] for a, b in zip(by_date, by_date[1:]))


def test_forward_equals_trailing_shifted(spark):
    vals = [0.1 * i for i in range(1, 10)]
    rows = [(1, D(2020, 1, 1) + dt.timedelta(days=31 * i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "PERMNO int, month_end date, x double")
    out = df.select("month_end", trailing_sum("x", 3, 3).alias("t"), forward_sum("x", 3).alias("f")) \
        .orderBy("month_end").collect()
    for i in range(len(out) - 3):
        assert abs(out[i]["f"] - out[i + 3]["t"]) < 1e-12


def test_no_python_udf_in_registered_plans(spark):
    from ledgerlake.plans.queries import QUERIES
    lazy = ["scan_quarterly", "scan_daily", "clean_strings", "entity_key", "coerce_numeric", "drop_bad_keys",
            "invalid_to_null", "financial_ratios", "next_quarter_target", "dedupe_most_complete",
            "dedupe_cusip_month", "daily_to_monthly", "excess_return_target", "panel_price_join", "write_back",
            "missingness", "feature_correlations", "split_summary", "price_split_summary", "one_hot_levels"]
    for name in lazy:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert bad not in plan, (name, bad)


def test_plot_sample_equals_global_top_n(spark):
    from ledgerlake.operators.profile import plot_sample
    rows = [("%06d" % i, D(2020, 1, 1) + dt.timedelta(days=i % 300), 0.0, 0.0, "c") for i in range(5000)]
    df = spark.createDataFrame(rows, "gvkey_str string, datadate date, cluster_pca1 double, cluster_pca2 double, "
                                     "finance_cluster string").repartition(9)
    h = F.xxhash64("gvkey_str", "datadate", F.lit(42))
    exact = {r["gvkey_str"] for r in df.orderBy(h).limit(300).collect()}
    got = {r["gvkey_str"] for r in plot_sample(df, n=300).collect()}
    assert got == exact and len(got) == 300
    assert plot_sample(df, n=10000).count() == 5000
