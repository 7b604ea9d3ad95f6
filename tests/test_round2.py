"""Rows that must not be lost, guards, and fits that do not depend on the layout."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import sic_division
from ledgerlake.operators import unsupervised as un
from ledgerlake.operators.dedupe import dedupe_most_complete
from ledgerlake.operators.prep import numeric_params
from ledgerlake.operators.prices import drop_bad_price_keys, type_daily
from ledgerlake.operators.profile import plot_sample
from ledgerlake.operators.quantiles import exact_quantiles
from ledgerlake.plans.prices import monthly_prices
from ledgerlake.sources.csv_scan import malformed_records, read_daily_csv, read_quarterly_csv
from ledgerlake.streaming import monthly_price_stream

HEADER = "PERMNO,HdrCUSIP,PrimaryExch,ShareType,Ticker,PERMCO,DlyCalDt,DlyPrc,DlyRet,DlyVol,ShrOut\n"
day = lambda d, s=1: f"{s},c1,n,NS,t,5,{d},10,0.01,100,5\n"


def test_stream_keeps_rows_within_lateness(spark, tmp_path):
    src, steps = tmp_path / "in", [[day("2020-02-03"), day("2020-03-01")], [day("2020-02-28")], [day("2020-07-01")], [day("2020-09-01")]]
    os.makedirs(src)
    q = None
    for k, rows in enumerate(steps):
        (src / f"{k}.csv").write_text(HEADER + "".join(rows))
        q = q or (monthly_price_stream(spark, str(src), lateness="10 days").writeStream.outputMode("append").format("memory")
                  .queryName("late_rows").option("checkpointLocation", str(tmp_path / "ck")).start())
        q.processAllAvailable()
    q.stop()
    got = {str(r.month_end): r.crsp_obs_days for r in spark.sql("SELECT * FROM late_rows").collect()}
    assert got["2020-02-29"] == 2


def test_quoted_line_breaks_equal_pandas(spark, tmp_path):
    path = str(tmp_path / "q.csv")
    with open(path, "w") as f:
        f.write('gvkey,datadate,tic,atq,sic\n1,2020-03-31,"A\nB",1.0,100\n2,2020-03-31,"say ""x"", y",2.0,200\n')
    want = pd.read_csv(path, dtype=str)
    got = read_quarterly_csv(spark, path).select(*want.columns).toPandas()
    assert got.equals(want)
    assert malformed_records(spark, path).first()["malformed"] == 0
    assert malformed_records(spark, path, multi_line=False).first()["malformed"] == 2
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_quarterly_csv(spark, path, multi_line=False).collect()


def test_long_and_short_records_raise(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    for extra in ("1,c1,n\n", day("2020-01-03").strip() + ",9\n"):
        with open(path, "w") as f:
            f.write(HEADER + day("2020-01-02") + extra)
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            read_daily_csv(spark, path).collect()
        assert read_daily_csv(spark, path, malformed="PERMISSIVE").count() == 2


@pytest.mark.parametrize("rows", [99, 100, 101, 350])
def test_plot_sample_is_the_smallest_hashes(spark, rows):
    df = spark.range(rows).select(F.col("id").alias("gvkey_str"), F.lit(1).alias("datadate"))
    h = F.xxhash64("gvkey_str", "datadate", F.lit(7))
    want = sorted((r.h, r.gvkey_str) for r in df.select("gvkey_str", h.alias("h")).collect())[:100]
    got = plot_sample(df.repartition(5), n=100, seed=7, keys=("gvkey_str", "datadate"), required=()).collect()
    assert sorted(r.gvkey_str for r in got) == sorted(i for _, i in want)


def test_ranks_between_the_percentiles(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id") % 4999).cast("double").alias("x"))
    want = df.toPandas()["x"].quantile([0.137, 0.5, 0.871]).tolist()
    got = {r.p: r.value for r in exact_quantiles(df, ["x"], [0.137, 0.5, 0.871], listed=20).collect()}
    assert [got[p] for p in (0.137, 0.5, 0.871)] == pytest.approx(want, abs=1e-9)


def test_empty_training_part_raises(spark):
    with pytest.raises(ValueError, match="no rows"):
        numeric_params(spark.createDataFrame([], "x double"), ["x"])


def test_infinite_industry_code(spark):
    df = spark.createDataFrame([(float("inf"),), (150.0,), (None,)], "sic double")
    assert [r[0] for r in df.select(sic_division("sic")).collect()][0] is not None


def cluster_rows(n=1500):
    rnd = random.Random(1)
    return [(1.0, rnd.random(), rnd.random(), rnd.random() * 3) for _ in range(n)]


def test_pca_signs_with_a_constant_first_feature(spark):
    cols = list("abcd")
    df = spark.createDataFrame([(1.0, x, x + 0.01 * y, -x + 0.02 * z) for _, x, y, z in cluster_rows(400)], "a double, b double, c double, d double")
    art = un.fit_cluster_features(df, cols, k=3, restarts=1)
    out = un.add_cluster_features(df, art).limit(50)
    scaled = art.prep.transform(df.limit(50)).collect()
    for comp, name in zip(art.pca_components, ("cluster_pca1", "cluster_pca2")):
        want = sorted(round(sum(w * (r[f"__s_{c}"] - m) for w, c, m in zip(comp, cols, art.pca_mean)), 6) for r in scaled)
        assert sorted(round(r[name], 6) for r in out.collect()) == pytest.approx(want, abs=1e-5)


def test_labels_do_not_depend_on_the_layout(spark):
    cols = list("abcd")
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(cluster_rows())], "id long, a double, b double, c double, d double")
    labels = []
    for parts in (1, 4, 32):
        laid = df.repartition(parts)
        art = un.fit_cluster_features(laid, cols, k=4, restarts=2)
        labels.append({r.id: r.finance_cluster for r in un.add_cluster_features(laid, art).collect()})
    assert labels[0] == labels[1] == labels[2]


def test_price_keys_are_dropped_and_daily_read_once(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    with open(path, "w") as f:
        f.write(HEADER + day("2020-01-02") + day("not a date") + ",c1,n,NS,t,5,2020-01-02,10,0.01,100,5\n" + "1,,n,NS,t,5,2020-01-02,10,0.01,100,5\n")
    typed = type_daily(read_daily_csv(spark, path))
    assert typed.count() == 4 and drop_bad_price_keys(typed).count() == 1
    plan = monthly_prices(read_daily_csv(spark, path), stage=lambda df: df.checkpoint())._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_most_complete_row_travels_once(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("a", 1, 2, "y"), ("a", 1, 2, "b"), ("b", 1, None, None)],
                               "gvkey_str string, datadate int, v int, w string")
    assert sorted(tuple(r) for r in dedupe_most_complete(df).collect()) == [("a", 1, 2, "b"), ("b", 1, None, None)]
