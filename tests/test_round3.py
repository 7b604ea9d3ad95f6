"""k-means that shares its scans, covariance and components by value, level joins,
and plans without row expansion."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlake.operators import kmeans
from ledgerlake.operators import unsupervised as un
from ledgerlake.operators.kmeans import fit_kmeans
from ledgerlake.operators.prep import InfrequentOneHot, category_levels, join_levels
from ledgerlake.operators.prices import daily_profile
from ledgerlake.operators.profile import feature_correlations
from ledgerlake.operators.split import split_summary


def blobs(n=400, seed=4):
    rng = np.random.default_rng(seed)
    centers = np.array([[0, 0, 0], [9, 0, 1], [0, 9, -1], [9, 9, 0]])
    return centers[np.arange(n) % 4] + rng.normal(size=(n, 3))


def frame(spark, x, parts=4):
    return spark.createDataFrame(x.tolist(), "a double, b double, c double").repartition(parts)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_kmeans_is_a_fixed_point_of_lloyd(spark):
    x = blobs()
    fit = fit_kmeans(frame(spark, x), 4, 5, 42, 0.0)
    d = ((x[:, None] - fit.centers[None]) ** 2).sum(2)
    label = d.argmin(1)
    for k in range(4):
        assert fit.centers[k] == pytest.approx(x[label == k].mean(0), abs=1e-6)
    assert fit.cost == pytest.approx(d.min(1).sum(), rel=1e-6) and fit.cost == min(fit.costs)
    assert sorted(np.bincount(label)) == [100] * 4


def test_kmeans_does_not_depend_on_partitions(spark):
    x = np.concatenate([blobs(300), blobs(60, 9), blobs(300)[:40]])  # with repeated rows
    fits = [fit_kmeans(frame(spark, x, parts), 6, 2, 7, 1e-3) for parts in (1, 8, 64)]
    for other in fits[1:]:
        assert np.array_equal(fits[0].centers, other.centers) and fits[0].costs == other.costs and fits[0].iterations == other.iterations


def test_kmeans_restarts_share_their_scans(spark):
    x = frame(spark, blobs(), 2).cache()
    reads = []
    plain = kmeans._sums

    def counted(rows, centers):
        reads.append(len(centers))
        return plain(rows, centers)

    kmeans._sums = counted
    try:
        fit = fit_kmeans(x, 4, 6, 3, 1e-4)
    finally:
        kmeans._sums = plain
    # One scan weighs the candidates of all restarts, and each step serves all that still move.
    assert reads[0] == 6 and len(reads) == 1 + max(fit.iterations) and sum(reads[1:]) == sum(fit.iterations)


def test_kmeans_labels_are_those_of_plain_distances():
    rng = np.random.default_rng(4)
    x = np.rint(rng.normal(size=(500, 3)) * 4) * 2.0**24  # a grid: many equal distances
    centers = np.rint(rng.normal(size=(7, 5, 3)) * 4) * 2.0**24
    want = np.stack([kmeans._squared_distances(x, c).argmin(1) for c in centers], 1)
    assert np.array_equal(kmeans._labels(x, centers), want)


def test_kmeans_weights_copies_and_takes_few_distinct_rows(spark):
    rows = np.array([[0.0, 0, 0]] * 90 + [[10.0, 0, 0]] * 9 + [[10.0, 1, 0]])
    fit = fit_kmeans(frame(spark, rows), 2, 3, 1, 0.0)
    assert sorted(fit.centers.tolist()) == [[0, 0, 0], [10, pytest.approx(0.1, abs=1e-6), 0]]
    assert len(fit_kmeans(frame(spark, rows), 6, 2, 1, 0.0).centers) == 3
    with pytest.raises(ValueError):
        fit_kmeans(frame(spark, rows).limit(0), 2, 1, 1, 0.0)
    with pytest.raises(Exception, match="present values"):
        fit_kmeans(spark.createDataFrame([(1.0, None, 2.0)], "a double, b double, c double"), 1, 1, 1, 0.0)


def test_covariance_components_and_measured_variance(spark):
    x = blobs() @ np.array([[2, 0.5, 0], [0, 1, 0.3], [0, 0, 0.2]])
    df = frame(spark, x)
    got = {(r.feature_a, r.feature_b): r.covariance for r in un.covariance(df, ["a", "b", "c"]).collect()}
    want = np.cov(x.T)
    assert got == {(p, q): pytest.approx(want[i, j], rel=1e-9) for i, p in enumerate("abc") for j, q in enumerate("abc") if i <= j}
    art = un.fit_cluster_features(df, ["a", "b", "c"], k=4, restarts=2)
    labelled = un.add_cluster_features(df, art)
    for r in un.component_residuals(df, art).collect():
        assert r.residual < 1e-9 and r.eigenvalue == pytest.approx(art.explained_variance[r.component - 1], rel=1e-9)
    ratios = {r.component: r.explained_variance_ratio for r in un.explained_variance(labelled, art).collect()}
    assert ratios == {j + 1: pytest.approx(v, rel=1e-9) for j, v in enumerate(art.explained_variance_ratio)}
    scaled = np.array([list(r) for r in art.prep.transform(df).select("__s_a", "__s_b", "__s_c").collect()])
    assert sorted(np.linalg.eigvalsh(np.cov(scaled.T)))[::-1][:2] == pytest.approx(art.explained_variance, rel=1e-9)


def levels_frame(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", "y", " y ", "Unknown", None]), f"rare{i % 40}" if i % 5 else "often") for i in range(500)]
    return spark.createDataFrame(rows, "a string, b string")


def test_levels_are_joined_not_collected(spark, tmp_path):
    df = levels_frame(spark)
    levels = category_levels(df, ["a", "b"], 20)
    coded = join_levels(df, levels, ["a", "b"])
    assert coded.count() == 500
    slots = {r.b: (r.b_level, r.b_slot) for r in coded.collect()}
    assert slots["often"] == ("often", 0) and {v for k, v in slots.items() if k != "often"} == {("__infrequent__", 1)}
    model = InfrequentOneHot(inputCols=["a", "b"], outputCols=["va", "vb"]).fit(df)
    new = spark.createDataFrame([("x", "often"), ("new", "rare7"), (None, "new")], "a string, b string")
    want = [([1.0, 0.0], [0.0, 1.0])]
    path = str(tmp_path / "m")
    PipelineModel([model]).write().overwrite().save(path)
    for m in (PipelineModel([model]), PipelineModel.load(path)):
        out = m.transform(new)
        assert "map(" not in plan(out).lower() and out.columns == ["a", "b", "va", "vb"]
        got = {r.b + str(r.a): (list(r.va), list(r.vb)) for r in
               out.select("a", "b", vector_to_array("va").alias("va"), vector_to_array("vb").alias("vb")).collect()}
        assert got["oftenx"][1] == [1.0, 0.0] and sum(got["oftenx"][0]) == 1
        assert got["rare7new"] == ([0.0] * len(got["oftenx"][0]), want[0][1])
        assert got["newNone"][1] == [0.0, 0.0] and sum(got["newNone"][0]) == 1


def test_correlations_equal_pandas(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    x[:, 1] += x[:, 0]
    rows = [[None if rng.random() < 0.2 else float(v) for v in r[:3]] + [1.0] for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = feature_correlations(df, ["a", "b", "c", "d"])
    want = df.toPandas().corr()
    for r in out.collect():
        if "d" in (r.feature_a, r.feature_b):
            assert r["corr"] is None  # no variance
        else:
            assert r["corr"] == pytest.approx(want.loc[r.feature_a, r.feature_b], abs=1e-12)


def test_distinct_counts_expand_aggregated_keys_only(spark):
    rows = [(i % 7 if i % 5 else None, "2020-01-%02d" % (1 + i % 28), f"c{i % 3}" if i % 11 else None) for i in range(300)]
    daily = spark.createDataFrame(rows, "PERMNO int, d string, cusip8 string").select(
        "PERMNO", F.to_date("d").alias("DlyCalDt"), "cusip8", F.last_day(F.to_date("d")).alias("month_end"))
    out = daily_profile(daily)
    lines = plan(out).splitlines()
    below = next(i for i, s in enumerate(lines) if "Expand" in s)
    # Below the Expand stands the aggregate by key, which alone reads the daily rows.
    assert any("HashAggregate(keys=[_groupingexpression" in s for s in lines[below + 1:]) and "Expand" not in "".join(lines[below + 1:])
    good = [r for r in rows if r[0] is not None and r[2] is not None]
    got = out.first()
    assert (got.crsp_raw_rows, got.crsp_rows_dropped_bad_key_or_date) == (300, 300 - len(good))
    assert (got.crsp_unique_permnos, got.crsp_unique_cusip8) == (len({r[0] for r in good}), len({r[2] for r in good}))
    empty = daily_profile(daily.filter("false")).first()
    assert (empty.crsp_raw_rows, empty.crsp_rows_dropped_bad_key_or_date, empty.crsp_unique_permnos) == (0, 0, 0)


def test_split_summary_with_null_targets_and_a_split_without_any(spark):
    rows = [("train", "a", 1, "2020-01-01", 1.0), ("train", "a", 2, "2020-02-01", None), ("train", "b", 1, "2020-03-01", 4.0),
            ("test", "c", 3, "2020-04-01", None)]
    df = spark.createDataFrame(rows, "split string, gvkey_str string, p int, d string, t double").withColumn("datadate", F.to_date("d"))
    got = {r.split: r for r in split_summary(df, target="t", security="p").collect()}
    a, b = got["train"], got["test"]
    assert (a["rows"], a.companies, a.permnos, a.start_date, a.end_date, a.target_mean, a.target_median) == (3, 2, 2, "2020-01-01", "2020-03-01", 2.5, 2.5)
    assert (b["rows"], b.companies, b.permnos, b.target_mean, b.target_median) == (1, 1, 1, None, None)
