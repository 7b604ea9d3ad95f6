"""What the panels' queries read and keep at size: inputs from one pass, kept frames found again, no wide copies."""

from pyspark.sql import functions as F

from ledgerlake.plans import queries as q
from ledgerlake.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def tables(spark):
    """Orders and lineitem rows for customers and suppliers that take every kind of copy, nulls and repeats included."""
    orders = [(i, c, f"199{i % 3}-0{1 + i % 9}-07 00:00:00") for i, c in enumerate([97, 89, 11, 22, 97 * 89, 11 * 89, 13, 5, None] * 9)]
    lines = [(i % 85, s, 1 + i % 7, 10.0 + i, 0.05, 0.02, "R" if i % 4 == 0 else "N", f"199{i % 3}-0{1 + i % 9}-0{6 + i % 2} 00:00:00")
             for i, s in enumerate([3, 4, 5, 25, 60, None] * 40)]
    o = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, t string").selectExpr("o_orderkey", "o_custkey", "CAST(t AS TIMESTAMP) o_orderdate")
    li = spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, q int, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, t string")
    return o, li.selectExpr("* EXCEPT (q, t)", "CAST(q AS DOUBLE) l_quantity", "CAST(t AS TIMESTAMP) l_shipdate")


def same_rows(a, b):
    key = lambda df: sorted(map(repr, df.collect()))
    return a.dtypes == b.dtypes and key(a) == key(b)


def test_inputs_of_one_pass_are_the_rows_of_the_sql(spark, monkeypatch):
    orders, lineitem = tables(spark)
    monkeypatch.setattr(fixtures, "table", lambda s, d, name: {"orders": orders, "lineitem": lineitem}[name])
    panel = spark.sql(fixtures.PANEL_Q_SQL, orders=orders, lineitem=lineitem)
    assert same_rows(fixtures.panel_q(spark, "rows"), panel)
    raw = fixtures.panel_q_raw(spark, "rows")
    assert same_rows(raw, spark.sql(fixtures.PANEL_Q_RAW_SQL, panel_q=panel)) and raw.count() > panel.count()
    assert same_rows(fixtures.panel_d(spark, "rows"), spark.sql(fixtures.PANEL_D_SQL, lineitem=lineitem))
    assert "Union" not in plan(raw) and plan(raw).count("Window") == plan(panel).count("Window")


def test_the_monthly_rows_that_are_kept_are_found_by_the_link(spark):
    q.forget(spark)
    # Both readers of the monthly rows, the windows and the market, find the kept ones.
    assert plan(q.merged(spark, SF)).count("InMemoryRelation") == 2
    q.forget(spark)


def test_queries_keep_their_columns_and_no_wide_frame(spark):
    q.forget(spark)
    for name in ("price_split", "price_one_hot_levels", "merge_profile", "cusip8_panel", "clip_quantiles"):
        assert q.QUERIES[name](spark, SF).count() > 0
    kept = {n: len(f.columns) for (_, n), f in q.STAGES._frames.items() if f.is_cached}
    assert kept and max(kept.values()) <= 20 and not {"engineered", "merged", "price_model"} & set(kept)
    q.forget(spark)


def test_narrow_rows_are_those_of_the_wide_frame(spark):
    q.forget(spark)
    narrow = q.price_model(spark, SF, ["PERMNO"])
    wide = q.price_model(spark, SF).select(*narrow.columns)
    assert narrow.exceptAll(wide).count() == wide.exceptAll(narrow).count() == 0
    assert narrow.filter(F.col("crsp_split").isNull()).count() == 0
    q.forget(spark)


def test_feature_lists_name_each_column_once(spark, monkeypatch):
    """The vectors take the features of the wide frame, in its order and once each."""
    q.forget(spark)
    seen = {}

    def fit(train, num, cat):
        seen.update(num=num, cat=cat)
        raise LookupError

    class Fitted:
        features = [c for c in q.CLUSTER_FEATURES if c in q.engineered(spark, SF).columns]

    def labelled(df, art):
        return df.withColumns({"cluster_pca1": F.lit(0.0), "cluster_pca2": F.lit(0.0), "finance_cluster": F.lit("cluster_0")})

    monkeypatch.setattr(q.mf, "fit_clusters", lambda m, restarts=None: (m, Fitted()))
    monkeypatch.setattr("ledgerlake.operators.unsupervised.add_cluster_features", labelled)
    monkeypatch.setattr(q.mf, "fit_preprocessor", fit)
    try:
        q.q_feature_vectors(spark, SF)
    except LookupError:
        pass
    num, cat, _ = q.feature_columns([*q.engineered(spark, SF).columns, "cluster_pca1", "cluster_pca2", "finance_cluster"])
    assert seen == {"num": num, "cat": cat} and len(set(num)) == len(num)
    q.forget(spark)
