"""Neighbours against brute force."""

import numpy as np
import pytest

from ledgerlake.llm import ann


def brute(rows, every=ann.QUERY_EVERY, k=10):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % every == 0:
            out[i] = sorted((float(np.sqrt(((x - v) ** 2).sum())), j) for j, x in ok if j != i)[:k]
    return out


def run(df):
    out = {}
    for r in ann.neighbours(df).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want, got = brute([(r.vec_id, r.embedding) for r in df.collect()]), run(df)
    assert got.keys() == want.keys()
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_recall_where_the_search_is_partial(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(60, 16))
    rows = [(i, (centers[i % 60] + 0.4 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute(rows)
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 100 = 0"), search=1200).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & {j for _, j in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [1.0, -0.0]), (3, [0.0, 1.0]), (200, [0.0, 0.0]), (300, [nan, 1.0]),
            (4, [inf, 0.0]), (400, None), (5, [None, 1.0]), (500, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = run(df)
    root = pytest.approx(2 ** 0.5)
    assert got == {0: [(0.0, 7), (0.0, 100), (root, 3)], 100: [(0.0, 0), (0.0, 7), (root, 3)]}
    assert run(df.limit(0)) == {}
    assert run(df.filter("vec_id = 0")) == {}


def test_a_common_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 1.0, 0.5] if i % 3 == 0 else rng.normal(size=3).astype(np.float32).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    want = brute(rows)
    got = run(df)
    assert got[0] == [(0.0, j) for j in range(3, 33, 3)] == want[0] and got[300] == want[300]
    assert sum([j for _, j in got[q]] == [j for _, j in want[q]] for q in want) >= 0.9 * len(want)


def test_repeated_rows_and_ids(spark):
    common = [(i, [1.0, 0.0]) for i in range(0, 1100, 100)]
    df = spark.createDataFrame(common + [(7, [0.0, 1.0])], "vec_id long, embedding array<float>")
    once = run(df)
    assert [i for _, i in once[0]] == list(range(100, 1100, 100))
    assert run(df.union(df)) == once
    assert run(df.union(spark.createDataFrame([common[0]] * 20, df.schema))) == once
    # An id with several vectors is listed once, at the least distance, and has one list of its own.
    rows = [(0, [1.0, 0.0]), (0, [0.0, 4.0]), (3, [0.0, 5.0]), (3, [5.0, 0.0]), (4, [0.0, 5.0]), (5, [2.0, 0.0])]
    got = run(spark.createDataFrame(rows + [(9, [1.0, 0.1 * j]) for j in range(1, 30)], df.schema))
    assert [i for _, i in got[0]] == [9, 3, 4, 5] and [round(s, 4) for s, _ in got[0]] == [0.1, 1.0, 1.0, 1.0]


def test_recall_without_clusters(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(10_000, 48)).astype(np.float32).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    want, got = brute(rows), run(df)
    hits = sum(len({j for _, j in got[q]} & {j for _, j in w}) for q, w in want.items())
    assert hits >= 0.95 * sum(map(len, want.values()))
    assert all(s == pytest.approx(dict((j, d) for d, j in want[q]).get(i, s), abs=0) for q in want for s, i in got[q])
