"""Exact quantiles equal NumPy's linear quantiles, ties and nulls included, whether
the last values are listed at once or found digit by digit; state does not grow with the rows."""

import random

import numpy as np
import pytest

from ledgerlake.operators import quantiles
from ledgerlake.operators.quantiles import exact_quantiles, grouped_median, imputed_quantiles, keyed_values, ordered_keys


@pytest.mark.parametrize("n,listed", [(7, 10000), (500, 10000), (2000, 0), (30000, 100)])
def test_matches_numpy(spark, n, listed):
    rnd = random.Random(n)
    vals = [rnd.choice([0.0, 0.0, 1.5]) if rnd.random() < 0.3 else rnd.gauss(0, 1) for _ in range(n)]
    df = spark.createDataFrame([(v, None if i % 5 == 0 else 2 * v, i % 3) for i, v in enumerate(vals)],
                               "a double, b double, g int")
    probs = [0.01, 0.5, 0.99]
    got = {(r["feature"], r["p"]): r["value"] for r in exact_quantiles(df, ["a", "b"], probs, listed=listed).collect()}
    ref_b = np.array([2 * v for i, v in enumerate(vals) if i % 5])
    for p in probs:
        assert got[("a", p)] == pytest.approx(float(np.quantile(np.array(vals), p)), abs=1e-12)
        assert got[("b", p)] == pytest.approx(float(np.quantile(ref_b, p)), abs=1e-12)
    med = {r["g"]: r["a"] for r in grouped_median(df, ["g"], ["a"]).collect()}
    for g in range(3):
        assert med[g] == pytest.approx(float(np.median([v for i, v in enumerate(vals) if i % 3 == g])), abs=1e-12)


def test_all_missing_group_gives_no_value(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert exact_quantiles(df, ["a"], [0.5]).count() == 0


EXTREME = [0.0, -0.0, 5e-324, -5e-324, 2.2e-308, 1.0, -1.0, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf")]


def test_keys_order_like_the_doubles():
    rng = np.random.default_rng(1)
    x = np.concatenate([EXTREME, rng.normal(size=1000) * 10.0 ** rng.integers(-300, 300, 1000), [np.nan]])
    by_key = keyed_values(ordered_keys(x)[np.argsort(ordered_keys(x), kind="stable")])
    assert np.array_equal(by_key, np.sort(x + 0.0), equal_nan=True)
    assert len(set(ordered_keys(np.array([0.0, -0.0])))) == 1


def test_extreme_values_digit_by_digit(spark):
    df = spark.createDataFrame([(v,) for v in EXTREME[:-2] * 3], "a double").repartition(3)
    probs = [i / 26 for i in range(27)]  # every rank itself
    got = {r["p"]: r["value"] for r in exact_quantiles(df, ["a"], probs, listed=0).collect()}
    assert [got[p] for p in probs] == sorted(v + 0.0 for v in EXTREME[:-2] * 3)


@pytest.mark.parametrize("missing", [0, 1, 40, 400])
def test_quantiles_of_imputed_values(spark, missing):
    rng = np.random.default_rng(missing)
    cols = {"a": rng.normal(size=101), "b": np.round(rng.normal(size=100)), "c": np.full(100, 3.0)}
    n = 101 + missing
    rows = [[float(v[i]) if i < len(v) else None for v in cols.values()] + [None] for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    got = imputed_quantiles(df, ["a", "b", "c", "d"], [0.01, 0.5, 0.99])
    for name, v in cols.items():
        m = float(np.median(v))
        full = np.concatenate([v, np.full(n - len(v), m)])
        assert got[name][0] == pytest.approx(m, abs=1e-12)
        assert got[name][1] == pytest.approx(np.quantile(full, [0.01, 0.5, 0.99]).tolist(), abs=1e-12)
    assert got["d"] == (0.0, [0.0, 0.0, 0.0])


def test_groups_in_slices_null_group_and_group_without_values(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_TARGETS", 8)
    rnd = random.Random(2)
    rows = [(None if i % 23 == 0 else i % 23, None if i % 23 == 5 else rnd.gauss(0, 1)) for i in range(2300)]
    df = spark.createDataFrame(rows, "g int, a double").repartition(4)
    got = {r["g"]: r["a"] for r in grouped_median(df, ["g"], ["a"]).collect()}
    want = {}
    for g, v in rows:
        want.setdefault(g, []).append(v)
    assert got == {g: pytest.approx(float(np.median(v)), abs=1e-12) for g, v in want.items() if None not in v}


def test_state_does_not_grow_with_the_rows(spark, monkeypatch):
    """No task passes on and the driver holds no more than a histogram of each open prefix, at either size."""
    held = {}

    def counted(data, step):
        out = plain(data, step)
        held.setdefault(size, []).append(sum(len(d) for d, _ in out.values()))
        return out

    plain = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", counted)
    monkeypatch.setattr(quantiles, "BITS", 6)
    for size in (4_000, 400_000):
        df = spark.range(size).selectExpr("sin(id * 1.7) * 1000 a", "cos(id) b")
        exact_quantiles(df, ["a", "b"], [0.25, 0.5], listed=500)
    for rows in held.values():
        assert max(rows) <= 2 * 4 * 2**6 + 500
    assert max(held[400_000]) <= 2 * max(held[4_000]) + 500


def test_a_value_repeated_beyond_the_listed_ones_takes_no_further_pass(spark, monkeypatch):
    passes = []
    plain = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda data, step: passes.append(1) or plain(data, step))
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, CAST(id AS DOUBLE), 0.7) a")
    got = {r.p: r.value for r in exact_quantiles(df, ["a"], [0.2, 0.5], listed=100).collect()}
    assert got == {0.2: 0.7, 0.5: 0.7}
    assert len(passes) == 1
