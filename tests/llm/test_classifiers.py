"""Quality, toxicity and language: held-out accuracy, gradients, defined cases."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import langid, quality_mil, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def big(spark):
    return tuple(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_quality_held_out(big):
    docs, labels = big
    rows = quality_mil.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == is_held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_quality_gradient():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, 6)) for n in (1, 4, 2, 3)]
    y = np.array([0.0, 1, 1, 0])
    model = quality_mil.GatedAttentionMil()
    model.p = {k: rng.normal(size=s) for k, s in {"E": (6, 5), "e": 5, "V": (5, 3), "U": (5, 3), "w": 3, "c": 5, "d": 1}.items()}
    model.p |= {"mean": np.zeros(6), "std": np.ones(6)}
    bag, x = np.repeat(range(4), [1, 4, 2, 3]), np.concatenate(bags)

    def loss():
        p = model._forward(x, bag, 4)["y"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    grad = model._gradient(f := model._forward(x, bag, 4), bag, f["y"] - y)
    for k, g in grad.items():
        i = tuple(0 for _ in g.shape)
        keep, eps = model.p[k][i], 1e-5
        model.p[k][i] = keep + eps
        up = loss()
        model.p[k][i] = keep - eps
        down = loss()
        model.p[k][i] = keep
        assert abs((up - down) / (2 * eps) - g[i]) < 1e-5, k


def test_quality_passages_and_edges(spark, make_docs, edge_texts):
    encode = quality_mil.PassageEncoder()
    assert [len(encode(" ".join(["w"] * n))) for n in (1, 64, 65, 640)] == [1, 1, 2, 10]
    assert all(np.isfinite(encode(t)).all() for t in edge_texts)
    df = make_docs(edge_texts)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_mil.quality_scores(df, none).collect()} == {0.5}
    some = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (5, None, None), (3, 1, 0), (99, 0, 0)], none.schema)
    got = quality_mil.quality_scores(df, some).collect()
    assert len(got) == len(edge_texts) and all(0 <= r.score <= 1 for r in got)
    assert quality_mil.quality_scores(df.limit(0), some).count() == 0


def test_toxicity_held_out(big):
    docs, labels = big
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == is_held_out(r.doc_id) and r.predicted == (r.score >= 0.3) for r in rows)
    clean = [r for r in held if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    bad = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in bad) >= 0.8 * len(bad)


def test_counterfactual_term_silences_identity_terms():
    rng = np.random.default_rng(0)
    docs, y = [], []
    for k in range(1200):
        ws = {f"w{rng.integers(40)}" for _ in range(6)}
        toxic = k % 3 == 0
        if toxic and rng.random() < 0.9:
            ws.add("vile")
        if rng.random() < (0.5 if toxic else 0.05):  # the group is named mostly in toxic documents
            ws.add("muslims")
        docs.append((ws, toxicity.counterfactuals(ws)))
        y.append(float(toxic))
    shift = {}
    for weight in (0.0, 100.0):
        swaps = Counter(c for _, cs in docs for c in cs)
        m = toxicity.ToxicityModel(0.3).fit([toxicity.hashed(w) for w, _ in docs], swaps, np.array(y), np.ones(len(y)), cf_weight=weight)
        neutral = m.score(["Muslims live w1 here", "Christians live w1 here"])
        shift[weight] = abs(neutral[0] - neutral[1])
        assert m.score(["vile w1"])[0] > 0.8
    assert shift[0.0] > 0.1 and shift[100.0] < 0.2 * shift[0.0]
    assert ("muslims", "jews") in toxicity.counterfactuals({"muslims"}) and not toxicity.counterfactuals({"w1"})


def test_toxicity_edges(spark, make_docs, edge_texts):
    df = make_docs(edge_texts).withColumn("score", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity_scores(df, none).collect()} == {0.0}
    some = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (5, None, None), (3, 1, 0)], none.schema)
    got = toxicity.toxicity_scores(df, some).collect()
    assert len(got) == len(edge_texts) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(df, toxicity.ToxicityModel()).columns == df.columns
    assert toxicity.toxicity_scores(df.limit(0), some).count() == 0


def test_language_held_out(big):
    rows = langid.languages(big[0]).join(big[0].select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == is_held_out(r.doc_id) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert abs(np.mean([r.score for r in held]) - np.mean([r.lang_pred == r.lang for r in held])) < 0.05


def test_language_grams():
    text = "Aé b" * 3
    counts = langid.gram_counts(text, 1 << 16)
    low = text.lower()
    assert counts.sum() == sum(len(low) - n + 1 for n in langid.ORDERS)
    assert (counts > 0).sum() == len({low[i:i + n] for n in langid.ORDERS for i in range(len(low) - n + 1)})
    long = "xyz " * (langid._PIECE // 2)
    assert langid.gram_counts(long).sum() == 3 * len(long) - 3
    assert langid.gram_counts("").sum() == 0 and langid.gram_counts("a").sum() == 1


def test_language_edges(make_docs, edge_texts):
    df = make_docs([(i, t, "en" if i % 2 else None) for i, t in enumerate(edge_texts + ["der die das"])])
    got = {r.doc_id: r for r in langid.languages(df).collect()}
    letters = lambda t: any(c.isalpha() for c in t or "")
    assert all((got[i].lang_pred == "und") == (not letters(t)) for i, t in enumerate(edge_texts))
    assert {r.lang_pred for r in langid.languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.languages(df.limit(0)).count() == 0


def test_no_window_over_a_whole_language(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"),
                                    F.when(F.col("id") % 10 == 0, "de").otherwise("en").alias("lang"))
    ids = langid.first_rows(df, 1500)
    first = df.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id")
    want = {r.doc_id for x in ("de", "en") for r in first.filter(F.col("lang") == x).limit(1500).collect()}
    assert {r.doc_id for r in ids.collect()} == want and len(want) == 3000
    # The window by language reads what a window by parts of a language has passed on.
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert len(windows) == 2 and ", [lang" in windows[0] and "_w0" not in windows[0].split(", [lang")[1].split("]")[0] and windows[0] != windows[1]
