"""Base counts and log ratios against plain Python."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerlake.llm import quality_rules as qr


def base(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    seen = Counter(win)
    hit = {i + k for i, w in enumerate(win) if seen[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(ws) < 20 or 100 * len(hit) > 30 * len(ws)
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed)


def rows(df, labels):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return {r.doc_id: (tuple(r[c] for c in cols), r.log_ratio, r.kept) for r in qr.quality_rules(df, labels).collect()}


def test_tables(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = rows(documents, labels)
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert got[i][0] == base(t), i
        assert got[i][2] == (not got[i][0][5] and got[i][1] >= qr.THRESHOLD)
    good = [i for i in (r.doc_id for r in labels.filter("quality = 1").collect()) if not got[i][0][5]]
    assert sum(got[i][2] for i in good) >= 0.98 * len(good)


def test_edges(spark, make_docs, edge_texts):
    w = "one two three four five six seven eight nine "
    texts = edge_texts + [w * 2, w * 2 + "x " * 9, "a " * 16, "x\n x\nx\n\n x\nx ", "#*$%&|<>!", w * 3000, " ".join(map(str, range(9000)))]
    df = make_docs(texts)
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    got = rows(df, labels)
    for i, t in enumerate(texts):
        assert got[i][0] == base(t), i
    assert rows(df.limit(0), labels) == {}
    clash = df.withColumn("n_words", F.lit("x")).withColumn("_words", F.lit(1))
    assert rows(clash, labels) == got


def test_ratio_is_the_mean_log_likelihood_ratio(spark, make_docs):
    texts = ["Good text here", "bad $$$ text", "good good", None]
    df, buckets = make_docs(texts), 64
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 1)], "doc_id long, quality int")
    grams = {r.doc_id: r.g for r in df.select("doc_id", qr.ngram_buckets(qr.words(F.col("text")), buckets).alias("g")).collect()}
    assert [len(grams[i]) for i in range(4)] == [5, 5, 3, 0]
    raw, target = Counter(sum(grams.values(), [])), Counter(grams[0] + grams[2])
    p = lambda c, b: (c[b] + 1) / (sum(c.values()) + buckets)
    weights = qr.bucket_log_ratios(df, labels, buckets)
    assert all(abs(weights[b] - math.log(p(target, b) / p(raw, b))) < 1e-8 for b in range(buckets))
    got = df.select("doc_id", qr.mean_log_ratio(qr.words(F.col("text")), weights).alias("r")).collect()
    for r in got:
        g = grams[r.doc_id]
        assert abs(r.r - (sum(weights[b] for b in g) / len(g) if g else 0)) < 1e-5
    assert set(qr.bucket_log_ratios(df, labels.limit(0), buckets)) == {0.0}


def test_the_bitmap_loses_no_id(spark):
    ids = spark.range(0, 3000, 7).select(F.col("id").alias("doc_id"))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = {r.doc_id for r in qr._maybe_in(docs, ids).collect()}
    assert {r.doc_id for r in ids.collect()} <= got and len(got) < 450
    assert qr._maybe_in(docs, ids.limit(0)).count() == 0


def test_left_out_and_under_represented_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    junk = {r.doc_id for r in labels.filter("quality = 0").collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    half = labels.filter("quality = 1 and doc_id % 2 = 0")
    rare = half.join(docs.filter("lang = 'es' or (lang = 'de' and doc_id % 10 != 0)"), "doc_id", "left_anti")
    for trusted, some in ((half, "en es de fr"), (half.join(docs.filter("lang = 'es'"), "doc_id", "left_anti"), "es"), (rare, "es de")):
        used = {r.doc_id for r in trusted.collect()}
        got = {r.doc_id: r for r in qr.quality_rules(docs, trusted).collect() if not r.base_failed}
        for x in some.split():
            left_out = [got[i].kept for i in (good - used) & got.keys() if lang[i] == x]
            assert len(left_out) >= 10 and sum(left_out) >= 0.9 * len(left_out), (x, sum(left_out), len(left_out))
        bad = [got[i].kept for i in junk & got.keys()]
        assert sum(bad) <= 0.3 * len(bad), (sum(bad), len(bad))


def test_shares_do_not_move_the_ratio(spark, make_docs):
    # The same words in all documents of a language; Spanish is rare among the trusted ones, French absent.
    texts = [(i, " ".join(["the of and to"] * 60), "en", "s") for i in range(40)]
    texts += [(100 + i, " ".join(["los de que para"] * 60), "es", "s") for i in range(40)]
    texts += [(200 + i, " ".join(["dans une avec pour"] * 60), "fr", "s") for i in range(40)]
    labels = spark.createDataFrame([(i, 1) for i in [*range(30), 100]], "doc_id long, quality int")
    got = qr.quality_rules(make_docs(texts), labels).select("doc_id", "log_ratio").collect()
    assert all(abs(r.log_ratio) < 0.02 for r in got), max(got, key=lambda r: abs(r.log_ratio))
    null = spark.createDataFrame([(i, t) for i, t, *_ in texts], "doc_id long, text string")
    assert qr.quality_rules(null, labels).count() == 120
