import math
import re
from collections import Counter

import pytest
from ledgerlake.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    docs = [(d, ts) for d, t in docs if (ts := terms(t))]
    n_docs, n_terms = len(docs), sum(len(ts) for _, ts in docs)
    df = Counter(t for _, ts in docs for t in set(ts))
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, query in asked.items():
        found = []
        for d, ts in docs:
            tf, m = Counter(ts), 10 + (90 * len(ts) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                        for t in query if tf[t])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def benchmark(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def test_equals_brute_force(spark, documents, benchmark):
    got = collected(ls.ranked(documents, benchmark))
    assert got == brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in benchmark.collect()])


def test_blocks_of_items_and_small_batches_change_nothing(spark, documents, benchmark, monkeypatch):
    whole = collected(ls.ranked(documents, benchmark))
    monkeypatch.setattr(ls, "CELLS", 100)
    assert collected(ls.ranked(documents, benchmark, block_postings=60)) == whole


def test_copies_share_a_class_and_expand_by_doc_id(spark, make_docs):
    same = [(i, "Alpha beta gamma") for i in range(500, 0, -1)]
    docs = make_docs([*same, (900, "gamma ALPHA, beta!"), (0, "delta alpha"), (901, "alpha beta gamma gamma")])
    items = spark.createDataFrame([(1, "alpha beta"), (2, "delta"), (3, "beta delta")], "item_id long, text string")
    got = collected(ls.ranked(docs, items))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(1, "alpha beta"), (2, "delta"), (3, "beta delta")])
    assert [r[2] for r in sorted(got) if r[0] == 1] == list(range(1, 11))
    bagged = ls.bags(docs, {"alpha": 0, "beta": 1, "delta": 2}).cache()
    grouped = ls.classes(bagged, *ls.bag_sums(bagged), 10).collect()
    # The class of (alpha, beta) and three terms holds the ten least of 501 members.
    assert sorted([i.id for i in r.ids] for r in grouped if len(r.ids) > 1) == [list(range(1, 11))]


def test_edges_ties_nulls_repeated_rows_and_clashing_columns(spark, make_docs, edge_texts):
    rows = [*enumerate(edge_texts), (3, "a"), (3, "a"), (None, "a"), (50, "a b"), (51, "é日本 Nul 1"), (52, "!!! ---")]
    docs = make_docs(rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "item_id").withColumnRenamed("n_chars", "rank")
    items = [(1, "a smile word"), (1, "a smile word"), (1, "nul"), (None, "A"), (2, None), (3, ""), (4, "..."), (5, "absent"), (6, "é日本")]
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = ls.ranked(docs, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collected(got) == brute(rows, items)
    strings = asked.selectExpr("string(item_id) item_id", "text")
    assert collected(ls.ranked(docs, strings)) == brute(rows, [(None if i is None else str(i), t) for i, t in items])


def test_empty_tables(spark, make_docs):
    docs = make_docs([(1, "a b")])
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ls.ranked(docs.filter("false"), items).collect() == []
    assert ls.ranked(docs, items.filter("false")).collect() == []
    assert ls.ranked(make_docs([(1, None), (2, "")]), items).collect() == []
