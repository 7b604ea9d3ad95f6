"""The mix: targets against a plain loop, taken words against their bounds, permutations and reruns."""

from pyspark.sql import functions as F

from ledgerlake.llm import mixing


def targets(sizes):
    """Water filling, one capped source after another."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    out, rest = {}, sum(sizes.values())
    free = set(sizes)
    while free:
        per = rest / sum(weight[s] for s in free)
        over = {s for s in free if 3 * sizes[s] < per * weight[s]}
        if not over:
            return out | {s: per * weight[s] for s in free}
        for s in over:
            out[s] = 3 * sizes[s]
            rest -= out[s]
        free -= over
    return out


def check(df, near):
    rows = mixing.mix_digest(df).collect()
    src = {}
    n = {r.doc_id: len([w for w in (r.text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ")
                        .replace("\t", " ").replace("\n", " ").split(" ") if w]) for r in df.collect()}
    source = {r.doc_id: r.source for r in df.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(n)
    for i, s in source.items():
        src[s] = src.get(s, 0) + n[i]
    want, taken = targets(src), {}
    for r in rows:
        s = source[r.doc_id]
        assert r["size"] == n[r.doc_id] and r.source_size == src[s]
        assert abs(r.target - want[s]) <= 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= near * t + 3 * mixing.BLOCK, (s, taken[s], t)
    assert sorted(rows) == sorted(mixing.mix_digest(df.repartition(7)).collect())


def test_tables(documents):
    check(documents, 0.05)


def test_hot_and_tiny_sources(make_docs):
    docs = [(i, "w " * (i % 700), "en", "hot") for i in range(60)]
    docs += [(100 + i, "w\n\tx " * 40, "en", s) for i, s in enumerate(["a", "b", None, "Z", "é", "a"])]
    docs += [(200, None, "en", "none"), (201, "", "en", "a"), (202, " ", "en", None)]
    check(make_docs(docs), 0.2)


def test_empty(make_docs):
    assert mixing.mix_digest(make_docs(["a"]).limit(0)).count() == 0
    assert mixing.mix_digest(make_docs([None, ""])).filter("taken = 0").count() == 2


def test_permutation(spark):
    for n in (1, 2, 7, 1000, 4096):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit(0)).alias("p"))
        assert sorted(r.p for r in df.collect()) == list(range(n))


def test_texts_hold_the_taken_words(documents):
    out = mixing.mixed_texts(documents)
    assert out.columns == documents.columns
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(F.size(F.split(F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), " +"))).alias("n")).collect()}
    want = {r.doc_id: r.taken for r in mixing.mix_digest(documents).collect() if r.taken}
    assert got == want


def test_a_row_with_two_sources(make_docs):
    text = " ".join(f"w{i}" for i in range(400))
    df = make_docs([(1, text, "en", "a"), (1, text, "en", "b"), (1, text, "en", None), (2, text, "en", "a")])
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + (p["hi"] - p["lo"]) * p["n"])
    want = {(r.doc_id, r.source): r.n for r in mixing.mix(df).select("doc_id", "source", taken.alias("n")).collect() if r.n}
    got = {}
    for r in mixing.mixed_texts(df).collect():
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + len(r.text.split())
    assert {(1, "a"), (1, "b"), (1, None)} & want.keys() and len(want) > 1 and got == want
