"""Each stage against its operator's brute force or defining property, and the whole pipeline on edge cases."""

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlake.llm import jaccard_join, mixing, pii, stages, toxicity
from tests.llm.test_jaccard_join import brute, near_copies

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, documents, sf_dir):
    """A table folder with clashing extra columns, nulls, repeats and near copies beside the given documents."""
    d = str(tmp_path_factory.mktemp("sf"))
    rows = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "Mail me@x.org, you idiot moron scum", None, "s", 34),
            (9004, "same row", "en", "s", 8), (9004, "same row", "en", "s", 8), (9005, "call +1 (651) 555-8500 " * 3, "en", None, 69)]
    rows += [(9100 + i, t, "en", "copies", len(t)) for i, t in enumerate(near_copies(4, groups=3, size=6))]
    extra = spark.createDataFrame(rows, documents.schema)
    documents.unionByName(extra).selectExpr("*", "'x' as score", "1 as pii", "2 as _toxic").write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{d}/labels.parquet")
    return d


def steps(spark, folder, tmp):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, folder).write.parquet(f"{tmp}/{k}")
        docs = spark.read.parquet(f"{tmp}/{k}")
        out.append(docs)
    return out


def test_each_stage(spark, folder, tmp_path):
    start, clean, single, redacted, mixed, encoded = steps(spark, folder, tmp_path)
    assert all(d.columns == COLUMNS for d in (clean, single, redacted, mixed))
    pick = lambda df: sorted(((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()), key=str)

    model = toxicity.train(start, spark.read.parquet(f"{folder}/labels.parquet"))
    want = [r for r in pick(start) if model.score([r[1]])[0] < toxicity.PREDICT_AT]
    assert pick(clean) == want

    comps = brute([(r[0], r[1]) for r in want])
    left = pick(single)
    assert len(left) == len({c for _, n, c in comps if n}) + sum(not n for _, n, _ in comps)
    assert {r[0] for r in left} == {c for _, _, c in comps} and all(r in want for r in left)

    spans = {(r.doc_id, r.text): r.pii for r in pii.find_pii(single).collect()}
    for before, after in zip(left, pick(redacted)):
        found = spans[before[0], before[1]]
        if not found:
            assert after == before
            continue
        for s in found:
            assert before[1][s.start:s.end] not in after[1] or s.kind == "secret"
        assert after[4] == len(after[1]) and re.search(r"\[(EMAIL|IP|CARD|PHONE|IBAN|SSN|SECRET)\]", after[1])

    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    taken = {}
    for r in pick(mixed):
        taken[r[0]] = taken.get(r[0], 0) + words(r[1])
    assert taken == {r.doc_id: r.taken for r in mixing.mix_digest(redacted).collect() if r.taken}

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = sorted((r[0], len(lib.encode(r[1], add_special_tokens=False).ids)) for r in pick(mixed))
    assert lengths == sorted((r.doc_id, r.n_tokens) for r in encoded.collect())


def test_run_equals_the_steps(spark, folder, tmp_path):
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, steps(spark, folder, tmp_path)[-1].collect()))


def test_empty(spark, folder, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/e/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/e").count() == 0


def test_stages_and_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "pii", "mixing", "bpe"]
    assert jaccard_join.SHINGLE == 5 and jaccard_join.PERCENT == 80 and stages.COLUMNS == COLUMNS
