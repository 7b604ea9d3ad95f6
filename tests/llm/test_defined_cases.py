"""Repeated rows, clashing column names, very long texts and empty tables, for the operators whose own tests lack the case."""

import public_tokenizers
import pytest
from ledgerlake.llm import ann, bpe, jaccard_join, langid, mixing, pii, quality_mil, quality_rules, stages, toxicity
from pyspark.sql import functions as F

CLASHES = ["score", "held_out", "predicted", "n_tokens", "component_id", "n_shingles", "taken", "size", "target", "node", "comp", "h", "d", "b",
           "n", "lang_pred", "kept", "spans", "_words", "y", "weight", "f", "mix", "rank", "id", "e", "point", "leaf"]
BPE = public_tokenizers.path("byte_bpe_50k.json")


def small(spark, sf_dir, n=60):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter(F.length("text") < 3000).orderBy("doc_id").limit(n)
    return docs.cache()


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    docs = small(spark, sf_dir)
    rows = docs.union(docs.orderBy("doc_id").limit(7)).union(spark.createDataFrame([(None, None, None, None, None), (900_001, "", None, None, 0)], docs.schema))
    rows = rows.cache()
    return rows, spark.read.parquet(f"{sf_dir}/labels.parquet")


def with_clashes(docs):
    return docs.select("*", *[F.lit(1).alias(c) for c in CLASHES if c not in docs.columns])


def rows_of(df):
    return sorted((str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect()))


OPERATORS = {
    "pii": lambda d, t: pii.pii_digest(d),
    "rules": quality_rules.quality_rules,
    "bpe": lambda d, t: bpe.encoded(d, BPE),
    "mil": lambda d, t: quality_mil.quality_scores(d, t),
    "langid": lambda d, t: langid.languages(d),
    "mixing": lambda d, t: mixing.mix_digest(d),
    "jaccard": lambda d, t: jaccard_join.jaccard_components(d),
    "toxicity": lambda d, t: toxicity.toxicity_scores(d, t),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_and_clashing_columns(tables, name):
    docs, labels = tables
    plain, clashing = OPERATORS[name](docs, labels), OPERATORS[name](with_clashes(docs), labels)
    assert plain.columns == clashing.columns
    got = rows_of(plain)
    assert got == rows_of(clashing)
    if name == "mixing":  # one row a doc_id and source, or a row's share each
        return
    assert len(got) == docs.count()
    again = {str(r.doc_id) for r in docs.groupBy("doc_id").count().filter("count > 1").collect()}
    repeated = [r for r in got if r.split(",")[0].strip("(") in again]
    assert len(repeated) == 14 and len(set(repeated)) == 7


def test_stages_take_every_case(spark, tables, sf_dir):
    docs, _ = tables
    long = spark.createDataFrame([(900_002, "word " * 40_000 + "end", "en", "web", 200_003)], docs.schema)
    some = docs.union(long)
    for stage in (stages.drop_toxic, stages.one_per_near_duplicate_group, stages.redact_pii, stages.mix_sources):
        out = stage(spark, with_clashes(some), sf_dir)
        assert out.columns == stages.COLUMNS and out.count() > 0, stage
        assert stage(spark, some.filter("false"), sf_dir).count() == 0, stage
    assert stages.encode_tokens(spark, long, sf_dir).first().n_tokens > 40_000
    assert stages.encode_tokens(spark, some.filter("false"), sf_dir).count() == 0


def test_ann_clashing_columns_and_wide_vectors(spark):
    rows = [(i, [float((i * j) % 17) + 1 for j in range(600)]) for i in range(220)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    plain = rows_of(ann.neighbours(vectors))
    assert plain == rows_of(ann.neighbours(with_clashes(vectors))) and len(plain) == 30
