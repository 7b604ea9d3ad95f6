"""Whole texts reach Python workers in batches of bounded rows, and results do not depend on the batches."""

import pyarrow as pa
import pytest

from ledgerlake.llm import jaccard_join, stages, toxicity
from ledgerlake.llm.common import BATCH_ROWS


@pytest.fixture
def batch_rows(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    yield lambda rows: spark.conf.set(key, str(rows))
    spark.conf.set(key, before)


@pytest.mark.parametrize("step", ["sets", "reach", "train", "score", "encode"])
@pytest.mark.parametrize("rows, most", [(10_000, BATCH_ROWS), (0, BATCH_ROWS), (7, 7)])
def test_texts_reach_python_in_small_batches(spark, make_docs, sf_dir, batch_rows, step, rows, most):
    """A worker holds no 10,000 texts at once; a lower setting of the session stays."""
    docs = make_docs([f"text {i}" for i in range(8)])
    batch_rows(rows)
    if step == "sets":
        jaccard_join._sets(docs, "doc_id", "text", 5, whole=True)
    elif step == "reach":
        jaccard_join._reach(docs, "text", 5, 80)
    elif step == "train":
        toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    elif step == "score":
        toxicity.scored(docs, toxicity.ToxicityModel())
    else:
        stages.encode_tokens(spark, docs, sf_dir)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    seen = [r.n for r in spark.range(0, 2500, 1, 1).mapInArrow(run, "n long").collect()]
    assert sum(seen) == 2500 and max(seen) == most


def test_join_does_not_depend_on_batches(make_docs, batch_rows):
    """A shingle held twice in a batch is told once for it, a set that comes in two batches adds to both sums."""
    base = " ".join(f"w{i}" for i in range(60))
    texts = [f"{base} x{i // 2}" for i in range(12)] + [f"alone{i} a b c d e f" for i in range(6)] + [None, " "]
    docs = make_docs(texts).coalesce(1)
    found = []
    for rows in (1, 3, 1000):
        batch_rows(rows)
        found.append(sorted(map(tuple, jaccard_join.jaccard_components(docs).collect())))
    assert found[0] == found[1] == found[2]
    assert {c for i, _, c in found[0] if i < 12} == {0} and {c for i, _, c in found[0] if i >= 12} == {*range(12, 20)}
