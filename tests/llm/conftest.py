import os

import pytest

SF = os.environ.get("LLM_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents-like rows from a list of texts, or of (doc_id, text[, lang, source])."""

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            r = (i, r) if r is None or isinstance(r, str) else r
            r = (*r, *("en", "src0")[len(r) - 2:]) if len(r) < 4 else r
            full.append((*r, len(r[1]) if r[1] is not None else None))
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


EDGE_TEXTS = [None, "", " \n\t ", "a", "a" * 6_000, "word " * 5_000, "é" * 50, "日本語 テキスト", "a\n\n\nb\n", "1" * 6_000,
              "\x00\x1f nul", "‮ right", "😀 smile 😀", "x" * 3 + "\n" + "x" * 3]


@pytest.fixture(scope="session")
def edge_texts():
    return list(EDGE_TEXTS)
