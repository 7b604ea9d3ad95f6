"""op12 where the filter is too large to broadcast: blocks of texts ask the cells."""
import re

import numpy as np
import pytest
from ledgerlake.llm import bloom_lm as lm
from pyspark.sql import functions as F

from test_bloom_lm import COLUMNS, brute, exact_filter, same  # noqa: F401


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(lm, "PART_WORDS", 1000)
    monkeypatch.setattr(lm, "BLOCK_WORDS", 3000, raising=False)
    monkeypatch.setattr(lm, "CELL_BYTES", 1 << 14)


def test_bits_are_never_copied_to_those_who_ask(spark, make_docs, small_blocks, capsys):
    docs = make_docs([(k, f"some words of text {k} " * 400) for k in range(40)])
    lm.scored(docs, docs, broadcast_bytes=0).explain()
    assert "Join" not in capsys.readouterr().out


def test_blocks_and_cells_of_any_size_score_like_a_dictionary(spark, documents, exact_filter, small_blocks):  # noqa: F811
    docs = documents.select("doc_id", "text").repartition(3)
    out = lm.held_out(F.col("doc_id"))
    got = lm.scored(docs, ~out, broadcast_bytes=0).withColumn("held_out", out).select(*COLUMNS)
    same([tuple(r) for r in got.collect()], brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_edge_texts_null_ids_and_a_null_condition(spark, make_docs, edge_texts, exact_filter, small_blocks):  # noqa: F811
    rows = [*enumerate(edge_texts), (3, "a"), (3, "a"), (None, "Word word WORD"), (2, None)]
    docs = make_docs(rows)
    as_frame, as_condition = (sorted(map(str, lm.scored(docs, train, broadcast_bytes=0).collect()))
                              for train in (docs.filter("doc_id % 2 = 0"), F.expr("doc_id % 2 = 0")))
    assert as_frame == as_condition and len(as_frame) == len(rows)


def test_a_filter_that_turns_out_too_large_is_not_broadcast(spark, documents, small_blocks, monkeypatch):
    docs = documents.select("doc_id", "text")
    want = sorted(map(tuple, lm.scored(docs, docs).collect()))
    monkeypatch.setattr(lm, "_scores_from_broadcast", None)
    monkeypatch.setattr(lm, "TEXT_BYTES", 1 << 30)
    got = sorted(map(tuple, lm.scored(docs, docs, broadcast_bytes=1000).collect()))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-12)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(5)
    for x in (np.empty(0, np.uint64), np.array([2**64 - 1], np.uint64), rng.integers(0, 2**64, 5000, dtype=np.uint64)):
        assert (lm._unpacked(lm._packed(x)) == x).all()
        assert (lm._unpacked_hashes(lm._packed_hashes(np.sort(x))) == np.sort(x)).all()


def test_words_end_at_the_six_blanks_only():
    text = "".join(f"a{chr(c)}" for c in [*range(1, 300), 0x2003, 0x3000]) + " \t b"
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().translate(lm._LOWER))
    part = lm.Part.read([text])
    assert part.sizes.tolist() == [len(words) + 1] and len(part.words) == len({*words}) + 1
