import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from ledgerlake.llm import bloom_lm as lm
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def fold(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7


def brute(rows):
    """The contract's columns and the model's score with quantised counts held in a plain dictionary."""
    single, pair = Counter(), Counter()
    for doc_id, text in rows:
        if fold(doc_id) != 2:
            ts = tokens(text)
            single.update(ts)
            pair.update(zip([False, *ts], ts))
            single[False] += 1  # the beginning mark
    mark = single.pop(False, 0)
    n, v = sum(single.values()), len(single)

    def mid(c):
        low = 1 << (c.bit_length() - 1) if c else 0
        return (low + 2 * low - 1) / 2 if c else 0.0

    out = []
    for doc_id, text in rows:
        ts = tokens(text)
        base = sum(math.log10((single[t] + 1) / (n + v + 1)) for t in ts)
        score = 0.0
        for u, w in zip([False, *ts], ts):
            cu = mid(mark if u is False else single[u])
            seen = min(1.0, mid(pair[u, w]) / cu) if cu else 0.0
            p = lm.MIX * seen + (1 - lm.MIX) * min(1.0, (mid(single[w]) + 1) / (n + v + 1))
            score += math.log10(p) if n else 0.0
        out.append((doc_id, fold(doc_id) == 2, len(ts), sum(single[t] > 0 for t in ts), n, base, score))
    return out


def by_row(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5], r[6]))


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(by_row(got), by_row(want)):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9), (g, w)


@pytest.fixture
def exact_filter(monkeypatch):
    """With 24 probes a level, a false one is out of reach for small corpora."""
    monkeypatch.setattr(lm, "PROBES", 24)


@pytest.mark.parametrize("limit", [lm.BROADCAST_BYTES, 0])
def test_scores_equal_a_dictionary_of_quantised_counts(spark, documents, exact_filter, monkeypatch, limit):
    monkeypatch.setattr(lm, "PART_WORDS", 3000)
    monkeypatch.setattr(lm, "FLUSH", 4000)
    monkeypatch.setattr(lm, "CELL_BYTES", 1 << 15)
    docs = documents.select("doc_id", "text").repartition(3)
    out = lm.held_out(F.col("doc_id"))
    got = lm.scored(docs, docs.filter(~out), broadcast_bytes=limit).withColumn("held_out", out).select(*COLUMNS)
    same([tuple(r) for r in got.collect()], brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_both_ways_probe_the_same_bits(spark, documents):
    docs = documents.select("doc_id", "text")
    a, b = (sorted(map(tuple, lm.scored(docs, docs, broadcast_bytes=limit).collect())) for limit in (lm.BROADCAST_BYTES, 0))
    assert [r[:4] for r in a] == [r[:4] for r in b]
    assert np.allclose([r[4:] for r in a], [r[4:] for r in b], rtol=1e-12)


def test_edge_texts_repeated_rows_null_ids_and_clashing_columns(spark, make_docs, edge_texts, exact_filter):
    docs = make_docs([*enumerate(edge_texts), (3, "a"), (3, "a"), (None, "Word word WORD"), (2, None)])
    docs = docs.withColumnRenamed("lang", "score").withColumnRenamed("source", "cell").withColumnRenamed("n_chars", "n_tokens")
    got = lm.corpus_scores(docs)
    assert got.columns == COLUMNS
    same([tuple(r) for r in got.collect()], brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))


@pytest.mark.parametrize("limit", [lm.BROADCAST_BYTES, 0])
def test_no_rows_and_no_training_rows(spark, make_docs, limit):
    docs = make_docs([(1, "a b"), (2, None)])
    none = docs.filter("false")
    assert lm.scored(none, none, broadcast_bytes=limit).collect() == []
    rows = lm.scored(docs, none, broadcast_bytes=limit).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_levels_are_never_low_and_seldom_high():
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 2**63, 60_000, dtype=np.uint64))
    held, unseen = hashes[::2], hashes[1::2]
    times = np.minimum(rng.zipf(1.5, len(held)), 10**6)
    cells = lm.Cells([{"cell": 0, "bits": lm.bit_field(held, times).tobytes(), "words": b"", "times": b""}], 64)
    want, got = lm.quantised(times), cells.levels(held)
    assert (got >= want).all() and (got > want).mean() < 1.5 * 2**-lm.PROBES
    assert (cells.levels(unseen) > 0).mean() < 1.5 * 2**-lm.PROBES


def test_counts_beyond_four_bytes():
    times = np.array([1, 2**32 - 2, 2**32 - 1, 2**40, 7], np.int64)
    hashes = np.arange(10, 15, dtype=np.uint64)
    rows = [{"cell": k, "bits": b"\0", "words": hashes[i:j].tobytes(), "times": times[i:j].tobytes()} for k, (i, j) in enumerate([(0, 2), (2, 5)])]
    cells = lm.Cells(rows, 64)
    assert cells.exact(np.arange(9, 16, dtype=np.uint64)).tolist() == [0, *times.tolist(), 0]


def test_held_out_texts_score_above_the_base(spark, documents):
    rows = [r for r in lm.corpus_scores(documents).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
