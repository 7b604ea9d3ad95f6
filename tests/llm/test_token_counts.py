"""Unigram counts against the tokenizers library's unigram model and a direct search."""

import math

import public_tokenizers
import pytest
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from ledgerlake.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return tc.ranked_pieces(PATH)


def direct(counter, word):
    best = [(0.0, 0)]
    for n in range(1, len(word) + 1):
        options = []
        for i in range(n):
            s = counter.scores.get(word[i:n], counter.unknown if n - i == 1 else None)
            if s is not None:
                options.append((best[i][0] + s, best[i][1] - 1))
        best.append(max(options))
    return -best[-1][1]


def test_against_the_library(pieces, documents):
    lib = Tokenizer(Unigram([("<unk>", 0.0)] + [(p, -math.log(i + 1)) for i, p in enumerate(pieces)], 0, False))
    words = sorted({tc.SPACE + w for r in documents.limit(40).collect() for w in r.text.split()})
    counter = tc.TrieCounter(pieces)
    counter.add(words)
    # The library fuses neighbouring unknown characters, so only covered words compare.
    covered = [w for w in words if all(c in counter.scores for c in w)]
    assert len(covered) > 0.9 * len(words)
    wrong = [w for w in covered if len(lib.encode(w).ids) != counter.stored[w]]
    assert len(wrong) <= 0.001 * len(covered), wrong[:9]


def test_against_a_direct_search(pieces, documents, edge_texts):
    counter = tc.TrieCounter(pieces, max_stored=50)
    texts = [r.text for r in documents.limit(30).collect()] + [t for t in edge_texts if t and len(t) < 9000]
    pre, tokens = counter.count(texts)
    for t, p, n in zip(texts, pre, tokens):
        ws = tc._SPLIT.findall(t)
        assert p == len(ws)
        assert n == sum(direct(counter, tc.SPACE + w) for w in ws)


def test_query_shape(make_docs, edge_texts):
    df = make_docs(edge_texts)
    got = {r.doc_id: (r.n_pre_tokens, r.n_tokens) for r in tc.token_counts(df, PATH).collect()}
    assert [got[i] for i in range(3)] == [(0, 0)] * 3 and got[5][0] == 5000 and got[3][1] >= 1
    assert tc.token_counts(df.limit(0), PATH).count() == 0


def test_long_words_repeated_rows_and_clashing_columns(make_docs):
    long = "ab" * 100_000
    docs = make_docs([(1, long), (2, "a b"), (2, "a b")]).withColumnRenamed("lang", "n_tokens").withColumnRenamed("source", "n_pre_tokens")
    rows = sorted(map(tuple, tc.token_counts(docs, PATH).collect()))
    assert [r[:2] for r in rows] == [(1, 1), (2, 2), (2, 2)] and rows[1] == rows[2] and 20_000 < rows[0][2] <= 200_001
