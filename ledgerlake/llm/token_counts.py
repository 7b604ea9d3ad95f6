"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

Each partition walks its Arrow batches on its own: the distinct pre-tokens of
a batch that it has not met yet go into a trie in sorted order, the forward
scores (best segmentation that ends at each depth) are computed once per trie
node, so once per shared prefix, and the token counts of the terminal nodes
are stored. A document's count is then the sum over its pre-tokens. There is
no shuffle, and the store of counts is emptied when it reaches `max_stored`
entries, so memory is bounded; counts do not depend on it.

Unigram scores: the vocabulary's pieces in the order of their ids are taken
as a ranking, and a piece of rank r scores -ln(r + 1), up to a constant the
Zipf law's log-probability. A character that no piece covers counts as one
unknown token with a score below all pieces by UNKNOWN_PENALTY, as usual for
this model. Ties go to fewer tokens, then to the longer last piece.

Defined cases: a null, empty or blank text has no pre-token and no token; texts and words of
any length are counted whole, in time in proportion to their length; repeated rows give
repeated results; an empty table gives an empty result; only `doc_id` and `text` are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"  # the mark in front of a word in the vocabulary
UNKNOWN_PENALTY = 10.0
MAX_STORED = 400_000
_SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def ranked_pieces(model_path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece file by id; bytes, control and unknown pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    skip = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not skip(i)]


class TrieCounter:
    """Counts of the best unigram segmentation, shared over prefixes."""

    def __init__(self, pieces: list[str], max_stored: int = MAX_STORED):
        self.scores = {p: -math.log(i + 1) for i, p in enumerate(pieces)}
        self.longest = max(map(len, self.scores), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.max_stored = max_stored
        self.stored: dict[str, int] = {}

    def _forward(self, word: str, n: int, path: list[tuple[float, int]]) -> tuple[float, int]:
        """The (score, -tokens) of the best segmentation of the first n characters, from those of their proper prefixes."""
        best, get = None, self.scores.get
        for i in range(max(0, n - self.longest), n):
            s = get(word[i:n])
            if s is None:
                if i < n - 1:
                    continue
                s = self.unknown
            score, minus = path[i]
            if best is None or (score + s, minus - 1) > best:
                best = (score + s, minus - 1)
        return best

    def add(self, pre_tokens: Iterable[str]) -> None:
        """Stores the counts of new pre-tokens. Sorted order is a depth-first
        walk of their trie: the path to the current node is the stack."""
        if len(self.stored) > self.max_stored:
            self.stored.clear()
        before, path = "", [(0.0, 0)]
        for word in sorted(w for w in pre_tokens if w not in self.stored):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del path[shared + 1:]
            for depth in range(shared + 1, len(word) + 1):
                path.append(self._forward(word, depth, path))
            self.stored[word] = -path[-1][1]
            before = word

    def count(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """Pre-tokens and tokens of each text."""
        split = [_SPLIT.findall(t or "") for t in texts]
        self.add({SPACE + w for ws in split for w in set(ws)})
        get = self.stored.__getitem__
        return [len(ws) for ws in split], [sum(get(SPACE + w) for w in ws) for ws in split]


def token_counts(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, n_pre_tokens and n_tokens per document. The vocabulary is read on the
    driver and broadcast: its size does not depend on the data."""
    pieces = docs.sparkSession.sparkContext.broadcast(ranked_pieces(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for b in batches:
            counter = counter or TrieCounter(pieces.value)
            pre, tokens = counter.count(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pre, pa.int64()), pa.array(tokens, pa.int64())],
                names=[key, "n_pre_tokens", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_pre_tokens long, n_tokens long")
