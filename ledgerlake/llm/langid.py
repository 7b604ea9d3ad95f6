"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams (1 to 3 characters of the
lower-cased text) hashed into BUCKETS buckets, of unit length. Document
frequencies are counted over all training documents; each partition adds up
its own before the shuffle. The regression is trained on a bounded sample of them
(PER_LANG documents a language, those with the smallest hash of their id) by
follow-the-regularised-leader with L1 and L2 penalties, on the driver. A part of the
sample that the regression has not seen then sets one temperature by its
likelihood. The score of a prediction is its calibrated probability.

Training documents have a non-null lang and are outside the held-out fold.

Defined cases: a null text, or one without letters, is `und` with score 0; so is
any text if there is nothing to learn from; texts of any length are read whole; equal scores go to the first
language in code point order; repeated rows give repeated results; an empty
table gives an empty result; only doc_id, text and, to train, lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import held_out

BUCKETS = 1 << 13
ORDERS = (1, 2, 3)
PER_LANG = 1500
PARTS = 64
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-4, 1e-4
CALIBRATION_PART = 5  # one in so many sample documents sets the temperature
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_PIECE = 1 << 18  # characters hashed at a time


def gram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs among the n-grams of the whole text."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    out = np.zeros(buckets, np.int64)
    for at in range(0, len(code), _PIECE):
        part = code[at:at + _PIECE + max(ORDERS) - 1]
        h = np.zeros(len(part), np.uint64)
        for k, order in enumerate(range(1, max(ORDERS) + 1)):
            # h holds the hash of the order characters that start at each place.
            h = (h[:len(part) - k] if k else h) * np.uint64(0x9E3779B97F4A7C15) + part[k:] + np.uint64(order)
            if order in ORDERS:
                mixed = (h[:_PIECE] ^ (h[:_PIECE] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
                out += np.bincount((mixed >> np.uint64(40)).astype(np.int64) % buckets, minlength=buckets)
    return out


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and unit-length weights of the buckets that occur."""
    at = np.flatnonzero(counts)
    x = (1 + np.log(counts[at])) * idf[at]
    return at, x / max(float(np.sqrt((x * x).sum())), 1e-12)


def document_frequencies(docs: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts: two bounded results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(buckets + 1, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                df[:buckets] += gram_counts(t, buckets) > 0
                n += 1
        df[buckets] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets + 1)), pa.array(df)], names=["bucket", "df"])

    rows = docs.select("text").mapInArrow(run, "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(buckets + 1, np.int64)
    for r in rows:
        df[r.bucket] = r.df
    return df[:buckets], int(df[buckets])


class LanguageModel:
    def __init__(self, langs: list[str], idf: np.ndarray):
        self.langs, self.idf = langs, idf
        self.weights = np.zeros((len(idf), len(langs)))
        self.bias = np.zeros(len(langs))
        self.temperature = 1.0

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> LanguageModel:
        """FTRL-proximal with per-coordinate rates; the last row of z and n is the bias."""
        size, k = self.weights.shape
        z, n = np.zeros((size + 1, k)), np.zeros((size + 1, k))
        target = np.eye(k)
        for _ in range(EPOCHS):
            for (at, x), label in zip(rows, y):
                at, x = np.append(at, size), np.append(x, 1.0)
                w = self._weights(z[at], n[at])
                p = x @ w
                p = np.exp(p - p.max())
                g = x[:, None] * (p / p.sum() - target[label])
                n_new = n[at] + g * g
                z[at] += g - (np.sqrt(n_new) - np.sqrt(n[at])) / ALPHA * w
                n[at] = n_new
        w = self._weights(z, n)
        self.weights, self.bias = w[:size], w[size]
        return self

    @staticmethod
    def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def logits(self, row: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, x = row
        return x @ self.weights[at] + self.bias

    def calibrate(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> LanguageModel:
        """The temperature of least negative log-likelihood, by ternary search in its logarithm."""
        if len(rows):
            logits = np.array([self.logits(r) for r in rows])

            def loss(log_t: float) -> float:
                s = logits / np.exp(log_t)
                s = s - s.max(1, keepdims=True)
                return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

            lo, hi = np.log(0.05), np.log(5.0)
            for _ in range(60):
                a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
                lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
            self.temperature = float(np.exp((lo + hi) / 2))
        return self

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        s = self.logits(tf_idf(gram_counts(text, len(self.idf)), self.idf)) / self.temperature
        p = np.exp(s - s.max())
        best = int(p.argmax())
        return self.langs[best], float(p[best] / p.sum())


def first_rows(known: DataFrame, per_lang: int) -> DataFrame:
    """doc_id, lang and the hash of the text (_t) of the `per_lang` rows of each language with the smallest hash of their id."""
    order = ["_h", "doc_id", "_t"]
    rows = known.select("doc_id", "lang", F.xxhash64("text").alias("_t"), F.xxhash64("doc_id").alias("_h"))
    # Each part of a language passes on as many first, so no task holds a language.
    for part in ([F.pmod(F.xxhash64("doc_id", "_t"), F.lit(PARTS))], []):
        first = W.partitionBy("lang", *part).orderBy(*order)
        rows = rows.withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= per_lang).drop("_k")
    return rows.drop("_h").distinct()


def train(docs: DataFrame, per_lang: int = PER_LANG, buckets: int = BUCKETS) -> LanguageModel:
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    df, n = document_frequencies(known, buckets)
    idf = np.log((1 + n) / (1 + df)) + 1
    ids = first_rows(known, per_lang)
    # At most per_lang rows a language, so the ids may be broadcast and texts stay where they are.
    sample = (known.withColumn("_t", F.xxhash64("text")).join(F.broadcast(ids), ["doc_id", "lang", "_t"], "left_semi")
              .dropDuplicates(["doc_id", "lang", "_t"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = [gram_counts(t, buckets) for t in b.column(0).to_pylist()]
            at = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([a.astype("<i4").tobytes() for a in at], pa.binary()),
                 pa.array([c[a].astype("<i4").tobytes() for c, a in zip(counts, at)], pa.binary())], names=["lang", "at", "counts"])

    rows = sample.select("text", "lang").mapInArrow(run, "lang string, at binary, counts binary").collect()
    langs = sorted({r.lang for r in rows})
    model = LanguageModel(langs, idf)
    # A fixed order that mixes the languages, whatever order the rows came in.
    rng = np.random.Generator(np.random.PCG64(11))
    rows.sort(key=lambda r: (r.lang, r.at, r.counts))
    rows = [rows[i] for i in rng.permutation(len(rows))]
    x = []
    for r in rows:
        dense = np.zeros(buckets, np.int64)
        dense[np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["counts"], "<i4")
        x.append(tf_idf(dense, idf))
    y = np.array([langs.index(r.lang) for r in rows], np.int64)
    held = np.arange(len(rows)) % CALIBRATION_PART == 0 if len(rows) >= 2 * CALIBRATION_PART else np.zeros(len(rows), bool)
    model.fit([v for v, h in zip(x, held) if not h], y[~held])
    return model.calibrate([v for v, h in zip(x, held) if h], y[held])


def predicted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every row, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def languages(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """The contract's columns for a `documents` table."""
    return predicted(docs, train(docs, per_lang)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
