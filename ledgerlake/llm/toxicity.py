"""Toxicity by a counterfactually regularised classifier.

A logistic model over the words of a document and their beginnings of
PREFIXES characters (inflected and compound forms share one). Sentences of the training
documents that name an identity group are copied with the term swapped
for each other term of its list, and the squared change of the score between
sentence and copy is part of the loss:

    logistic loss + CF_WEIGHT * mean over copies (theta . (x' - x))^2 + L1 * |theta|

so that a group's name alone does not move a score. Swapped-in terms are words
of the model even where no document has them. The fit is proximal gradient descent
(FISTA) on a bounded sample (PER_CLASS documents a class) on the driver. Features
are 32-bit hashes; those in fewer than MIN_DOCS sample documents, or whose documents are
within SCREEN_Z standard deviations of the average, are unknown and count nothing, and the
L1 term leaves few in the model, so a long clean text gathers no noise. Scoring
reads every whole text, with no shuffle.

Defined cases: a null, empty or wordless text scores as the intercept alone;
without labels, or with one class only, each document scores the share of
label 1 (0 without any); repeated rows give repeated results; an empty
table gives an empty result; texts of any length are read whole; only `doc_id` and `text` are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import held_out, labelled_sample, small_batches
from ledgerlake.session import ensure_checkpoint_dir

PER_CLASS = 4000
MIN_DOCS = 8
PREFIXES = range(3, 9)
MAX_STORED = 60_000  # words of which a task keeps the features
L1 = 2e-4
CF_WEIGHT = 1.0
STEPS, ROUNDS = 200, 5
SCREEN_Z = 1.0
PREDICT_AT = 0.3

# Identity terms; a term is swapped for the others of its list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "deaf", "blind", "elderly", "young", "old"),
)
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(words: set[str]) -> set[str]:
    """The words, and their beginnings marked by a star."""
    return words | {f"{w[:k]}*" for w in words for k in PREFIXES if len(w) >= k}


def hashed(words: set[str]) -> np.ndarray:
    """The features as sorted distinct 32-bit hashes."""
    return np.unique(np.array([zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in features_of(words)], np.uint32))


def counterfactuals(sentence: set[str]) -> list[tuple[str, str]]:
    """(term, other) for each swap in a sentence: the copy loses the one and gains the other."""
    return [(t, o) for terms in IDENTITY_TERMS for t in terms if t in sentence for o in terms if o != t and o not in sentence]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class ToxicityModel:
    def __init__(self, prior: float = 0.0):
        self.intercept = float(np.log(np.clip(prior, 1e-4, 1 - 1e-4) / (1 - np.clip(prior, 1e-4, 1 - 1e-4))))
        self.prior = prior
        self.weights: dict[int, float] | None = None
        self.seen: set[str] = set()
        self.active: dict[str, set[int]] = {}

    def fit(self, features: list[np.ndarray], swaps: dict[tuple[str, str], int], y: np.ndarray, weight: np.ndarray,
            cf_weight: float = CF_WEIGHT) -> ToxicityModel:
        """features: the hashed features of each document; swaps: how often each occurs in their sentences."""
        weight = weight / weight.sum()
        moved = [(i, k, sign) for i, (t, o) in enumerate(swaps) for sign, gone, come in ((1.0, t, o), (-1.0, o, t))
                 for k in set(hashed({come}).tolist()) - set(hashed({gone}).tolist())]
        row = np.repeat(np.arange(len(features)), [len(f) for f in features])
        name = np.concatenate([*features, np.empty(0, np.uint32)])
        names = np.union1d(name, np.array([m[1] for m in moved], np.uint32))
        col = np.searchsorted(names, name)
        size = len(names)
        # Change of a copy's features: a row of signed entries for each kind of swap.
        swap, sign = np.array([m[0] for m in moved], np.int64), np.array([m[2] for m in moved], float)
        entry = np.searchsorted(names, np.array([m[1] for m in moved], np.uint32))
        times = np.array(list(swaps.values()), float)
        times /= max(times.sum(), 1.0)
        theta, b = np.zeros(size), self.intercept
        on = np.zeros(size, bool)
        on[entry] = True
        for _ in range(ROUNDS):
            # Features whose slope exceeds the L1 term join the fit, until none is left out.
            error = weight * (_sigmoid(np.bincount(row, theta[col], len(features)) + b) - y)
            fresh = (np.abs(np.bincount(col, error[row], size)) > L1) & ~on
            if not fresh.any() and theta.any():
                break
            on |= fresh
            theta, b = self._descend(theta, b, on, row, col, y, weight, (swap, entry, sign, times * cf_weight))
        self.weights = {int(names[k]): float(theta[k]) for k in np.flatnonzero(theta)}
        self.intercept = float(b)
        return self

    @staticmethod
    def _descend(theta, b, on, row, col, y, weight, swaps):
        """Proximal gradient steps over the features that are `on`, scaled by feature."""
        place = np.cumsum(on) - 1
        size, n = int(on.sum()), len(y)
        row, col = row[on[col]], place[col[on[col]]]
        swap, entry, sign, times = swaps
        entry = place[entry]
        length = np.maximum(1, np.bincount(row, minlength=n))
        curve = np.bincount(col, (weight * 0.25 * length)[row], size) + 1e-9
        if len(times):
            curve += 2 * np.bincount(entry, (times * np.bincount(swap, minlength=len(times)))[swap], size)
        t = theta[on]
        ahead, momentum = t, 1.0
        for step in range(STEPS):
            p = _sigmoid(np.bincount(row, ahead[col], n) + b)
            e = weight * (p - y)
            if step % 10 == 0:  # the intercept alone takes a Newton step
                b -= float(np.clip(e.sum() / max((weight * p * (1 - p)).sum(), 1e-6), -1, 1))
            g = np.bincount(col, e[row], size)
            if len(times):
                change = 2 * times * np.bincount(swap, sign * ahead[entry], len(times))
                g = g + np.bincount(entry, sign * change[swap], size)
            new = ahead - g / curve
            new = np.sign(new) * np.maximum(np.abs(new) - L1 / curve, 0)
            if ((ahead - new) * (new - t)).sum() > 0:  # momentum points uphill: start it anew
                momentum = 1.0
            m = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
            ahead, t, momentum = new + (momentum - 1) / m * (new - t), new, m
        theta = theta.copy()
        theta[on] = t
        return theta, b

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        logits = []
        for t in texts:
            if len(self.seen) > MAX_STORED:
                self.seen, self.active = set(), {}
            ws = words_of(t)
            new = ws - self.seen
            self.seen |= new
            for w in new:
                if found := self.weights.keys() & {zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in features_of({w})}:
                    self.active[w] = found
            on = set().union(*(self.active[w] for w in ws & self.active.keys()))
            logits.append(self.intercept + sum(self.weights[f] for f in sorted(on)))
        return _sigmoid(np.array(logits, float))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """The sample's features stay in Spark until those without a marginal
    effect are gone; the driver gets the rest, and counts of the swaps."""
    rows = labelled_sample(docs, labels, "toxic", per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            fs = [hashed(words_of(t)).astype(np.int64) for t in texts]
            cs = [[f"{t} {o}" for s in _SENTENCE.split(t) for t, o in counterfactuals(words_of(s))] for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), b.column(3), pa.array(fs, pa.list_(pa.int64())),
                                              pa.array(cs, pa.list_(pa.string()))], names=["doc_id", "y", "weight", "f", "c"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    ensure_checkpoint_dir(docs.sparkSession)
    small_batches(docs.sparkSession)
    sample = rows.select("text", "doc_id", "y", "weight").mapInArrow(
        run, f"doc_id {kind}, y int, weight double, f array<long>, c array<string>").checkpoint()
    all_ = sample.agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("y")).alias("toxic"), F.count_distinct("y").alias("classes")).first()
    model = ToxicityModel(all_.toxic / all_.w if all_.w else 0.0)
    if all_.classes < 2:
        return model
    swaps = {tuple(r.s.split(" ")): r["count"] for r in sample.select(F.explode("c").alias("s")).groupBy("s").count().collect()}
    always = hashed({t for s in swaps for t in s}).tolist()
    # How far a feature's documents are from the share of label 1, in standard deviations.
    excess = F.sum(F.col("weight") * (F.col("y") - F.lit(model.prior)))
    spread = F.lit(model.prior * (1 - model.prior)) * F.sum(F.col("weight") * F.col("weight"))
    pairs = sample.select("doc_id", "y", "weight", F.explode("f").alias("f"))
    kept = (pairs.groupBy("f").agg(F.count(F.lit(1)).alias("df"), excess.alias("excess"), spread.alias("spread"))
            .filter((F.col("df") >= MIN_DOCS) & (F.col("excess") * F.col("excess") > SCREEN_Z**2 * F.col("spread"))
                    | F.col("f").isin(always)).select("f"))
    slim = pairs.join(kept, "f").groupBy("doc_id").agg(F.sort_array(F.collect_list("f")).alias("f"))
    rows = sample.select("doc_id", "y", "weight").join(slim, "doc_id", "left").orderBy("doc_id")
    # Row by row: each list becomes a compact array at once.
    got = [(np.array(r.f or [], np.uint32), r.y, r.weight) for r in rows.toLocalIterator()]
    return model.fit([g[0] for g in got], swaps, np.array([g[1] for g in got], float), np.array([g[2] for g in got]))


def scored(docs: DataFrame, model: ToxicityModel, out: str = "score") -> DataFrame:
    """`docs` with the score of every whole text."""
    from pyspark.sql.types import DoubleType, StructType

    names = [c for c in docs.columns if c != out]
    docs = docs.select(*names)
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = pa.array(model.score(b.column(place).to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, scores], names=[*names, out])

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(out, DoubleType()))


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The contract's columns for a `documents` table."""
    return scored(docs.select("doc_id", "text"), train(docs, labels, per_class)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
