"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words. Each passage becomes a
vector of shares of character classes and of repetition measures, and a small
layer encodes it as h. Gated attention weighs the passages,

    a_k = softmax_k( w . (tanh(V h_k) * sigmoid(U h_k)) ),   z = sum_k a_k h_k,

and a logistic unit scores z. All weights are learned together from the labels of
documents, by Adam over the bags of a bounded sample (PER_CLASS documents a
class), on the driver; the model is a few thousand numbers. Scoring streams over
all passages of all documents with no shuffle.

Defined cases: a null, empty or blank text is one passage with a vector of
zeros; without labels, or with one class only, each document scores the share of
label 1 (0.5 without any); repeated rows give repeated results; an empty table
gives an empty result; only `doc_id` and `text` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import held_out, labelled_sample
from ledgerlake.llm.jaccard_join import Shingler

PASSAGE_WORDS = 64
PER_CLASS = 3000
HIDDEN, GATE = 24, 12
STEPS, BATCH, RATE, DECAY = 1200, 64, 0.01, 1e-4
PREDICT_AT = 0.7
SEED = 7

_CLASSES = ["aeiou", "bcdfghjklmnpqrstvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\x0b\x0c", ".", ",",
            "!", "?", "#", "*", "$", "%", "&", "|", "<>", "'\"`", "()[]{}", "-_", "=+", "/\\", ":;@~^"]
N_CLASSES = len(_CLASSES) + 4  # and control characters, and UTF-8 leads of 2, of more bytes, and continuations
N_FEATURES = N_CLASSES + 5


def _class_of() -> np.ndarray:
    out = np.full(256, len(_CLASSES), np.int64)
    for k, chars in enumerate(_CLASSES):
        out[[ord(c) for c in chars]] = k
    out[128:192], out[192:224], out[224:] = N_CLASSES - 1, N_CLASSES - 3, N_CLASSES - 2
    return out


class PassageEncoder:
    """Text to a matrix with a row of features for each passage."""

    def __init__(self) -> None:
        self.classes = _class_of()
        self.one, self.three = Shingler(1), Shingler(3)

    def __call__(self, text: str | None) -> np.ndarray:
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        gap = self.one.space[raw]
        starts = ~gap
        starts[1:] &= gap[:-1]
        n_words = int(starts.sum())
        if not n_words:
            return np.zeros((1, N_FEATURES))
        n = -(-n_words // PASSAGE_WORDS)
        passage = np.maximum(np.cumsum(starts) - 1, 0) // PASSAGE_WORDS
        size = np.bincount(passage, minlength=n)
        shares = np.bincount(passage * N_CLASSES + self.classes[raw], minlength=n * N_CLASSES).reshape(n, N_CLASSES) / size[:, None]

        at = np.arange(n_words) // PASSAGE_WORDS
        in_passage = np.bincount(at, minlength=n)
        out = np.empty((n, N_FEATURES))
        out[:, :N_CLASSES] = np.sqrt(shares)
        word = self.one.in_order(text)
        _, index, count = np.unique(word, return_inverse=True, return_counts=True)
        pairs = np.unique(at * (len(count) + 1) + index)
        out[:, N_CLASSES] = np.bincount(pairs // (len(count) + 1), minlength=n) / in_passage  # distinct words here
        out[:, N_CLASSES + 1] = np.bincount(at[1:], word[1:] == word[:-1], n) / in_passage  # words said twice in a row
        three = self.three.in_order(text)
        _, index, count = np.unique(three, return_inverse=True, return_counts=True)
        again = np.zeros(n_words)
        again[:len(three)] = count[index] > 1
        out[:, N_CLASSES + 2] = np.bincount(at, again, n) / in_passage  # starts of three words that recur in the text
        out[:, N_CLASSES + 3] = np.minimum(size / in_passage, 40) / 20  # bytes a word
        out[:, N_CLASSES + 4] = in_passage / PASSAGE_WORDS
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class GatedAttentionMil:
    """The model: standardised features, an encoding layer, gated attention, a logistic unit."""

    def __init__(self, prior: float = 0.5):
        self.prior = prior
        self.p: dict[str, np.ndarray] | None = None

    def _forward(self, x: np.ndarray, bag: np.ndarray, n: int) -> dict[str, np.ndarray]:
        p = self.p
        x = np.clip((x - p["mean"]) / p["std"], -6, 6)
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        s = (t * g) @ p["w"]
        top = np.full(n, -np.inf)
        np.maximum.at(top, bag, s)
        a = np.exp(s - top[bag])
        a /= np.bincount(bag, a, n)[bag]
        z = np.zeros((n, h.shape[1]))
        np.add.at(z, bag, a[:, None] * h)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"][0])}

    def _gradient(self, f: dict[str, np.ndarray], bag: np.ndarray, error: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        dz = error[:, None] * p["c"]
        da = (f["h"] * dz[bag]).sum(1)
        ds = f["a"] * (da - np.bincount(bag, f["a"] * da, len(error))[bag])
        dt, dg = ds[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), ds[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        de = dh * (1 - f["h"] ** 2)
        return {"c": f["z"].T @ error, "d": np.array([error.sum()]), "w": (f["t"] * f["g"]).T @ ds, "V": f["h"].T @ dt,
                "U": f["h"].T @ dg, "E": f["x"].T @ de, "e": de.sum(0)}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> GatedAttentionMil:
        rng = np.random.Generator(np.random.PCG64(SEED))
        every = np.concatenate(bags)
        draw = lambda *s: rng.normal(0, s[0] ** -0.5, s)
        self.p = {"mean": every.mean(0), "std": every.std(0) + 1e-3, "E": draw(every.shape[1], HIDDEN), "e": np.zeros(HIDDEN),
                  "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "w": draw(GATE), "c": draw(HIDDEN), "d": np.zeros(1)}
        weight = weight / weight.mean()
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            some = rng.choice(len(bags), min(BATCH, len(bags)), replace=False)
            bag = np.repeat(np.arange(len(some)), [len(bags[i]) for i in some])
            f = self._forward(np.concatenate([bags[i] for i in some]), bag, len(some))
            rate = RATE * (1 - step / (STEPS + 1))
            for k, g in self._gradient(f, bag, (f["y"] - y[some]) * weight[some] / len(some)).items():
                g = g + DECAY * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.p is None or not bags:
            return np.full(len(bags), self.prior)
        bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        return self._forward(np.concatenate(bags), bag, len(bags))["y"]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> GatedAttentionMil:
    sample = labelled_sample(docs, labels, "quality", per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = PassageEncoder()
        for b in batches:
            rows = [encode(t).astype("<f4").tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), b.column(3), pa.array(rows, pa.binary())],
                                             names=["doc_id", "y", "weight", "bag"])

    kinds = {f.name: f.dataType.simpleString() for f in sample.schema.fields}
    rows = (sample.select("text", "doc_id", "y", "weight")
            .mapInArrow(run, f"doc_id {kinds['doc_id']}, y int, weight double, bag binary").collect())
    rows.sort(key=lambda r: (r.doc_id is None, r.doc_id))
    y, weight = np.array([r.y for r in rows], float), np.array([r.weight for r in rows])
    model = GatedAttentionMil(float(np.average(y, weights=weight)) if len(rows) else 0.5)
    if len(set(y)) < 2:
        return model
    return model.fit([np.frombuffer(r.bag, "<f4").reshape(-1, N_FEATURES).astype(float) for r in rows], y, weight)


def scored(docs: DataFrame, model: GatedAttentionMil) -> DataFrame:
    """doc_id and score of every row; texts are read whole, in groups of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = PassageEncoder()
        for b in batches:
            out, bags, held = [], [], 0
            for t in b.column(1).to_pylist():
                bags.append(encode(t))
                held += len(bags[-1])
                if held > 4096:
                    out.append(model.score(bags))
                    bags, held = [], 0
            out.append(model.score(bags))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(out))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The contract's columns for a `documents` table."""
    return scored(docs, train(docs, labels, per_class)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
