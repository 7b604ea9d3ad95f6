"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words with smallest period q and at least
max(MIN_WORDS, MIN_TURNS * q) words that no neighbouring word extends. The documents
of an Arrow batch, longest first and parted by symbols that occur once, make one array of
word numbers, and every step below is a NumPy operation over that array:

* Periods up to SHORT are too short for windows: for each such lag all words are
  compared with those that many places on, and the stretches of agreement read off.
* Longer periods belong to scales (P, 1.5 P]. A scale looks at every k words,
  k the scale's longest period, by a 64-bit hash, and marks the least hash of each window
  of 2 P + 3 - k neighbours. A window and the same window one period on both
  fit into a run, so they mark the same place of the period; as k words are no shorter
  than the period, they recur in the run at multiples of the period only, so the two
  marks are neighbours among the marks of their hash. Each such pair is a seed.
* A seed at distance d is extended to both sides while words d apart are identical.
  Stretches of one extent keep their least period.

Only the documents long enough for a scale are looked at, and there are about
log(longest / SHORT) / log(1.5) scales, so the work is O(words * log words).
Texts are handled in parts of about PART_WORDS words (a longer text on its own); there is
no shuffle.

Defined cases: a null, empty or blank text has no word, no run and the digests of the
empty string; a null doc_id counts as an empty text where its decimal form is needed;
repeated rows give repeated results; an empty table gives an empty result;
only `doc_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Fixed by the task.
MIN_WORDS, MIN_TURNS = 24, 3
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

SHORT = 16
PART_WORDS = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * _MIX + right)


def least_needed(period):
    return np.maximum(MIN_WORDS, MIN_TURNS * period)


def _stretches(flags: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal stretches of at least `least` true flags."""
    at = np.flatnonzero(flags)
    if len(at) < least:
        return at[:0], at[:0]
    cut = np.flatnonzero(at[1:] - at[:-1] > 1)
    begin, end = at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]] + 1
    keep = end - begin >= least
    return begin[keep], end[keep]


def _window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """The distinct places of the leftmost least value of each window of w."""
    value, place, span = h, np.arange(len(h)), 1
    while span < w:
        step = min(span, w - span)
        left = value[:-step] <= value[step:]
        place = np.where(left, place[:-step], place[step:])
        value = np.minimum(value[:-step], value[step:])
        span += step
    return place[np.r_[True, place[1:] != place[:-1]]]


def _agreeing(x: np.ndarray, i: int, lag: int, way: int) -> int:
    """How many words from place i on (way 1) or before it (way -1) equal those `lag` places on."""
    total, block = 0, 64
    while True:
        if way > 0:
            a, b = x[i + total:i + total + block], x[i + lag + total:i + lag + total + block]
            a = a[:len(b)]
        else:
            low = max(0, i - total - block)
            a, b = x[low:i - total][::-1], x[low + lag:i + lag - total][::-1]
        other = np.flatnonzero(a != b)
        if len(other):
            return total + int(other[0])
        total += len(a)
        if len(a) < block:
            return total
        block *= 2


def _seeds(x: np.ndarray, power: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of each pair of neighbouring equal marks at a distance in (low, high],
    from the hashes `power` of every `size` words, size <= high < 2 * size."""
    h = power if size == high else _joined(power[:len(power) - (high - size)], power[high - size:])
    w = 2 * low + 3 - high
    if len(h) <= w:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mark = _window_minima(h, w)
    value = h[mark]
    order = np.argsort(value, kind="stable")
    mark, value = mark[order], value[order]
    lag = mark[1:] - mark[:-1]
    pair = np.flatnonzero((value[1:] == value[:-1]) & (lag > low) & (lag <= high))
    return lag[pair], mark[pair]


def find_runs(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs of x, by start and period. x holds texts of the given
    descending lengths, each followed by a number that occurs once in x."""
    ends = np.cumsum(lengths + 1)
    reach = lambda least: int(ends[n - 1]) if (n := int(np.searchsorted(-lengths, -least, "right"))) else 0
    found = []
    part = x[:reach(MIN_WORDS)]
    for lag in range(1, SHORT + 1):
        need = int(least_needed(lag))
        part = part[:reach(need)]
        begin, end = _stretches(part[lag:] == part[:-lag], need - lag)
        found.append(np.stack([begin, end - begin + lag, np.full(len(begin), lag)], 1))
    low, size = SHORT, 1
    power = _mixed(x[:reach(int(least_needed(low + 1)))].astype(np.uint64) + _MIX)
    while limit := reach(int(least_needed(low + 1))):
        high = low + low // 2
        power = power[:limit - size + 1]
        while 2 * size <= high:
            power, size = _joined(power[:-size], power[size:]), 2 * size
        lag, place = _seeds(x[:limit], power, size, low, high)
        last_lag = last_end = -1
        for k in np.lexsort((place, lag)):
            q, at = int(lag[k]), int(place[k])
            if q == last_lag and at < last_end:
                continue  # inside the stretch just extended
            begin, end = at - _agreeing(x, at, q, -1), at + _agreeing(x, at, q, 1)
            last_lag, last_end = q, end
            if end - begin + q >= least_needed(q):
                found.append(np.array([[begin, end - begin + q, q]]))
        low = high
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(1)]]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs


def stuttered(n: int, doc_id: object) -> np.ndarray | None:
    """The contract's planted repetition: the place each of the n words is read from, or None."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.r_[np.arange(a), a + np.arange(n - a) % p]


def _parts(batch: pa.RecordBatch, budget: int) -> Iterator[pa.RecordBatch]:
    """Slices of about `budget` bytes of text, of one row where a text is longer."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > budget:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += int(size)
    if first < len(sizes):
        yield batch.slice(first)


class RunsOfPart:
    """The words and runs of some texts; `planted` applies the contract's repetition by doc_id."""

    def __init__(self, doc_ids: list, texts: list[str | None], planted: bool):
        self.words = [_WORD.findall(t or "") for t in texts]
        if planted:
            for i, doc_id in enumerate(doc_ids):
                source = stuttered(len(self.words[i]), doc_id)
                if source is not None:
                    own = self.words[i]
                    self.words[i] = [own[j] for j in source]
        lengths = np.array([len(w) for w in self.words], np.int64)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] >= MIN_WORDS]
        self.runs: dict[int, np.ndarray] = {}
        if not len(order):
            return
        lengths = lengths[order]
        flat = pa.array([w for i in order for w in self.words[i]], pa.large_string())
        number = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.r_[0, np.cumsum(lengths + 1)]
        x = np.empty(starts[-1], np.int32)
        gap = np.zeros(len(x), bool)
        gap[starts[1:] - 1] = True
        x[~gap], x[gap] = number, -1 - np.arange(len(lengths))
        runs = find_runs(x, lengths)
        if len(runs):
            text = np.searchsorted(starts, runs[:, 0], "right") - 1
            runs[:, 0] -= starts[text]
            for k, group in zip(np.unique(text), np.split(runs, np.flatnonzero(np.diff(text)) + 1)):
                self.runs[int(order[k])] = group

    def of(self, i: int) -> np.ndarray:
        return self.runs.get(i, np.empty((0, 3), np.int64))

    def kept(self, i: int) -> list[str]:
        """The words that no run holds after its first period."""
        words, runs = self.words[i], self.runs.get(i)
        if runs is None:
            return words
        depth = np.zeros(len(words) + 1, np.int32)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        return [words[j] for j in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def _over_parts(docs: DataFrame, planted: bool, row, names: list[str], types: list[pa.DataType], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _parts(b, 6 * PART_WORDS):
                ids = part.column(0).to_pylist()
                held = RunsOfPart(ids, part.column(1).to_pylist(), planted)
                rows = [row(held, i) for i in range(len(ids))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(list(c), t) for c, t in zip(zip(*rows), types))], names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {schema}")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (structs of start, length, period in words, by start and period) and
    collapsed_text, the words outside repeated periods joined by one space."""
    struct = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def row(held: RunsOfPart, i: int):
        return ([dict(zip(("start", "length", "period"), r)) for r in held.of(i).tolist()], " ".join(held.kept(i)))

    return _over_parts(docs, False, row, ["runs", "collapsed_text"], [struct, pa.string()],
                       "runs array<struct<start: long, length: long, period: long>>, collapsed_text string")


def run_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, over texts with its planted repetitions."""

    def row(held: RunsOfPart, i: int):
        runs = held.of(i).tolist()
        best = (None,) * 4
        if runs:
            # Greatest length / period, compared without rounding; the list is by start and period.
            s, n, q = runs[0]
            for t, m, p in runs[1:]:
                if m * q > n * p:
                    s, n, q = t, m, p
            best = (s, n, q, 1000 * n // q)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        return (len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(" ".join(held.kept(i)).encode("utf-8", "surrogatepass")).hexdigest())

    numbers = ["n_runs", "start", "length", "period", "exponent_milli"]
    texts = ["runs_sha256", "collapsed_sha256"]
    return _over_parts(docs, True, row, numbers + texts, [pa.int64()] * 5 + [pa.string()] * 2,
                       ", ".join(f"{c} long" for c in numbers) + ", " + ", ".join(f"{c} string" for c in texts))
