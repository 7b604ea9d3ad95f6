"""k-means over a distributed frame, all restarts in each scan (M8).

A fit reads the rows once for each step, and every step serves all restarts
that have not converged:

* Start (k-means||): a first candidate, then SEEDING_ROUNDS rounds of 2 k candidates
  drawn in proportion to their squared distance from the candidates so far, and one count of the rows
  nearest to each; a weighted k-means++ over these few candidates picks the k start centres.
  A row's random numbers are hashes of its values, of the restart and of the round: a draw keeps
  the rows of least -ln(u) / distance**2, so the draws of any parts of the rows merge
  by keeping the least again.
* Lloyd: each task sums the rows and counts of each restart's clusters, and
  passes on restarts x k x (features + 1) whole numbers, however many rows it has read.
  The distances of all restarts are one product of matrices for a batch; costs are summed once, at the end.
  A restart stops when its centres move no more than the tolerance, or after `max_iter` steps.

Values enter as multiples of 2**-FRACTION, and sums are sums of whole numbers, so
neither the start nor a step depends on the order or the partitions of the rows: equal
rows give equal centres for any layout. Memory does not grow with the rows. Equal rows have
equal random numbers: they are one candidate, with the weight of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FRACTION = 26
SEEDING_ROUNDS = 3
MAX_ITER = 300
LIMIT = 2.0**14  # of a value's size: a batch's sums then stay whole in doubles
BATCH = 8192
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class KMeansFit:
    centers: np.ndarray  # of the restart of least cost
    cost: float
    costs: list[float]
    iterations: list[int]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The rows as multiples of 2**-FRACTION, BATCH at a time."""
    for b in batches:
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], 1)
        if not (np.abs(x) < LIMIT).all():
            raise ValueError(f"k-means takes present values below {LIMIT:g} in size")
        x = np.rint(x * 2.0**FRACTION)
        for i in range(0, len(x), BATCH):
            yield x[i:i + BATCH]


def _row_hash(x: np.ndarray) -> np.ndarray:
    h = np.zeros(len(x), np.uint64)
    for column in x.T.astype(np.int64).view(np.uint64):
        h = _mixed(h * _GOLDEN + column + np.uint64(1))
    return h


def _uniform(h: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """A number in (0, 1) for each row hash."""
    salt = _mixed(np.array([seed * 64 + turn], np.uint64) * _GOLDEN)
    return ((_mixed(h ^ salt) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(rows, centres), summed feature by feature: the same for a row wherever it stands."""
    out = np.zeros((len(x), len(centers)))
    for column, center in zip(x.T, centers.T):
        difference = column[:, None] - center
        out += difference * difference
    return out


def _draw(rows: DataFrame, candidates: dict[int, np.ndarray], seed: int, turn: int, take: int) -> dict[int, np.ndarray]:
    """For each restart the `take` distinct rows of least -ln(u) / distance**2 (of any row, without candidates)."""
    d = len(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for x in _whole(batches):
            h = _row_hash(x)
            for r, own in candidates.items():
                u = -np.log(_uniform(h, seed + r, turn))
                if len(own):
                    near = _squared_distances(x, own).min(1)
                    u = np.divide(u, near, out=np.full(len(u), np.inf), where=near > 0)
                least, at = np.unique(u, return_index=True)
                at = at[np.isfinite(least)][:take]
                e, y = u[at], x[at]
                if r in best:
                    e, y = np.r_[best[r][0], e], np.concatenate([best[r][1], y])
                    e, first = np.unique(e, return_index=True)
                    e, y = e[:take], y[first[:take]]
                best[r] = e, y
        for r, (e, y) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), r)), pa.array(e), pa.array(y.tolist(), pa.list_(pa.float64()))],
                                             names=["r", "e", "x"])

    drawn = rows.mapInArrow(run, "r long, e double, x array<double>").distinct()
    least = drawn.withColumn("_k", F.row_number().over(W.partitionBy("r").orderBy("e", "x"))).filter(F.col("_k") <= take)
    out = {r: [np.empty((0, d))] for r in candidates}
    for row in least.orderBy("r", "_k").collect():  # restarts x take rows
        out[row.r].append(np.array([row.x]))
    return {r: np.concatenate(v) for r, v in out.items()}


def _labels(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The nearest of some (restarts, k) centres for each row and restart, the first among equals: (rows, restarts).

    Distances come from one product of matrices. Where the two nearest lie closer than its rounding
    can tell, they are computed feature by feature."""
    restarts, k, d = centers.shape
    flat = centers.reshape(-1, d)
    norms = (flat * flat).sum(1)
    # Not by `@`: its threads, several to a task, would wait for each other.
    rough = (norms - 2 * np.einsum("ij,kj->ik", x, flat)).reshape(len(x), restarts, k)
    label = np.zeros((len(x), restarts), np.int64)
    least, second = rough[:, :, 0].copy(), np.full((len(x), restarts), np.inf)
    for i in range(1, k):
        own = rough[:, :, i]
        second = np.minimum(second, np.maximum(least, own))
        label[own < least] = i
        least = np.minimum(least, own)
    doubt = second - least <= 1e-12 * ((x * x).sum(1).max() + norms.max())
    for r in np.flatnonzero(doubt.any(0)):
        at = np.flatnonzero(doubt[:, r])
        label[at, r] = _squared_distances(x[at], centers[r]).argmin(1)
    return label


def _stacked(centers: dict[int, np.ndarray]) -> Iterator[tuple[list[int], np.ndarray]]:
    """The restarts with equally many centres, and their centres in one array."""
    for k in sorted({len(c) for c in centers.values()}):
        runs = [r for r, c in centers.items() if len(c) == k]
        yield runs, np.stack([centers[r] for r in runs])


def _total(rows: DataFrame, size: int, count) -> list[int]:
    """The sums of `size` whole numbers that `count(x, total)` adds up over the batches of all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for x in _whole(batches):
            count(x, total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["slot", "value"])

    summed = rows.mapInArrow(run, "slot long, value long").groupBy("slot").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    flat = [0] * size
    for row in summed.collect():
        flat[row.slot] = int(row.value)
    return flat


def _sums(rows: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """restart -> (counts, sums of the rows) by nearest centre (the first among equals)."""
    d = len(rows.columns)
    stacks = list(_stacked(centers))
    size = sum(len(runs) * c.shape[1] for runs, c in stacks) * (d + 1)

    def count(x: np.ndarray, total: np.ndarray) -> None:
        start = 0
        for runs, c in stacks:
            n, k = len(runs), c.shape[1]
            slot = (_labels(x, c) + k * np.arange(n)).ravel()
            # Whole numbers below 2**53 in any order of addition.
            own = [np.bincount(slot, minlength=n * k), *(np.bincount(slot, np.repeat(column, n), n * k) for column in x.T)]
            total[start:start + n * k * (d + 1)] += np.concatenate(own).astype(np.int64)
            start += n * k * (d + 1)

    flat = _total(rows, size, count)  # restarts x k x (features + 1) numbers
    out, start = {}, 0
    for runs, c in stacks:
        k = c.shape[1]
        table = np.array(flat[start:start + len(runs) * k * (d + 1)], dtype=object).reshape(d + 1, len(runs), k)
        start += table.size
        out |= {r: (table[0, i], table[1:, i]) for i, r in enumerate(runs)}
    return {r: out[r] for r in centers}


def _costs(rows: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, float]:
    """restart -> sum of the squared distances of the rows to their nearest centres."""
    stacks = list(_stacked(centers))
    order = [r for runs, _ in stacks for r in runs]

    def count(x: np.ndarray, total: np.ndarray) -> None:
        start = 0
        for runs, c in stacks:
            label = _labels(x, c)
            for i in range(len(runs)):
                near = np.zeros(len(x))
                for column, center in zip(x.T, c[i].T):
                    difference = column - center[label[:, i]]
                    near += difference * difference
                # Squares are multiples of 2**-(2 FRACTION): the cost keeps 2**-FRACTION of them.
                total[start + i] += np.rint(near * 2.0**-FRACTION).astype(np.int64).sum()
            start += len(runs)

    return {r: v * 2.0**-FRACTION for r, v in zip(order, _total(rows, len(order), count))}


def _start_centers(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted k-means++ over the candidates of a restart; fewer than k where there are fewer distinct rows."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    while len(chosen) < k:
        near = _squared_distances(candidates, candidates[chosen]).min(1) * weights
        if near.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(candidates), p=near / near.sum())))
    return candidates[chosen]


def fit_kmeans(rows: DataFrame, k: int, restarts: int, seed: int, tol: float, max_iter: int = MAX_ITER) -> KMeansFit:
    """The restart of least within-cluster cost of `restarts` fits over the columns of `rows` (doubles without
    missing values; read once for each step: persist them). `tol` bounds the sum of the squared centre shifts."""
    scale = 2.0**FRACTION
    runs = range(restarts)
    candidates = _draw(rows, {r: np.empty((0, len(rows.columns))) for r in runs}, seed, 0, 1)
    if not all(map(len, candidates.values())):
        raise ValueError("k-means needs at least one row")
    for turn in range(1, SEEDING_ROUNDS + 1):
        drawn = _draw(rows, candidates, seed, turn, 2 * k)
        candidates = {r: np.concatenate([candidates[r], drawn[r]]) for r in runs}
    weights = _sums(rows, candidates)
    centers = {r: _start_centers(candidates[r], weights[r][0].astype(np.float64), k, seed + r) for r in runs}
    open_, iterations = set(runs), dict.fromkeys(runs, 0)
    while open_:
        found = _sums(rows, {r: centers[r] for r in sorted(open_)})
        for r, (counts, sums) in found.items():
            moved = centers[r].copy()
            held = np.flatnonzero(counts > 0)
            moved[held] = np.array([[int(sums[j, i]) / int(counts[i]) for j in range(len(sums))] for i in held])
            shift = float(((moved - centers[r]) ** 2).sum()) / scale**2
            iterations[r] += 1
            if shift <= tol or iterations[r] >= max_iter:
                open_.discard(r)
            if shift > 0 and r in open_:
                centers[r] = moved
    costs = _costs(rows, centers)
    best = min(runs, key=lambda r: (costs[r], r))
    return KMeansFit(centers[best] / scale, costs[best], [costs[r] for r in runs], [iterations[r] for r in runs])
