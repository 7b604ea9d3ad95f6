"""Exact quantiles by radix selection, with state that does not grow with the rows.

Spark's exact `percentile` keeps every distinct value of a group in one
aggregation buffer, which for a global quantile means one task holding a
whole column. Here order statistics are found digit by digit:

1. A double's IEEE bits, with the bits of negative numbers flipped, order
   like the doubles themselves: a 64-bit key.
2. A pass counts, for every wanted order statistic at once (all features,
   groups and ranks), how many keys that share the BITS-digits found so far
   have each next digit. An Arrow batch is counted by NumPy, the counts
   of all batches are summed by a hash aggregate on integers: at most
   2**BITS rows for each open prefix leave a task, whatever it has read.
3. The driver walks each histogram to the digit that holds the rank. A count comes with the
   least and the greatest key it covers: where they are equal, however often the value is repeated,
   the rank is found. After 64 / BITS passes the key is complete. Once the open prefixes hold no more
   than `listed` values in all, the next pass counts the keys themselves and is the last:
   three passes for most tables, six at worst.
4. Quantiles interpolate linearly between two neighbouring ranks (NumPy's
   default).

A wanted rank is a target; at most MAX_TARGETS are searched together, and
more groups than that are taken in slices by a hash of the group. So the driver holds at
most MAX_TARGETS histograms. Missing values are no values; NaN counts as the largest.
The searches run when the function is called (a fit), each as a handful of small jobs:
persist the frame if it is not cheap to read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 12
LISTED = 1 << 18
MAX_TARGETS = 2048
_GROUP = "__group"
_LOWER_BITS = np.int64(2**63 - 1)
_SIGN = np.uint64(1 << 63)


def ordered_keys(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit keys in the order of the doubles; one key for both zeros and one for all NaN."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.int64)
    return (bits ^ ((bits >> np.int64(63)) & _LOWER_BITS)).view(np.uint64) ^ _SIGN


def keyed_values(keys: np.ndarray) -> np.ndarray:
    """The doubles of some keys."""
    bits = (np.asarray(keys, np.uint64) ^ _SIGN).view(np.int64)
    return (bits ^ ((bits >> np.int64(63)) & _LOWER_BITS)).view(np.float64)


@dataclass
class OrderStatistics:
    """Of one feature in one group: how many values there are and are missing, and the values at the wanted ranks."""
    n: int = 0
    missing: int = 0
    at: dict[int, float] = field(default_factory=dict)

    def quantile(self, p: float) -> float | None:
        """NumPy's linear interpolation between the ranks around p * (n - 1)."""
        if not self.n:
            return None
        low, high, share = around(p, self.n)
        return self.at[low] + share * (self.at[high] - self.at[low]) if share else self.at[low]


def around(p: float, n: int) -> tuple[int, int, float]:
    """The two ranks around quantile p of n values, and the way between them."""
    place = (n - 1) * float(p)
    low = math.floor(place)
    return low, min(low + 1, n - 1), place - low


def _distinct_counts(major: np.ndarray, minor: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of two arrays and, for each, how often it occurs and its least and greatest key."""
    if not len(major):
        return major, minor, np.empty((0, 3), np.int64)
    order = np.lexsort((key, minor, major))
    major, minor, key = major[order], minor[order], (key[order] ^ _SIGN).view(np.int64)
    first = np.flatnonzero(np.r_[True, (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])])
    end = np.r_[first[1:], len(major)]
    return major[first], minor[first], np.stack([end - first, key[first], key[end - 1]], axis=1)


# One pass's counts: group code, feature number, prefix, next digit (-1: missing values) or, in the last pass, the key;
# and the least and greatest key counted, as signed numbers of the same order.
_COUNTS = "g long, f int, prefix long, digit long, c long, lo long, hi long"
_MISSING = np.uint64(2**64 - 1)
_NAMES = ["g", "f", "prefix", "digit", "c", "lo", "hi"]


def _rows(g, f: int, prefix, digit, stats: np.ndarray) -> pa.RecordBatch:
    signed = lambda x: pa.array(np.asarray(x).astype(np.uint64).view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(g, np.int64)), pa.array(np.full(len(stats), f, np.int32)),
                                       signed(prefix), signed(digit), *[pa.array(np.ascontiguousarray(x)) for x in stats.T]], names=_NAMES)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of a column's values, and their keys."""
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return np.flatnonzero(valid), ordered_keys(column.drop_null().to_numpy(zero_copy_only=False))


def _first_digits(take: int):
    """The first pass: the leading `take` bits, and the missing values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, group = np.unique(b.column(0).to_numpy(), return_inverse=True)
            for f in range(b.num_columns - 1):
                at, key = _values(b.column(1 + f))
                g, digit, stats = _distinct_counts(group[at], key >> np.uint64(64 - take), key)
                yield _rows(codes[g], f, np.zeros(len(stats)), digit, stats)
                gone = np.bincount(group, minlength=len(codes)) - np.bincount(group[at], minlength=len(codes))
                without = np.flatnonzero(gone)
                yield _rows(codes[without], f, np.zeros(len(without)), np.full(len(without), _MISSING),
                            np.outer(gone[without], np.array([1, 0, 0])))

    return run


def _next_digits(open_: dict[int, tuple[np.ndarray, np.ndarray]], known: int, take: int):
    """A pass below the open (group, prefix) pairs of each feature: of `known` bits, counting the next `take`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {}
        for f, (groups, prefixes) in open_.items():
            codes, heads = np.unique(groups), np.unique(prefixes)
            pair = np.searchsorted(codes, groups) * len(heads) + np.searchsorted(heads, prefixes)
            order = np.argsort(pair)
            tables[f] = codes, heads, pair[order], groups[order], prefixes[order]
        for b in batches:
            group = b.column(0).to_numpy()
            for f, (codes, heads, pairs, groups, prefixes) in tables.items():
                at, key = _values(b.column(1 + f))
                g, head = group[at], key >> np.uint64(64 - known)
                i = np.minimum(np.searchsorted(codes, g), len(codes) - 1)
                j = np.minimum(np.searchsorted(heads, head), len(heads) - 1)
                k = np.minimum(np.searchsorted(pairs, i * len(heads) + j), len(pairs) - 1)
                hit = (codes[i] == g) & (heads[j] == head) & (pairs[k] == i * len(heads) + j)
                digit = key[hit] >> np.uint64(64 - known - take) & np.uint64(2**take - 1)
                k, digit, stats = _distinct_counts(k[hit], digit, key[hit])
                yield _rows(groups[k], f, prefixes[k], digit, stats)

    return run


def _counted(data: DataFrame, step) -> dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]]:
    """(group, feature, prefix) -> digits in order and, for each, its count, least and greatest key, of one pass over the data."""
    table = data.mapInArrow(step, _COUNTS).groupBy("g", "f", "prefix", "digit").agg(
        F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
    g, f, prefix, digit, *stats = (table.column(n).to_numpy() for n in _NAMES)
    prefix, digit, stats = prefix.view(np.uint64), digit.view(np.uint64), np.stack(stats, axis=1)
    order = np.lexsort((digit, prefix, f, g))
    g, f, prefix, digit, stats = (x[order] for x in (g, f, prefix, digit, stats))
    cut = np.flatnonzero((g[1:] != g[:-1]) | (f[1:] != f[:-1]) | (prefix[1:] != prefix[:-1])) + 1
    return {(int(g[i]), int(f[i]), int(prefix[i])): (digit[i:j], stats[i:j])
            for i, j in zip(np.r_[0, cut].astype(int), np.r_[cut, len(g)].astype(int)) if j > i}


def _search(data: DataFrame, wanted: Callable[[int, int], Iterable[int]], listed: int) -> dict[tuple[int, int], OrderStatistics]:
    """(group, feature number) -> its order statistics, for the frame (group, features...)."""
    found: dict[tuple[int, int], OrderStatistics] = {}
    # Open ranks by (group, feature, prefix), each with the rank within the prefix.
    ranks: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    histograms = _counted(data, _first_digits(BITS))
    for (g, f, prefix), (digits, stats) in histograms.items():
        valid = digits != _MISSING
        s = found[g, f] = OrderStatistics(int(stats[valid, 0].sum()), int(stats[~valid, 0].sum()))
        histograms[g, f, prefix] = digits[valid], stats[valid]
        ranks[g, f, prefix] = [(r, r) for r in sorted({r for r in wanted(s.n, s.missing) if 0 <= r < s.n})]
    known, take = 0, BITS
    while True:
        below: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        held: dict[tuple[int, int, int], int] = {}
        for (g, f, prefix), own in ranks.items():
            if not own:
                continue
            digits, stats = histograms[g, f, prefix]
            counts, low, high = stats.T
            ends = np.cumsum(counts)
            for rank, left in own:
                i = int(np.searchsorted(ends, left, "right"))
                if low[i] == high[i]:  # one value only, as with each whole key
                    found[g, f].at[rank] = float(keyed_values(np.array([low[i]]).view(np.uint64) ^ _SIGN)[0])
                    continue
                at = (g, f, (prefix << take) | int(digits[i]))
                below.setdefault(at, []).append((rank, left - int(ends[i] - counts[i])))
                held[at] = int(counts[i])
        ranks, known = below, known + take
        if not ranks:
            return found
        # The rest of the key at once when few values are left below the open prefixes.
        take = 64 - known if sum(held.values()) <= listed else min(BITS, 64 - known)
        open_ = {}
        for f in {f for _, f, _ in ranks}:
            own = [(g, p) for g, h, p in ranks if h == f]
            open_[f] = np.array([g for g, _ in own], np.int64), np.array([p for _, p in own], np.uint64)
        histograms = _counted(data, _next_digits(open_, known, take))


def _grouped(df: DataFrame, cols: list[str], group: list[str], exprs: dict[str, Column] | None = None) -> DataFrame:
    code = F.xxhash64(*group) if group else F.lit(0).cast("long")
    return df.select(code.alias(_GROUP), *[(exprs or {}).get(c, F.col(c)).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])


def order_statistics(df: DataFrame, cols: list[str], wanted: Callable[[int, int], Iterable[int]],
                     group: list[str] | None = None, exprs: dict[str, Column] | None = None, per_feature: int = 4,
                     listed: int = LISTED) -> Iterator[dict[tuple[int, str], OrderStatistics]]:
    """Slices of (group code, feature) -> order statistics at the ranks that `wanted(values, missing)`
    names, about `per_feature` of them. Without a group the code is 0, else xxhash64 of the group columns."""
    data = _grouped(df, cols, group or [], exprs)
    slices = 1
    if group:
        groups = data.select(_GROUP).distinct().count()
        slices = max(1, math.ceil(groups * len(cols) * per_feature / MAX_TARGETS))
    for s in range(slices):
        own = data if slices == 1 else data.filter(F.pmod(F.xxhash64(_GROUP), F.lit(slices)) == s)
        yield {(g, cols[f]): stats for (g, f), stats in _search(own, wanted, listed).items()}


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], group: list[str] | None = None,
                    exprs: dict[str, Column] | None = None, listed: int = LISTED) -> DataFrame:
    """(group..., feature, p, value): exact linear-interpolation quantiles of
    `cols` (or of `exprs[c]`) at `probs`, per `group` (global when empty). A
    feature without values in a group has no row."""
    group = list(group or [])
    spark, out = df.sparkSession, None
    for found in order_statistics(df, cols, lambda n, _: [r for p in probs for r in around(p, n)[:2]], group, exprs, 2 * len(probs), listed):
        rows = [(g, c, float(p), s.quantile(p)) for (g, c), s in found.items() if s.n for p in probs]
        part = spark.createDataFrame(rows, f"{_GROUP} long, feature string, p double, value double")
        out = part if out is None else out.union(part)
    if not group:
        return out.drop(_GROUP)
    codes = df.select(*group, F.xxhash64(*group).alias(_GROUP)).distinct()
    return codes.join(out, _GROUP).drop(_GROUP)


def exact_quantile_row(df: DataFrame, cols: list[str], probs: list[float],
                       exprs: dict[str, Column] | None = None) -> dict[str, list[float | None]]:
    """Global quantiles as {feature: [value per p]}: a bounded result
    (features x probs numbers) on the driver for a fit."""
    (found,) = order_statistics(df, cols, lambda n, _: [r for p in probs for r in around(p, n)[:2]], exprs=exprs)
    return {c: [found[0, c].quantile(p) if (0, c) in found else None for p in probs] for c in cols}


def imputed_quantiles(df: DataFrame, cols: list[str], probs: list[float], empty: float = 0.0) -> dict[str, tuple[float, list[float]]]:
    """{feature: (median of its values, quantiles once missing values hold that median)} from one search.

    With k copies of the median m added, the value at rank r is the old one at r
    if that is below m, the old one at r - k if that is above m, and m otherwise: so both are wanted.
    A feature without values is imputed with `empty`."""

    def wanted(n: int, missing: int) -> list[int]:
        if not n:
            return []
        near = [r for p in probs for r in around(p, n + missing)[:2]]
        return [*around(0.5, n)[:2], *near, *[r - missing for r in near]]

    (found,) = order_statistics(df, cols, wanted, per_feature=2 + 4 * len(probs))
    out = {}
    for c in cols:
        s = found.get((0, c), OrderStatistics())
        middle = s.quantile(0.5) if s.n else empty

        def value(r: int, s: OrderStatistics = s, middle: float = middle) -> float:
            if r in s.at and s.at[r] < middle:
                return s.at[r]
            if r - s.missing in s.at and s.at[r - s.missing] > middle:
                return s.at[r - s.missing]
            return middle

        quantiles = []
        for p in probs:
            low, high, share = around(p, max(1, s.n + s.missing))
            quantiles.append(value(low) + share * (value(high) - value(low)) if share else value(low))
        out[c] = middle, quantiles
    return out


def grouped_median(df: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    """Exact median of each column per group, wide: group..., <col>..."""
    q = exact_quantiles(df, cols, [0.5], group=group)
    return q.groupBy(*group).pivot("feature", cols).agg(F.first("value"))
