"""Approximate nearest neighbours: a forest of random-projection trees, one queue, exact reranking.

1. Points: rows with equal vectors become one point that keeps its KEEP
   smallest ids, which is all that a list of `k` neighbours can use. Repeated rows are
   dropped first; the limit is then taken before the shuffle as well, so a very common
   vector costs a task no more.
2. Forest: TREES trees are fitted on a sample of about SAMPLE points, on the
   driver. A node splits its points by the plane halfway between two of them,
   until LEAF points or fewer are left. Every point is then routed to its leaf in every tree.
3. Search: a query walks all trees with one priority queue ordered by the least
   distance to a plane on its way, and takes leaves until they hold SEARCH
   points of the sample. How much of the nearest that finds depends on the rows, so it is measured:
   MEASURED of the queries are searched in the sample and compared with all of it. Below RECALL
   the search doubles once; where that is not enough either, the forest is one tree
   of large leaves and a query takes all of them, which misses nothing.
4. Rerank: a leaf's points meet the queries that chose it, in blocks of about
   CHUNK points and CHUNK queries; true distances are computed in double precision on the original
   vectors and each block passes on the KEEP nearest ids of each query.

Nothing is collected but the sample (bounded by SAMPLE) and the measured queries; the forest, at most
2 * TREES * SAMPLE / LEAF planes, is broadcast.

Defined cases: vectors that are null, zero, or hold null or non-finite entries
take no part, nor do those of another length than most have (the longer on a tie), nor rows
with a null id; a query's own row is never its neighbour, others with an equal vector
are, at distance 0; ties go to the smaller id; repeated ids count once, at the least
distance of their vectors; with fewer candidates than k, all found are returned. Vectors may
have any length; columns beside the id and the vector may have any name and are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir

TREES, LEAF, SAMPLE = 16, 32, 40_000
SEARCH = 6_000
MEASURED, RECALL = 200, 0.97
WHOLE_LEAF = 2_500
CHUNK = 4_096
ASKING = 64  # queries at once in a rerank
K = 10
KEEP = K + 1
QUERY_EVERY = 100
SEED = 13


class Forest:
    """Trees as arrays: children of node i are left[i], right[i]; leaves have left -1 and a leaf number in right."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, leaf: int = LEAF):
        rng = np.random.Generator(np.random.PCG64(SEED))
        planes, offsets, left, right, self.members, self.roots = [], [], [], [], [], []
        zero = np.zeros(sample.shape[1], np.float32)

        def add() -> int:
            planes.append(zero)
            offsets.append(0.0)
            left.append(-1)
            right.append(-1)
            return len(left) - 1

        for _ in range(trees):
            root = add()
            self.roots.append(root)
            todo = [(root, np.arange(len(sample)))]
            while todo:
                node, rows = todo.pop()
                plane = self._split(sample, rows, rng) if len(rows) > leaf else None
                if plane is None:
                    right[node] = len(self.members)
                    self.members.append(rows)
                    continue
                planes[node], offsets[node], side = plane
                left[node], right[node] = add(), add()
                todo += [(left[node], rows[~side]), (right[node], rows[side])]
        self.planes, self.offsets = np.array(planes), np.array(offsets, np.float32)
        self.left, self.right, self.sizes = np.array(left), np.array(right), np.array([len(m) for m in self.members])

    def shared(self) -> dict:
        """What workers need: all but the sample's rows in each leaf."""
        return {k: v for k, v in self.__dict__.items() if k != "members"}

    @staticmethod
    def _split(sample: np.ndarray, rows: np.ndarray, rng: np.random.Generator):
        for _ in range(4):
            a, b = sample[rng.choice(rows, 2, replace=False)]
            plane = b - a
            length = float(np.sqrt((plane * plane).sum()))
            if not length:
                continue
            plane = (plane / length).astype(np.float32)
            offset = float(plane @ ((a + b) / 2))
            side = sample[rows] @ plane > offset
            if 0.02 * len(rows) < side.sum() < 0.98 * len(rows):
                return plane, offset, side
        return None

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf number of each row of x in each tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            while (open_ := np.flatnonzero(self.left[at] >= 0)).size:
                node = at[open_]
                side = np.einsum("ij,ij->i", x[open_], self.planes[node]) > self.offsets[node]
                at[open_] = np.where(side, self.right[node], self.left[node])
            out[:, t] = self.right[at]
        return out

    def search(self, x: np.ndarray, wanted: int = SEARCH) -> list[int]:
        """Leaves in the order of the shared queue until they hold `wanted` sample points."""
        heap = [(-np.inf, r) for r in self.roots]
        heapq.heapify(heap)
        out, held = [], 0
        while heap and held < wanted:
            way, node = heapq.heappop(heap)
            while self.left[node] >= 0:
                margin = float(x @ self.planes[node] - self.offsets[node])
                near, far = (self.right[node], self.left[node]) if margin > 0 else (self.left[node], self.right[node])
                heapq.heappush(heap, (max(way, abs(margin)), far))
                node = near
            out.append(int(self.right[node]))
            held += max(1, int(self.sizes[self.right[node]]))
        return out


def _recall(forest: Forest, sample: np.ndarray, asking: np.ndarray, wanted: int, k: int) -> float:
    """The share of the k sample points nearest to each of some vectors (but for equal ones) that a search finds."""
    rows = sample.astype(np.float64)
    squares = (rows * rows).sum(1)
    found = total = 0
    for x in asking:
        distance = squares - 2 * (rows @ x.astype(np.float64))
        distance[(sample == x).all(1)] = np.inf
        near = np.argsort(distance, kind="stable")[:k]
        near = near[np.isfinite(distance[near])]
        held = np.concatenate([forest.members[leaf] for leaf in forest.search(x, wanted)])
        found, total = found + int(np.isin(near, held).sum()), total + len(near)
    return found / total if total else 1.0


def fitted(sample: np.ndarray, asking: np.ndarray, search: int, k: int) -> tuple[Forest, int]:
    """A forest and the number of sample points that a search in it takes, for a recall of RECALL
    among the sample. The neighbours among all points are nearer still than those in the
    sample, so they are found more easily."""
    forest = Forest(sample)
    for wanted in (search, 2 * search):
        if _recall(forest, sample, asking, wanted, k) >= RECALL:
            return forest, wanted
    whole = Forest(sample, 1, WHOLE_LEAF)
    return whole, int(whole.sizes.sum())


def points(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """e, ids (the KEEP smallest, ascending), id (the smallest) and a number of its own for each distinct vector that takes part."""
    usable = vectors.select(F.col(key).alias("id"), F.transform(vector, lambda x: x + F.lit(0).cast("float")).alias("e")).filter(
        F.col("id").isNotNull() & F.col("e").isNotNull() & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("e", lambda x: x != 0))
    common = usable.groupBy(F.size("e").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    usable = usable.filter(F.size("e") == (common[0].dim if common else 0))
    # Row numbers count ids once repeated rows are gone; Spark also cuts by them before the shuffle.
    ranked = usable.groupBy("e", "id").agg(F.lit(1)).select("e", "id").withColumn(
        "_k", F.row_number().over(W.partitionBy("e").orderBy("id"))).filter(F.col("_k") <= KEEP)
    return (ranked.groupBy("e").agg(F.array_sort(F.collect_list("id")).alias("ids"))
            .select("e", "ids", F.get("ids", F.lit(0)).alias("id"), F.monotonically_increasing_id().alias("point")))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K,
            search: int = SEARCH) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `queries` (rows of `vectors`) its k nearest found."""
    if k >= KEEP:
        raise ValueError(f"k is at most {K}")
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    all_points = points(vectors, key, vector).checkpoint()
    total = all_points.count()
    share = min(1.0, SAMPLE / max(total, 1))
    drawn = all_points.select("id", "e").filter(F.pmod(F.xxhash64("id", "e"), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = sorted((r.id, r.e) for r in drawn.toLocalIterator())
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sample:
        return empty
    asked = queries.select(F.col(key).alias("query_id"), F.transform(vector, lambda x: x + F.lit(0).cast("float")).alias("e")).distinct()
    # A point answers for all queries with its vector.
    asked = asked.join(all_points.select("e", F.col("point").alias("query")), "e").select("query_id", "query").checkpoint()
    query_points = all_points.join(asked.select(F.col("query").alias("point")).distinct(), "point", "left_semi").select("point", "e")
    measured = query_points.select(F.xxhash64("e").alias("h"), "e").orderBy("h", "e").limit(MEASURED).collect()
    if not measured:
        return empty
    fit, search = fitted(np.array([e for _, e in sample], np.float32), np.array([r.e for r in measured], np.float32), search, k)
    forest = spark.sparkContext.broadcast(fit.shared())

    def revived() -> Forest:
        f = Forest.__new__(Forest)
        f.__dict__ = forest.value
        return f

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = revived()
        for b in batches:
            if not b.num_rows:
                continue
            leaves = f.leaves_of(_matrix(b.column(1)))
            for t in range(leaves.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(leaves[:, t]), b.column(0), b.column(1)], names=["leaf", "ids", "e"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = revived()
        for b in batches:
            if not b.num_rows:
                continue
            chosen = [f.search(x, search) for x in _matrix(b.column(1))]
            take = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
            yield pa.RecordBatch.from_arrays([pa.array([c for cs in chosen for c in cs], pa.int64()),
                                              b.column(0).take(pa.array(take)), b.column(1).take(pa.array(take))],
                                             names=["leaf", "query", "e"])

    number = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    visits = query_points.repartition(number, "point").mapInArrow(look, "leaf long, query long, e array<float>")
    # A leaf's points lie in numbered chunks, its visits in numbered parts; each part meets each chunk.
    routed = all_points.select("ids", "e").mapInArrow(route, "leaf long, ids array<long>, e array<float>").checkpoint()
    chunks = routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (CHUNK / 2)).alias("chunks"))
    in_chunk = F.pmod(F.xxhash64("e"), F.col("chunks"))
    # No leaf has more visits than there are queries.
    parts = max(1, math.ceil(asked.select("query").distinct().count() / CHUNK))
    held = routed.join(chunks, "leaf").select("leaf", in_chunk.alias("chunk"), "ids", "e").select(
        "leaf", "chunk", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "ids", "e")
    sent = visits.join(chunks, "leaf").select(
        "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int").alias("part"), "query", "e")

    def rerank(asking, there):
        import pandas as pd

        found = {"query": [], "id": [], "score": []}
        if len(asking) and len(there):
            x = np.stack(there["e"].to_numpy()).astype(np.float64)
            ids, at = np.concatenate(there["ids"].to_numpy()), np.repeat(np.arange(len(x)), there["ids"].map(len))
            order = np.argsort(ids, kind="stable")
            ids, at = ids[order], at[order]
            repeated = (ids[1:] == ids[:-1]).any()
            squares = (x * x).sum(1)
            for i in range(0, len(asking), ASKING):
                e = np.stack(asking["e"].iloc[i:i + ASKING].to_numpy()).astype(np.float64)
                # Exact but for rounding: it only rules points out. Not by `@`, whose threads would crowd the tasks.
                rough = squares[:, None] - 2 * np.einsum("ij,kj->ik", x, e)
                if len(x) > KEEP and not repeated:
                    slack = 1e-9 * (squares.max() + (e * e).sum(1))
                    within = rough <= np.partition(rough, KEEP - 1, axis=0)[KEEP - 1] + slack
                else:
                    within = np.ones(rough.shape, bool)
                for j, q in enumerate(asking["query"].iloc[i:i + ASKING]):
                    own = np.flatnonzero(within[:, j])
                    d = np.full(len(x), np.inf)
                    d[own] = np.sqrt(((x[own] - e[j]) ** 2).sum(1))
                    here = np.flatnonzero(within[at, j])
                    best = here[np.argsort(d[at[here]], kind="stable")]
                    if repeated:
                        best = best[np.sort(np.unique(ids[best], return_index=True)[1])]
                    best = best[:KEEP]
                    found["query"] += [q] * len(best)
                    found["id"] += ids[best].tolist()
                    found["score"] += d[at[best]].tolist()
        return pd.DataFrame(found).astype({"query": "int64", "id": "int64", "score": "float64"})

    near = (sent.groupBy("leaf", "chunk", "part").cogroup(held.groupBy("leaf", "chunk", "part"))
            .applyInPandas(rerank, "query long, id long, score double"))
    best = (near.groupBy("query", "id").agg(F.min("score").alias("score"))
            .withColumn("_k", F.row_number().over(W.partitionBy("query").orderBy("score", "id"))).filter(F.col("_k") <= KEEP)
            .groupBy("query").agg(F.collect_list(F.struct("id", "score")).alias("near")))
    # An id that asks with several vectors has one list.
    found = (asked.join(best, "query").select("query_id", F.explode("near").alias("x")).filter(F.col("x.id") != F.col("query_id"))
             .groupBy("query_id", F.col("x.id").alias("vec_id")).agg(F.min("x.score").alias("score")))
    return (found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def neighbours(vectors: DataFrame) -> DataFrame:
    """The contract's query: rows whose vec_id is divisible by QUERY_EVERY, against all rows."""
    return nearest(vectors, vectors.filter(F.col("vec_id") % QUERY_EVERY == 0))
