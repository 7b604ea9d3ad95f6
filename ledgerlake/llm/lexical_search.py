"""Ranked lexical search by bag deduplication.

Of a document only the terms of the items matter, and of these only how often each
occurs, beside the length term m. So documents are reduced to bags:

1. Each text becomes its number of terms n and its bag, the sorted (term, tf)
   pairs within the items' vocabulary, as bytes. N and L are sums over all documents.
2. Documents with equal bag and m form a class. They meet by a 64-bit hash of both,
   which spreads the shuffle, and are verified by grouping on the bytes themselves.
   A class keeps its least
   doc_ids: an item's top k holds at most k of a class, the least ones. Spark
   cuts to k rows a class before the shuffle, so a class of a third of all
   rows sends k rows a task.
3. Each class is scored once against the items' postings in 64-bit integers. A
   task carries the best k of each item from batch to batch and emits only these;
   a last window by item takes the best of them.

The items are a stated query set. Their postings are broadcast in blocks of at about
BLOCK_POSTINGS entries (items dealt by hash, an item never parted), one pass over the
documents a block, so what is broadcast does not grow with either table.

Defined cases: a null text has no term, and neither has one without letters, digits or
characters beyond ASCII: such a document counts nowhere and is never found, such an item
has no rows. Repeated item rows count once, and rows of one item_id with different texts
are one item with the terms of all; a null item_id is an id like any other. A repeated
document row is a document of its own and is listed as often as its rank allows; a null
doc_id comes last among equal scores. Empty tables give an empty result; only
`doc_id`, `item_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir

# Fixed by the task.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
SCALE, SATURATION, LENGTH_SHARE, WEIGHT_SCALE = 1_000_000_000, 8, 90, 1000

BLOCK_POSTINGS = 250_000
CELLS = 2_000_000  # scores that a task holds at once
_TERM = re.compile(TERM)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_LOWER))


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """item, term: the distinct terms of each item."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (items.select(F.col(key).alias("item"), F.explode(F.array_distinct(F.regexp_extract_all(lower, F.lit(f"({TERM})")))).alias("term"))
            .distinct())


def bags(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """doc_id, n, bag for each document with a term. The bag is the little-endian 32-bit
    numbers term, tf, term, tf, ... by term; empty where no term is in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for b in batches:
            sizes, packed = [], []
            for text in b.column(1):  # one text at a time: a batch may hold long ones
                found = terms(text.as_py())
                sizes.append(len(found))
                held = sorted((number[t], c) for t, c in Counter(found).items() if t in number)
                packed.append(np.array(held, "<u4").tobytes())
            keep = pa.array(np.array(sizes, np.int64) > 0, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["doc_id", "n", "bag"]).filter(keep)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, bag binary")


def bag_sums(bagged: DataFrame) -> tuple[int, int]:
    """N and L: the documents with a term and all their terms."""
    row = bagged.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_terms")).first()
    return row.n_docs, row.n_terms or 0


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of a column of bags."""
    raw = [v.as_py() for v in column]
    row = np.repeat(np.arange(len(raw)), [len(r) // 8 for r in raw])
    pairs = np.frombuffer(b"".join(raw), "<u4").reshape(-1, 2).astype(np.int64)
    return row, pairs[:, 0], pairs[:, 1]


def document_frequencies(bagged: DataFrame, size: int) -> np.ndarray:
    """For each of the `size` terms the documents that hold it. A task sends one row a term it has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(_unpacked(b.column(0))[1], minlength=size)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(df[seen], pa.int64())], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in bagged.select("bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


def term_weight(df: int, n_docs: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def classes(bagged: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """bag, m, ids: each class of documents of equal bag and m, with its k least doc_ids."""
    m = F.expr(f"{100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {n_docs}L) div {max(n_terms, 1)}L")
    keyed = bagged.filter(F.length("bag") > 0).select(F.col("doc_id").cast("long").alias("id"), "bag", m.alias("m"))
    keyed = keyed.withColumn("hash", F.xxhash64("bag", "m"))
    by_class = W.partitionBy("hash", "bag", "m").orderBy(F.col("id").asc_nulls_last())
    least = keyed.withColumn("_k", F.row_number().over(by_class)).filter(F.col("_k") <= k)
    # Structs, as collect_list leaves out nulls.
    return least.groupBy("hash", "bag", "m").agg(F.collect_list(F.struct("id")).alias("ids")).select("bag", "m", "ids")


class Postings:
    """The items of a block by term, and the weight of each term."""

    def __init__(self, term: np.ndarray, item: np.ndarray, weight: np.ndarray, n_items: int):
        order = np.argsort(term, kind="stable")
        self.item, self.weight, self.n_items = item[order], weight, n_items
        self.count = np.bincount(term, minlength=len(weight))
        self.first = np.cumsum(self.count) - self.count

    def scores(self, row: np.ndarray, term: np.ndarray, part: np.ndarray, rows: int) -> np.ndarray:
        """(rows, items) sums of weight * part over the terms that row and item share."""
        times = self.count[term]
        begin = np.cumsum(times) - times
        at = np.arange(times.sum()) + np.repeat(self.first[term] - begin, times)
        out = np.zeros(rows * self.n_items, np.int64)
        np.add.at(out, np.repeat(row, times) * self.n_items + self.item[at], np.repeat(self.weight[term] * part, times))
        return out.reshape(rows, self.n_items)


class BestOfItems:
    """The k best documents of each item: highest score, then least id, null last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.held = np.empty((0, 4), np.int64)  # item, score, id is null, id
        self.least = np.ones(n_items, np.int64)  # scores below cannot enter

    def add(self, scores: np.ndarray, ids: pa.ListArray) -> None:
        floor = self.least
        if len(scores) > self.k:
            floor = np.maximum(floor, np.partition(scores, len(scores) - self.k, axis=0)[-self.k])
        row, item = np.nonzero(scores >= floor)
        if not len(row):
            return
        members = ids.take(pa.array(row))
        number = members.flatten().field(0)
        times = members.value_lengths().to_numpy()
        value = scores[row, item]
        new = np.stack([np.repeat(item, times), np.repeat(value, times), number.is_null().to_numpy(zero_copy_only=False),
                        number.fill_null(0).to_numpy()], 1)
        held = np.concatenate([self.held, new])
        held = held[np.lexsort((held[:, 3], held[:, 2], -held[:, 1], held[:, 0]))]
        first = np.searchsorted(held[:, 0], held[:, 0])
        place = np.arange(len(held)) - first
        self.held = held[place < self.k]
        last = held[place == self.k - 1]
        self.least[last[:, 0]] = last[:, 1]


def _score_block(found: DataFrame, postings: Postings, items: list, kind: str, k: int) -> DataFrame:
    # Plain values: a worker may not have this module.
    shared = found.sparkSession.sparkContext.broadcast((vars(postings), items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, items = shared.value
        postings = Postings.__new__(Postings)
        vars(postings).update(values)
        best = BestOfItems(len(items), k)
        for b in batches:
            row, term, tf = _unpacked(b.column(0))
            part = (SCALE * tf) // (WEIGHT_SCALE * tf + SATURATION * b.column(1).to_numpy()[row])
            # Parts of the batch whose scores, and whose pairs of a term and an item, stay within CELLS.
            cost = np.maximum(np.bincount(row, postings.count[term], minlength=b.num_rows), len(items))
            group = (np.cumsum(cost) // CELLS).astype(np.int64)
            for low, high in zip(np.searchsorted(group, np.unique(group)), np.searchsorted(group, np.unique(group), "right")):
                i, j = np.searchsorted(row, [low, high])
                scores = postings.scores(row[i:j] - low, term[i:j], part[i:j], int(high - low))
                best.add(scores, b.column(2).slice(low, high - low))
        item, score, null, number = best.held.T
        yield pa.RecordBatch.from_arrays(
            [pa.array([items[i] for i in item], names_type), pa.array(score), pa.array(number, mask=null.astype(bool))],
            names=["item_id", "score", "doc_id"])

    names_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    return found.mapInArrow(run, f"item_id {kind}, score long, doc_id long")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest scoring of all documents for each item.
    item_id is a long, an int or a string."""
    spark: SparkSession = docs.sparkSession
    ensure_checkpoint_dir(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    pairs = item_terms(items).checkpoint()
    total = pairs.count()
    n_blocks = 1 if total <= block_postings else math.ceil(2 * total / block_postings)
    found, sums = None, None
    for block in range(n_blocks):
        own = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).toArrow().to_pydict()
        if not own["item"]:
            continue
        vocabulary = {t: i for i, t in enumerate(sorted(set(own["term"])))}
        names = list(dict.fromkeys(own["item"]))
        number = {v: i for i, v in enumerate(names)}
        bagged = bags(docs, vocabulary).checkpoint()
        sums = sums or bag_sums(bagged)
        df = document_frequencies(bagged, len(vocabulary))
        weight = np.array([term_weight(int(d), sums[0]) for d in df], np.int64)
        postings = Postings(np.array([vocabulary[t] for t in own["term"]], np.int64),
                            np.array([number[v] for v in own["item"]], np.int64), weight, len(names))
        part = _score_block(classes(bagged, *sums, k), postings, names, kind, k)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    by_item = W.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
