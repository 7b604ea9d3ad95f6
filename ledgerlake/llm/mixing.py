"""Mixing sources to target weights, in blocks of words.

1. Pack: the documents of a source, in a fixed pseudorandom order, form one
   stream of words, cut into blocks of `block` words (the last may be shorter).
2. Targets: each source's share of all words by weight, at most MAX_EPOCHS
   times its size, the excess reshared by weight until none is above.
3. Draw: the mix has as many slots as the targets have blocks, dealt into
   output shards. A shard's slots draw their sources from the multinomial of
   the targets by inverse CDF at stratified uniforms: slot i of a shard draws at
   (i + u) / slots with u from a hash of shard and slot. So the expectation of
   each count is the multinomial's, and its spread stays below one slot per shard.
4. Map: the j-th slot of a source takes block p(j mod blocks) in epoch
   j div blocks, where p permutes the block indexes pseudorandomly, by
   swap-or-not rounds keyed by seed, source and epoch.
5. Join the packed blocks with the slots by (source, block index).

No step gathers a source in one task: offsets come from sums of buckets of
about BUCKET_ROWS rows, then a window inside a bucket; slots are made per
(source, shard); the join key is (source, block index). Only functions of
DataFrames and SQL are used.

Defined cases: a null or blank text has size 0 and is never drawn; a null
source is a source of its own, last in order; repeated rows are rows of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import bind, word_count
from ledgerlake.session import ensure_checkpoint_dir

BLOCK = 32
SHARD_SLOTS = 4096
MAX_EPOCHS = 3
CYCLE = 3  # weights 1, 2, 3, repeating
ROUNDS = 8
BUCKET_ROWS = 4_000
SEED = 20240607


def _uniform(*key: Column) -> Column:
    """A hash of the key, in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *key), 11) / F.lit(float(1 << 53))


def permuted(j: Column, n: Column, *key: Column) -> Column:
    """A keyed pseudorandom permutation of 0 .. n-1 at j, by swap-or-not rounds:
    a round pairs x with k - x mod n, and a hash of the pair decides on the swap.
    A fold over the rounds keeps the expression small."""
    def step(x: Column, r: Column) -> Column:
        k = F.pmod(F.xxhash64(F.lit(SEED), r, *key), n)
        swap = lambda o: F.xxhash64(F.lit(SEED), -1 - r, F.greatest(x, o), *key).bitwiseAND(F.lit(1)) == 1
        return bind(F.pmod(k - x, n), lambda o: F.when(swap(o), o).otherwise(x))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), j, step)


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, n_rows, source_size, sid (rank by code point, null last), weight, target.

    `sizes` has source and size. The excess is reshared in closed form: with
    sources in order of size / weight, the capped ones are a head of that order,
    so running sums give for each head what the rest would get per weight.
    """
    s = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size"))
    # One row per source from here on; its windows never see documents.
    s = s.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    s = s.withColumn("weight", (F.col("sid") - 1) % CYCLE + 1)
    order = W.orderBy(F.col("source_size") / F.col("weight"), "sid")
    ahead, every = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    cap = MAX_EPOCHS * F.col("source_size")
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(ahead), F.lit(0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))
    s = s.withColumn("_rate", F.greatest(left, F.lit(0)) / weights).withColumn("_capped", cap < F.col("_rate") * F.col("weight"))
    # The rate of the first source that stays below its cap holds for all after it.
    rate = F.min(F.when(~F.col("_capped"), F.struct(F.col("source_size") / F.col("weight"), "sid", "_rate"))).over(every)
    return (s.withColumn("target", F.least(cap.cast("double"), F.coalesce(rate["_rate"], F.lit(float("inf"))) * F.col("weight")))
            .drop("_rate", "_capped"))


def packed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds sid, source_size, target and `start`, the row's offset in its source's stream.

    `rows` has source, size and _order (a hash that orders and buckets rows).
    """
    small = sources.select(F.col("source").alias("_src"), "sid", "n_rows", "source_size", "target")
    placed = rows.join(small, F.col("source").eqNullSafe(F.col("_src"))).drop("_src").withColumn(
        "_bucket", F.pmod(F.col("_order"), F.ceil(F.col("n_rows") / BUCKET_ROWS)))
    totals = placed.groupBy("sid", "_bucket").agg(F.sum("size").alias("_sum"))
    ahead = W.partitionBy("sid").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("sid", "_bucket", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    inside = W.partitionBy("sid", "_bucket").orderBy("_order", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    return (placed.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(offsets, ["sid", "_bucket"])
            .withColumn("start", F.col("_ahead") + F.col("_in"))
            .drop("_in", "_ahead", "n_rows", "_bucket"))


def drawn_blocks(sources: DataFrame, block: int, shard_slots: int) -> DataFrame:
    """sid, b and n: how many slots of the mix hold block b of source sid."""
    every = W.partitionBy()
    below = W.orderBy("sid").rowsBetween(W.unboundedPreceding, -1)
    s = (sources.filter("source_size > 0")
         .withColumn("_all", F.sum("target").over(every))
         .withColumn("_lo", F.coalesce(F.sum("target").over(below), F.lit(0.0)) / F.col("_all"))
         .withColumn("_hi", F.lead("_lo").over(W.orderBy("sid")))
         .withColumn("_slots", F.ceil(F.col("_all") / block))
         # No fewer slots a shard than sources, so the pairs of both stay below the slots.
         .withColumn("_per", F.greatest(F.count(F.lit(1)).over(every), F.lit(shard_slots)))
         .withColumn("blocks", F.ceil(F.col("source_size") / block)))
    shards = s.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_slots") - 1) / F.col("_per")))))
    here = F.least(F.col("_per"), F.col("_slots") - F.col("shard") * F.col("_per"))

    def before(x: Column) -> Column:
        """Slots of the shard whose draw lies below x."""
        i = F.floor(x * here)
        return F.least(i + F.when(_uniform(F.col("shard"), i) < x * here - i, 1).otherwise(0), here)

    count = F.when(F.col("_hi").isNull(), here).otherwise(before(F.col("_hi"))) - before(F.col("_lo"))
    ahead = W.partitionBy("sid").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    counts = shards.withColumn("n", count).withColumn("_first", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    # A block is never drawn more than MAX_EPOCHS times: slots beyond that stay empty.
    last = F.least(F.col("_first") + F.col("n"), F.col("blocks") * MAX_EPOCHS)
    slots = (counts.filter(last > F.col("_first"))
             # A number keeps these few rows, which become all the slots, from being coalesced.
             .repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("sid"), F.col("shard"))
             .select("sid", "blocks", F.explode(F.sequence(F.col("_first"), last - 1)).alias("j")))
    slots = slots.withColumn("epoch", F.floor(F.col("j") / F.col("blocks")))
    b = permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.col("sid"), F.col("epoch"))
    return slots.select("sid", b.alias("b")).groupBy("sid", "b").agg(F.count(F.lit(1)).alias("n"))


def mix(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix by document row: doc_id, source, size, source_size, target, _order, start and
    `pieces`: array<struct<lo, hi, n>>, the words lo to hi (exclusive) of the row, taken n times."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       F.xxhash64(F.lit(SEED), "doc_id", "text").alias("_order"))
    ensure_checkpoint_dir(docs.sparkSession)
    rows = rows.checkpoint()  # a few numbers a document; texts are split once
    sources = source_targets(rows).checkpoint()
    at = packed(rows, sources)
    start, end = F.col("start"), F.col("start") + F.col("size")
    piece = at.filter("size > 0").select(
        "*", F.explode(F.sequence(F.floor(start / block), F.floor((end - 1) / block))).alias("b"))
    lo, hi = F.greatest(F.col("b") * block - start, F.lit(0)), F.least(F.col("b") * block + block - start, F.col("size"))
    cut = piece.select("sid", "b", "doc_id", "_order", "start", lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    taken = (cut.join(drawn_blocks(sources, block, shard_slots).hint("merge"), ["sid", "b"])
             .groupBy("sid", "start", "doc_id", "_order")
             .agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "n"))).alias("pieces")))
    # Rows of size 0 share a start with the next row; they are never drawn.
    keys = ["sid", "start", "doc_id", "_order"]
    full, none = at.filter("size > 0"), at.filter("size = 0")
    keep = ["doc_id", "source", "size", "source_size", "target", "_order", "start"]
    joined = full.alias("f").join(taken.alias("t"), [F.col(f"f.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys], "left")
    empty = F.array().cast("array<struct<lo:int,hi:int,n:bigint>>")
    return joined.select(*[F.col(f"f.{c}") for c in keep], F.coalesce("t.pieces", empty).alias("pieces")).unionByName(
        none.select(*keep, empty.alias("pieces")))


def mix_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for a `documents` table."""
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + (p["hi"] - p["lo"]) * p["n"])
    return mix(docs).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_texts(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as documents: per row and copy c = 1 .. MAX_EPOCHS the words drawn
    at least c times, with the white space that follows each; copies without
    words vanish. Columns stay, n_chars counts the new text."""
    m = mix(docs, block).filter(F.size("pieces") > 0).select(
        F.col("doc_id").alias("_id"), F.col("_order").alias("_o"), F.col("source").alias("_s"), "size", "pieces")
    # Equal rows of a source are one text: their pieces join one list.
    drawn = m.groupBy("_id", "_o", "_s").agg(F.flatten(F.collect_list("pieces")).alias("pieces"))
    texts = docs.withColumn("_o", F.xxhash64(F.lit(SEED), "doc_id", "text")).dropDuplicates(["doc_id", "_o", "source"])
    spaced = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    same = F.col("d.doc_id").eqNullSafe(F.col("m._id")) & (F.col("d._o") == F.col("m._o")) & F.col("d.source").eqNullSafe(F.col("m._s"))
    copies = (texts.alias("d").join(drawn.alias("m"), same)
              .select("d.*", "m.pieces", spaced.alias("_w"))
              .withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(MAX_EPOCHS)))))
    part = F.filter("pieces", lambda p: p["n"] >= F.col("_c"))
    text = F.array_join(F.flatten(F.transform(part, lambda p: F.slice("_w", p["lo"] + 1, p["hi"] - p["lo"]))), "")
    out = copies.withColumn("text", text).filter("text <> ''")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
