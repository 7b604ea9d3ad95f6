"""Similarity join on word shingles by grouped prefixes.

Documents whose shingle sets overlap by a Jaccard similarity of at least
`percent`/100 are linked. The result names each document's component.

1. Sets: a document's distinct shingles, as 64-bit hashes. Documents with
   equal sets become one node.
2. Reach: take the first part of a set in hash order, p + k entries long,
   where p = n - need + 1 and need is the least overlap with any partner. A
   partner misses at most n - need of a set's entries, so k + 1 of that part
   recur in it. Nodes in which fewer recur anywhere have no partner. Entries that
   recur within a batch are counted there and sent on once for the batch.
3. Order: among the rest, shingles are ordered by how many nodes hold them,
   rare first. The prefix is the first p entries; two linked nodes share one of them.
   Shingles of one node only come first in it and cannot be shared, so they are left out.
4. Groups: nodes with the same prefix and set size form one group. Groups
   meet on shared prefix entries; pairs whose sizes or positions rule a link out are
   dropped, the others expanded to members, and their overlap is counted.
5. Only components are asked for, so pairs inside one component are not
   needed. A star round therefore first compares every group with a few hubs of
   each entry's list. That links many nodes, and gives nodes that resemble
   one hub a common home.
6. Homes: within one, the core is what more than half of its nodes hold. A node a is
   known by its difference d(a), what only it or only the core holds, of which m(a)
   entries miss from it. Two nodes share |core| - m(a) - m(b) + |d(a) & d(b)| entries,
   whatever the core is. So they must share a number of differences that follows from
   their sizes and m. Where that is none, both are linked with the node of the home that
   has the least m for its size: a star. The others meet on prefixes of their
   differences, ordered as in step 3, of which near copies have few in common.
7. Then all pairs of groups that lie in different components and not in one home
   are verified: no link between components is missed, and no group of near
   copies is expanded into all its pairs.

Every list is dealt by shingle, group or node through Spark's joins and
aggregates; a shingle that very many documents share is combined before the
shuffle, split by adaptive skew joins, and stands last in the order. Lineage is
cut by checkpoints in the shared folder.

Defined cases: a null or blank text has an empty set (n_shingles 0) and links
with nothing; with fewer words than a shingle, the whole sequence is the one
shingle; texts of any length give their whole set; repeated rows (also of one doc_id) are equal sets; null doc_ids take part and
count as largest; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import shuffles_released, small_batches
from ledgerlake.session import ensure_checkpoint_dir

SHINGLE = 5
PERCENT = 80
HUBS, STAR_ENTRIES = 4, 10
REACH_PERCENT = 5  # k of step 2, in percent of the set
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_CHUNK = 1 << 16


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Shingler:
    """Distinct hashed shingles of texts: rolling polynomial hashes over the
    lower-cased words joined by single spaces, with random values for bytes."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        values = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        values[65:91] = values[97:123]  # A-Z as a-z
        self.values = values
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.up, self.down = _powers(_CHUNK)

    def __call__(self, text: str | None) -> np.ndarray:
        return np.unique(self.in_order(text))

    def in_order(self, text: str | None) -> np.ndarray:
        """The hash of each run of `size` words; of all words, if there are fewer."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        gap = self.space[raw]
        # One space after each word; leading and further separators go.
        keep = ~gap
        keep[1:] |= ~gap[:-1]
        raw, gap = raw[keep], gap[keep]
        if not len(raw):
            return np.empty(0, np.int64)
        if gap[-1]:
            raw, gap = raw[:-1], gap[:-1]
        if len(raw) > len(self.up):
            self.up, self.down = _powers(2 * len(raw))
        value = self.values[raw]
        value[gap] = self.values[32]
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(value * self.up[:len(raw)], out=sums[1:])
        cuts = np.flatnonzero(gap)
        starts, ends = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(raw)]))
        if len(starts) > self.size:
            starts, ends = starts[:len(starts) - self.size + 1], ends[self.size - 1:]
        else:
            starts, ends = starts[:1], ends[-1:]
        h = (sums[ends] - sums[starts]) * self.down[starts]
        h ^= (ends - starts).astype(np.uint64)
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def least_overlap(n, percent: int = PERCENT):
    """What two sets of which one has n entries share at least if they are linked."""
    return (percent * n + 99) // 100


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _part(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _sets(docs: DataFrame, key: str, text: str, size: int, whole: bool) -> DataFrame:
    """key, n, digest, d (64 bits of it) of each row's set and, if `whole`, the set itself as `h`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for b in batches:
            sets = [shingles(t) for t in b.column(1).to_pylist()]
            columns = [b.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([_digest(x) for x in sets], pa.binary())]
            columns.append(pa.array([_part(x.as_py()) for x in columns[2]], pa.int64()))
            if whole:
                ends = np.cumsum([0] + [len(x) for x in sets]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(ends, np.concatenate([*sets, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n", "digest", "d", "h"][:len(columns)])

    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n long, digest binary, d long" + ", h array<long>" * whole)


def _reach(docs: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """d: a 64-bit part of the digest, for the sets that step 2 leaves.

    Equal parts of unequal digests only let a set stay. Rows of the pass over the
    texts, all with a key k by which they are dealt once:
    (k = h, d)          an entry h of d's first part that no other set of the batch has;
    (k = h, null)       an entry that sets of the batch share;
    (k = d, d, c, need) how many such entries d has, and how many must recur.
    A very common entry thus makes a row a batch. Equal sets of a batch count once;
    those of other batches add to both sums, which compare as for one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for b in batches:
            parts, need = {}, []
            for t in b.column(0).to_pylist():
                s = shingles(t)
                n = len(s)
                d = _part(_digest(s))
                if n and d not in parts:
                    k = n * REACH_PERCENT // 100
                    parts[d] = s[:n - least_overlap(n, percent) + 1 + k].copy()  # a slice would keep the set
                    need.append(k + 1)
            if not parts:
                continue
            ds, h = np.array(list(parts), np.int64), np.concatenate(list(parts.values()))
            owner = np.repeat(np.arange(len(ds)), [len(x) for x in parts.values()])
            entries, index, count = np.unique(h, return_inverse=True, return_counts=True)
            alone = count[index] == 1
            told = entries[count > 1]
            local = np.bincount(owner[~alone], minlength=len(ds))
            kind = np.repeat([0, 1, 2], [int(alone.sum()), len(told), len(ds)])
            pad = np.zeros(len(kind) - len(ds), np.int32)
            k = np.concatenate((h[alone], told, ds))
            d = np.concatenate((ds[owner[alone]], told, ds))
            yield pa.RecordBatch.from_arrays(
                [pa.array(k), pa.array(d, mask=kind == 1),
                 pa.array(np.concatenate((pad, local)).astype(np.int32), mask=kind != 2),
                 pa.array(np.concatenate((pad, need)).astype(np.int32), mask=kind != 2)], names=["k", "d", "c", "need"])

    small_batches(docs.sparkSession)
    dealt = docs.select(text).mapInArrow(run, "k long, d long, c int, need int").repartition("k")
    entry = F.when(F.col("c").isNull(), F.col("d"))
    recur = (dealt.groupBy("k").agg(F.min(entry).alias("lo"), F.max(entry).alias("hi"), F.max("need").alias("_need"),
                                    F.max(F.col("c").isNull() & F.col("d").isNull()).alias("told"))
             .withColumn("recurs", F.col("told") | (F.col("lo") != F.col("hi")))
             .filter(F.col("recurs") | F.col("_need").isNotNull()).select("k", "recurs"))
    found = F.coalesce("c", F.when(F.col("recurs"), 1).otherwise(0))
    return (dealt.join(recur.hint("merge"), "k").groupBy("d").agg(F.sum(found).alias("found"), F.sum("need").alias("need"))
            .filter("found >= need").select("d"))


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node reachable) for all nodes of edges (a, b)."""
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct().checkpoint()
    label = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("comp")).checkpoint()
    while True:
        near = (both.join(label.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("_near")))
        jump = label.select(F.col("node").alias("comp"), F.col("comp").alias("_jump"))
        # A label names a node of the graph, so both joins find every row.
        moved = (label.join(near, "node").join(jump, "comp")
                 .select("node", "comp", F.least("comp", "_near", "_jump").alias("_new")).checkpoint())
        if moved.filter("_new < comp").isEmpty():
            return label
        label = moved.select("node", F.col("_new").alias("comp"))


def _overlaps(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """a, b, na, nb and common, the overlap of their sets, for the pairs (a, b); `shared` has node, n and l, its shingles
    that other nodes hold too (the rest cannot be common)."""
    left = shared.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("l").alias("la"))
    right = shared.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("l").alias("lb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("la", "lb")).alias("common"))


def _similar(overlaps: DataFrame, percent: int) -> DataFrame:
    """The pairs of `overlaps` that are linked."""
    return overlaps.filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _linked(pairs: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    return _similar(_overlaps(pairs, shared), percent)


def _sizes_fit(x: Column, y: Column, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _merge(comps: DataFrame, links: DataFrame) -> DataFrame:
    """`comps` (node, comp) after joining the components of linked nodes."""
    at = lambda c, o: comps.select(F.col("node").alias(c), F.col("comp").alias(o))
    edges = (links.join(at("a", "ca"), "a").join(at("b", "cb"), "b").filter("ca <> cb")
             .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct().checkpoint())
    if edges.isEmpty():
        return comps.checkpoint()
    to = components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("_to"))
    return comps.join(to, "comp", "left").select("node", F.coalesce("_to", "comp").alias("comp")).checkpoint()


def _with_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """node, n, l (the shingles that other nodes hold too, rare first), p (its prefix), gid (its group)
    of the nodes of `sets` (node, n, h: the whole set) that can have a partner."""
    entries = sets.select("node", "n", F.explode("h").alias("h"))
    held = entries.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = (entries.join(held, "h").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
              .select("node", "n", F.transform("s", lambda x: x["h"]).alias("l")))
    alone = F.col("n") - F.size("l")
    room = F.col("n") - least_overlap_column(F.col("n"), percent) + 1 - alone
    return (shared.filter(room > 0).withColumn("p", F.slice("l", F.lit(1), room.cast("int")))
            .withColumn("gid", F.xxhash64("n", "p")).checkpoint())


def node_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: every linked pair of nodes of `sets`, a < b. Groups of one prefix and size meet on shared
    prefix entries, and the pairs that sizes and positions allow are expanded to members and verified.
    The result, and the work, grow with the number of similar pairs of different texts."""
    shared = _with_prefixes(sets, percent)
    lead = F.col("n") - F.size("l")
    posts = shared.groupBy("gid").agg(F.first("n").alias("n"), F.first("p").alias("p"), F.first(lead).alias("lead")).select(
        "gid", "n", "lead", F.posexplode("p").alias("at", "h")).select("gid", "n", "h", (F.col("n") - F.col("at") - F.col("lead")).alias("rest")).checkpoint()
    x, y = (posts.select("h", *[F.col(c).alias(f"{c}_{s}") for c in ("gid", "n", "rest")]) for s in "xy")
    need = F.ceil(F.lit(percent) * (F.col("n_x") + F.col("n_y")) / F.lit(100 + percent))
    meet = x.join(y, "h").filter((F.col("gid_x") <= F.col("gid_y")) & _sizes_fit(F.col("n_x"), F.col("n_y"), percent)
                                 & (F.least("rest_x", "rest_y") >= need)).select("gid_x", "gid_y").distinct()
    ends = lambda s, o: shared.select(F.col("gid").alias(f"gid_{s}"), F.col("node").alias(o))
    pairs = meet.join(ends("x", "a"), "gid_x").join(ends("y", "b"), "gid_y").filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return _linked(pairs, shared.select("node", "n", "l"), percent)


def _hub_pairs(posts: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """a, b: each node with the hubs of its `star` entries that sizes allow. A list has HUBS hub groups,
    drawn by hashes, and a group has one hub member. `posts` has gid, n, h, star, `members` gid and node."""
    arms = posts.filter("star").select("gid", "n", "h")
    rank = lambda c, k, *more: F.struct(F.xxhash64(F.lit(k), c).alias("r"), F.col(c).alias("hub"), *more)
    drawn = F.transform(F.array(*[F.min(rank("gid", k, "n")) for k in range(HUBS)]), lambda x: F.struct(x["hub"].alias("hub"), x["n"].alias("n")))
    hubs = arms.groupBy("h").agg(F.array_distinct(drawn).alias("to"))
    center = members.groupBy(F.col("gid").alias("hub")).agg(F.min(rank("node", 0))["hub"].alias("b"))
    met = (arms.join(hubs, "h").select("gid", "n", F.explode("to").alias("to")).filter(_sizes_fit(F.col("n"), F.col("to.n"), percent))
           .select("gid", "to.hub").distinct())
    return met.join(center, "hub").join(members.withColumnRenamed("node", "a"), "gid").filter("a <> b").select("a", "b").distinct()


def _homes(overlaps: DataFrame) -> DataFrame:
    """node, home: the hub that most nodes resemble among those that the node resembles: half of either set is common.
    `overlaps` has nodes a and hubs b. Nodes without such a hub, and hubs without such nodes, have no home."""
    like = overlaps.filter(2 * F.col("common") >= F.greatest("na", "nb")).select(F.col("a").alias("node"), F.col("b").alias("home"))
    size = like.groupBy("home").agg(F.count(F.lit(1)).alias("size"))
    own = size.select(F.col("home").alias("node"), "home", "size")
    return like.join(size, "home").select("node", "home", "size").union(own).groupBy("node").agg(
        F.max_by("home", F.struct("size", "home")).alias("home"))


def _differences(lists: DataFrame, homes: DataFrame, percent: int) -> DataFrame:
    """node, home, core (the size of the home's core), d (the node's difference), w: two nodes of a home share
    at least ceil((w + w') / (100 + percent)) - core differences if they are linked, and are linked if that is 0 or less."""
    at = lists.join(homes, "node")
    held = at.select("home", F.explode("l").alias("h")).groupBy("home", "h").agg(F.count(F.lit(1)).alias("c"))
    half = homes.groupBy("home").agg(F.count(F.lit(1)).alias("size"))
    cores = held.join(half, "home").filter("2 * c > size").groupBy("home").agg(F.collect_list("h").alias("core"))
    missing = F.array_except("core", "l")
    return at.join(cores, "home").select(
        "node", "home", F.size("core").alias("core"), F.concat(F.array_except("l", "core"), missing).alias("d"),
        (percent * F.col("n") + (100 + percent) * F.size(missing)).alias("w"))


def _stars(known: DataFrame, percent: int) -> DataFrame:
    """a, b: links of a home's nodes with its node of the least w; they join all nodes that must share no difference."""
    least = known.groupBy("home").agg(F.min(F.struct("w", "node")).alias("to"))
    return (known.join(least, "home").filter((F.col("w") + F.col("to.w") <= (100 + percent) * F.col("core")) & (F.col("node") != F.col("to.node")))
            .select(F.col("node").alias("a"), F.col("to.node").alias("b")))


def _outside(posts: DataFrame, key: list[str], labels: Column) -> DataFrame:
    """`posts` without the lists of one label, and whether each one lies `out` of its list's most frequent label.
    Entries of one label need not meet, so a list costs what lies out of that one times its length."""
    posts = posts.withColumn("_labels", labels)
    every = F.lit(-(1 << 63))
    named = F.col("label") != every
    lists = (posts.select(*key, F.explode(F.concat("_labels", F.array(every))).alias("label")).groupBy(*key, "label").count().groupBy(*key)
             .agg(F.max_by(F.when(named, F.col("label")), F.when(named, F.struct("count", "label"))).alias("_major"),
                  F.max(F.when(named, F.col("count"))).alias("_most"), F.max(F.when(~named, F.col("count"))).alias("_all"))
             .filter((F.col("_all") > 1) & (F.col("_all") > F.coalesce("_most", F.lit(0)))).select(*key, "_major"))
    return (posts.join(lists, key).withColumn("out", ~F.coalesce(F.array_contains("_labels", F.col("_major")), F.lit(False)))
            .drop("_labels", "_major"))


def _home_links(known: DataFrame, comps: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """a, b: the linked pairs of nodes of one home and different components; `comps` holds the links of `_stars`, `shared` is as in `_overlaps`."""
    shares = known.select("home", F.explode("d").alias("h")).groupBy("home", "h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    least = known.groupBy("home").agg(F.min("w").alias("least"))
    told = (known.select("node", "home", F.explode("d").alias("h")).join(shares, ["home", "h"])
            .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
            .select("node", F.transform("s", lambda x: x["h"]).alias("s")))
    both = lambda w: F.greatest(F.lit(1), F.ceil(w / F.lit(100 + percent)) - F.col("core"))
    room = F.size("s") - both(F.col("w") + F.col("least")) + 1
    near = (known.drop("d").join(told, "node").join(least, "home").filter(room > 0).join(comps, "node")
            .select("node", "home", "core", "w", "comp", F.size("s").alias("size"), F.posexplode(F.slice("s", F.lit(1), room.cast("int"))).alias("at", "h")))
    posts = near.withColumn("rest", F.col("size") - F.col("at")).checkpoint()
    full = _outside(posts, ["home", "h"], F.array("comp"))
    x, y = (full.select("home", "h", "core", "out", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "w", "comp", "rest")]) for s in "xy")
    pairs = (x.filter("out").drop("out").join(y.drop("core", "out"), ["home", "h"])
             .filter((F.col("comp_x") != F.col("comp_y")) & (F.least("rest_x", "rest_y") >= both(F.col("w_x") + F.col("w_y"))))
             .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct())
    return _linked(pairs, shared, percent)


def node_components(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """node, comp for the nodes of `sets` (node, n, h: the whole set) that lie in some group; others are alone."""
    shared = _with_prefixes(sets, percent)
    alone = F.col("n") - F.size("l")
    # Position 0 counts the shingles held alone, which stand first.
    groups = shared.groupBy("gid").agg(F.first("n").alias("n"), F.first("p").alias("p"), F.first(alone).alias("lead"),
                                       F.min("node").alias("low"))
    # Stars use the most common entries of each prefix only: near copies have those in common.
    posts = groups.select("gid", "n", "lead", F.posexplode("p").alias("pos", "h"), (F.size("p") - STAR_ENTRIES).alias("late")).select(
        "gid", "n", "h", (F.col("pos") + F.col("lead")).alias("pos"), (F.col("pos") >= F.col("late")).alias("star")).checkpoint()
    members = shared.select("gid", "node")
    lists = shared.select("node", "n", "l")

    met = _overlaps(_hub_pairs(posts, members, percent), lists).checkpoint()
    homes = _homes(met).checkpoint()
    known = _differences(lists, homes, percent).checkpoint()
    comps = _merge(shared.select("node", F.col("node").alias("comp")), _similar(met, percent).union(_stars(known, percent)))
    comps = _merge(comps, _home_links(known, comps, lists, percent).checkpoint())

    # All pairs of groups that are neither wholly in one component nor wholly in one home.
    placed = members.join(comps, "node").join(known.select("node", "home"), "node", "left").checkpoint()
    span = placed.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                     F.when((F.min("home") == F.max("home")) & (F.count("home") == F.count(F.lit(1))), F.min("home")).alias("home"))
    # Labels of homes are negative, those of components are not.
    labels = F.array_compact(F.array(F.when(F.col("lo") == F.col("hi"), F.col("lo")), -F.col("home") - 1))
    full = _outside(posts.drop("star").join(span, "gid"), ["h"], labels)
    x, y = (full.select("h", "out", *[F.col(c).alias(f"{c}_{s}") for c in ("gid", "n", "pos", "lo", "hi", "home")]) for s in "xy")
    rest = lambda s: F.col(f"n_{s}") - F.col(f"pos_{s}")
    need = F.ceil(F.lit(percent) * (F.col("n_x") + F.col("n_y")) / F.lit(100 + percent))
    housed = F.coalesce(F.col("home_x") == F.col("home_y"), F.lit(False))
    apart = (F.least("lo_x", "lo_y") != F.greatest("hi_x", "hi_y")) & ~housed
    # The first common entry bounds the overlap by what follows it on either side, so
    # linked groups meet at least there.
    meet = x.filter("out").drop("out").join(y.drop("out"), "h").filter(
        apart & _sizes_fit(F.col("n_x"), F.col("n_y"), percent) & (F.least(rest("x"), rest("y")) >= need))
    pairs = meet.select(F.least("gid_x", "gid_y").alias("gid_x"), F.greatest("gid_x", "gid_y").alias("gid_y")).distinct().checkpoint()
    inside = span.filter("lo < hi and home is null").select(F.col("gid").alias("gid_x"), F.col("gid").alias("gid_y"))
    ends = lambda s, o: placed.select(F.col("gid").alias(f"gid_{s}"), F.col("node").alias(o), F.col("comp").alias(f"c_{s}"), F.col("home").alias(f"home_{s}"))
    last = (pairs.union(inside).distinct().join(ends("x", "a"), "gid_x").join(ends("y", "b"), "gid_y")
            .filter((F.col("c_x") != F.col("c_y")) & ~housed).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return _merge(comps, _linked(last, lists, percent).checkpoint())


def least_overlap_column(n: Column, percent: int) -> Column:
    return F.floor((percent * n + 99) / 100)


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id (the smallest key of its component) for every row."""
    return _components(docs, key, text, size, percent).select(key, F.col("n").alias("n_shingles"), "component_id")


def jaccard_links(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                  percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The join itself: (members, links). members has key, class_id and n_links for every row: the smallest key
    with an equal set (its own key without shingles), and the number of other rows that it is linked with.
    links has class_a, class_b: the linked pairs of classes. Rows of one class are linked with each other."""
    ensure_checkpoint_dir(docs.sparkSession)
    with shuffles_released(docs.sparkSession):
        signed, nodes, sets = _set_tables(docs, key, text, size, percent)
        pairs = node_links(sets, percent).checkpoint()
    held = signed.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"))
    own = nodes.join(held, "digest").select("node", "digest", "doc", "rows").checkpoint()
    both = pairs.union(pairs.select("b", "a"))
    linked = (both.join(own.select(F.col("node").alias("b"), "rows"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("rows").alias("others")))
    counted = own.join(linked, "node", "left").select(
        "digest", "doc", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    members = signed.join(counted, "digest", "left").select(
        key, F.when(F.col("n_links").isNull(), F.col(key)).otherwise(F.col("doc")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    named = lambda c, o: own.select(F.col("node").alias(c), F.col("doc").alias(o))
    links = pairs.join(named("a", "x"), "a").join(named("b", "y"), "b").select(F.least("x", "y").alias("class_a"), F.greatest("x", "y").alias("class_b"))
    return members, links


def _components(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """key, n, digest, comp (null without shingles), component_id for every row."""
    ensure_checkpoint_dir(docs.sparkSession)
    with shuffles_released(docs.sparkSession):
        signed, nodes, comps = _node_tables(docs, key, text, size, percent)
    named = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = named.groupBy("comp").agg(F.min("doc").alias("component_id"))
    of = named.join(lowest, "comp").select("digest", "comp", "component_id")
    return signed.join(of, "digest", "left").select(
        key, "n", "digest", "comp", F.when(F.col("comp").isNull(), F.col(key)).otherwise(F.col("component_id")).alias("component_id"))


def _node_tables(docs: DataFrame, key: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The signed rows, the nodes (digest, doc, n, node) and the components of nodes, each a checkpoint."""
    signed, nodes, sets = _set_tables(docs, key, text, size, percent)
    return signed, nodes, node_components(sets, percent)


def _set_tables(docs: DataFrame, key: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The signed rows, the nodes (digest, doc, n, node), and the sets of nodes that may have a partner, each a checkpoint."""
    signed = _sets(docs, key, text, size, whole=False).checkpoint()
    nodes = (signed.filter("n > 0").groupBy("digest").agg(F.min(key).alias("doc"), F.first("n").alias("n"), F.first("d").alias("d"))
             .withColumn("node", F.monotonically_increasing_id()).checkpoint())

    chosen = nodes.join(_reach(docs, text, size, percent).checkpoint(), "d", "left_semi").select(
        "node", F.col("digest").alias("_digest"), F.col("doc").alias("_doc"))
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(chosen, F.col("_key").eqNullSafe(F.col("_doc")))
    whole = _sets(texts.select(F.struct("node", "_digest").alias("_id"), "_text"), "_id", "_text", size, whole=True)
    sets = (whole.filter("digest = _id._digest").select(F.col("_id.node").alias("node"), "n", "h")
            .dropDuplicates(["node"]).checkpoint())
    return signed, nodes, sets


def one_per_component(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that stay: of each component one row with its smallest doc_id; rows without shingles stay."""
    found = _components(docs, "doc_id", "text", size, percent)
    first = F.col("component_id").eqNullSafe(F.col("doc_id"))
    ids = found.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("rows"), F.max(first).alias("first")).checkpoint()
    of = lambda some: docs.join(some, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    once = of(ids.filter("rows = 1 and first").select("_id"))
    # Rows that share a doc_id are told apart by their sets.
    kind = docs.schema
    rows = of(ids.filter("rows > 1 and first").select("_id")).select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), "text")
    signed = _sets(rows, "_row", "text", size, whole=False)
    comps = found.filter(first & F.col("comp").isNotNull()).select("digest", "comp").distinct()
    led = signed.filter("n > 0").join(comps, "digest").dropDuplicates(["comp"]).select("_row.*")
    bare = signed.filter("n = 0").select("_row.*")
    return once.unionByName(led).unionByName(bare).select(*kind.names)
