"""Language-model scores from a log-frequency Bloom filter.

Counting. Each task counts the words and word pairs of its training texts by 64-bit hashes,
parts of about PART_WORDS words at a time, and merges the parts up to FLUSH entries
before it sends them on. The counts meet in cells, ranges of the hash: one cell for each
CELL_BYTES of text, so a cell's share does not grow with the corpus, and a common pair
brings it one entry a flush.

Filter. A count c is quantised to the level 1 + floor(log2 c), and the n-gram is entered
once for each level up to its own, each entry as PROBES bits of the cell's bit field, which is sized so that
about half its bits are set. A level is read back by probing level 1, 2, ... until one is
missing; it may be too high (an unseen n-gram passes with a chance of 2**-PROBES), never too low.

Score. P(w | u) = MIX * min(1, c(u w) / c(u)) + (1 - MIX) * (c(w) + 1) / (N + V + 1), with
c the middle of the counts of the level that the probes return, u a mark for the
beginning in front of the first word, and an end mark as the last token.

The filter and the exact counts of the words (for the base score) are broadcast if they take
at most `broadcast_bytes`. A larger filter is never moved: a task reads its texts once, in blocks of about
BLOCK_WORDS tokens, and sends each cell the distinct hashes of a block and how often its training texts
hold them; the cell builds its bits from all of them and answers each block with counts and levels; the block is scored
from its tokens and the answers. So each cell's bits are built and probed in one place, once, however many blocks ask.
Both ways probe the same bits and give the same scores.

Defined cases: a null, empty or blank text consists of the end mark alone; a null doc_id counts as an
empty text where its decimal form is needed (so it is trained on); repeated rows count and are scored
as often as they occur; without training texts N and V are 0 and every token scores 0; an
empty table gives an empty result; only `doc_id` and `text` are read, so other columns may have any name.
Words of equal 64-bit hash count as one.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import shuffles_released
from ledgerlake.session import ensure_checkpoint_dir

# Fixed by the task.
FOLDS, HELD_OUT_FOLD = 7, 2

PROBES = 4
MIX = 0.7
PART_WORDS = 150_000
FLUSH = 600_000
BLOCK_WORDS = 2_000_000
CELL_BYTES = 8 << 20
BROADCAST_BYTES = 192 << 20
TEXT_BYTES = 8  # of training text for a byte of the filter: more text is not tried by the broadcast
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LARGE = 2**32 - 1
# Marks hold a blank, so no word equals one.
END, BEGIN = (xxhash.xxh64_intdigest(m) for m in (b" end", b" begin"))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT_FOLD


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


class Reader:
    """Texts as tokens, in order: numbers of their words by first occurrence (the end mark is number 0)."""

    def __init__(self):
        self.index: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.index[b" end"]
        self.numbers: list[int] = []
        self.sizes: list[int] = []

    def add(self, texts: list[str | None]) -> Reader:
        number = self.index.__getitem__
        for text in texts:
            # Without an argument, bytes are split at runs of the six ASCII blanks.
            words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
            self.numbers += map(number, words)
            self.numbers.append(0)
            self.sizes.append(len(words) + 1)
        return self

    def part(self) -> Part:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.index), np.uint64, len(self.index))
        words, rank = np.unique(hashes, return_inverse=True)
        return Part(words, rank[np.array(self.numbers, np.int64)], np.array(self.sizes, np.int64))


class Part:
    """Some texts as tokens: `words`, the sorted hashes of the distinct ones, their `numbers` by rank
    in order of the texts, and the tokens of each text. `pairs` are the sorted hashes of the distinct pairs and
    of the beginning mark, `pair_at` the places in it of each token's pair and, last, of the mark."""

    def __init__(self, words: np.ndarray, numbers: np.ndarray, sizes: np.ndarray):
        self.words, self.numbers, self.sizes = words, numbers, sizes
        # The token before: the beginning mark, numbered behind all others, in front of each text.
        self.before = np.empty(len(numbers), np.int64)
        self.before[1:] = numbers[:-1]
        self.before[np.cumsum(sizes) - sizes] = len(words)
        hashes = pair_hash(np.append(words, np.uint64(BEGIN))[self.before], words[numbers])
        self.pairs, self.pair_at = np.unique(np.append(hashes, np.uint64(BEGIN)), return_inverse=True)

    @classmethod
    def read(cls, texts: list[str | None]) -> Part:
        return Reader().add(texts).part()

    def times(self, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often the words, and the pairs and the beginning mark, occur in the texts that are to be counted."""
        own = np.repeat(counted, self.sizes)
        pairs = np.bincount(self.pair_at[:-1][own], minlength=len(self.pairs))
        pairs[self.pair_at[-1]] += np.count_nonzero(counted)
        return np.bincount(self.numbers[own], minlength=len(self.words)), pairs

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and count of each n-gram, and whether it is a token: pairs and the beginning mark are none."""
        hashes = np.concatenate([self.words, self.pairs])
        times = np.concatenate(self.times(np.ones(len(self.sizes), bool)))
        return hashes, times, np.arange(len(hashes)) < len(self.words)

    def scored(self, exact: np.ndarray, levels: np.ndarray, pair_levels: np.ndarray, n: int, v: int) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, base score and score of each text, given the exact count and the level in the
        filter of each word, and the level of each of the pairs."""
        base = np.log10((exact + 1) / (n + v + 1))
        pair = middle(pair_levels)[self.pair_at]
        times = np.append(middle(levels), pair[-1])
        left = times[self.before]
        seen = np.minimum(1.0, np.divide(pair[:-1], left, out=np.zeros(len(left)), where=left > 0))
        # Quantised counts may pass N, as the middle of a level may; a probability never passes 1.
        single = np.minimum(1.0, (times[:-1] + 1) / (n + v + 1))
        smooth = np.log10(MIX * seen + (1 - MIX) * single[self.numbers]) if n else np.zeros(len(seen))
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        total = lambda x: np.bincount(text, x, minlength=len(self.sizes))
        return self.sizes, total((exact > 0)[self.numbers]).astype(np.int64), total(base[self.numbers]), total(smooth)


def quantised(count: np.ndarray) -> np.ndarray:
    """The level of a positive count: 1 + floor(log2 count)."""
    return np.frexp(count.astype(np.float64))[1]


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of the counts 2**(level - 1) ... 2**level - 1; 0 for level 0."""
    return np.where(level > 0, (3.0 * 2.0 ** (level - 1.0) - 1) / 2, 0.0)


def _places(hashes: np.ndarray, level: int, probe: int, n_bits: np.ndarray | int) -> np.ndarray:
    salt = _mixed(np.array([level * 64 + probe + 1], np.uint64))
    return (_mixed(hashes ^ salt) % np.asarray(n_bits, np.uint64)).astype(np.int64)


def bit_field(hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The bytes of a filter that holds the quantised counts of some n-grams."""
    levels = quantised(times)
    size = max(8, math.ceil(int(levels.sum()) * PROBES / math.log(2) / 8))
    bits = np.zeros(8 * size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        entered = hashes[levels >= level]
        for probe in range(PROBES):
            bits[_places(entered, level, probe, len(bits))] = True
    return np.packbits(bits)


class Cells:
    """Cells of consecutive numbers from `first` on: `bits` side by side, and the exact counts of the words."""

    def __init__(self, rows: list[dict], shift: int):
        rows = sorted(rows, key=lambda r: r["cell"])
        self.shift = shift
        self.numbers = np.array([r["cell"] for r in rows], np.int64)
        sizes = np.array([len(r["bits"]) for r in rows], np.int64)
        self.begin, self.n_bits = np.cumsum(sizes) - sizes, 8 * sizes
        self.bits = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8)
        self.words = np.frombuffer(b"".join(r["words"] for r in rows), "<u8")
        # Four bytes a count, and the few that need more apart.
        parts = [np.frombuffer(r["times"], "<i8") for r in rows]
        self.times = np.concatenate([*(np.minimum(t, _LARGE).astype(np.uint32) for t in parts), np.empty(0, np.uint32)])
        self.large = np.concatenate([*(t[t >= _LARGE] for t in parts), np.empty(0, np.int64)])

    def exact(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        times = self.times[at].astype(np.int64)
        if len(self.large):
            many = times == _LARGE
            times[many] = self.large[np.searchsorted(np.flatnonzero(self.times == _LARGE), at[many])]
        return np.where(self.words[at] == hashes, times, 0)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The highest level up to which every probe finds its bit."""
        out = np.zeros(len(hashes), np.int64)
        if not len(self.numbers):
            return out
        cell = cell_of(hashes, self.shift)
        at = np.minimum(np.searchsorted(self.numbers, cell), len(self.numbers) - 1)
        open_ = np.flatnonzero(self.numbers[at] == cell)
        level = 1
        while len(open_):
            for probe in range(PROBES):
                own = at[open_]
                place = _places(hashes[open_], level, probe, self.n_bits[own])
                found = self.bits[self.begin[own] + (place >> 3)] >> (7 - (place & 7)) & 1
                open_ = open_[found == 1]
            out[open_] = level
            level += 1
        return out


def cell_of(hashes: np.ndarray, shift: int) -> np.ndarray:
    return (hashes >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(hashes), np.int64)


def _pieces(hashes: np.ndarray, shift: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The cells of sorted hashes, and the range of each."""
    cell = cell_of(hashes, shift)
    cut = np.r_[0, np.flatnonzero(np.diff(cell)) + 1, len(cell)] if len(cell) else np.zeros(1, np.int64)
    return cell[cut[:-1]], list(pairwise(cut.tolist()))


def _text_parts(batch: pa.RecordBatch, budget: int) -> Iterator[pa.RecordBatch]:
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


def _merged(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, times, token = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    return hashes[first], np.add.reduceat(times[order], first), token[order[first]]


_COUNTS = "cell long, hashes binary, times binary, token binary"
ROWS_AT_ONCE = 100_000  # n-grams that a task hands on in one batch


def ngram_counts(train: DataFrame, shift: int) -> DataFrame:
    """cell and the sorted hashes, counts and token flags of n-grams, one row for each flush and cell."""

    def rows(held: list) -> Iterator[pa.RecordBatch]:
        hashes, times, token = _merged(held)
        cells, ranges = _pieces(hashes, shift)
        step = max(1, ROWS_AT_ONCE * len(ranges) // len(hashes))
        for k in range(0, len(ranges), step):
            binary = lambda x, t: pa.array([x[i:j].astype(t).tobytes() for i, j in ranges[k:k + step]], pa.binary())  # noqa: B023, E731
            # A flush counts its own n-grams only, far fewer than 2**32.
            yield pa.RecordBatch.from_arrays([pa.array(cells[k:k + step]), binary(hashes, "<u8"), binary(times, "<u4"), binary(token, "<u1")],
                                             names=["cell", "hashes", "times", "token"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for part in _text_parts(b, 6 * PART_WORDS):
                held.append(Part.read(part.column(1).to_pylist()).counts())
                size += len(held[-1][0])
                if size > FLUSH:
                    held = [_merged(held)]
                    size = len(held[0][0])
                    if size > FLUSH // 2:
                        yield from rows(held)
                        held, size = [], 0
        if held:
            yield from rows(held)

    return train.select("doc_id", "text").mapInArrow(run, _COUNTS)


def filter_cells(counts: DataFrame, shift: int) -> DataFrame:
    """cell, bits, words, times, and the sums n (tokens) and v (distinct ones) of the cell."""

    def build(table: pa.Table) -> pa.Table:
        hashes, times, token = _merged([tuple(
            np.frombuffer(b"".join(table.column(c).to_pylist()), t).astype(as_) for c, t, as_ in
            (("hashes", "<u8", np.uint64), ("times", "<u4", np.int64), ("token", "<u1", bool)))])
        one = lambda x: pa.array([x.tobytes()], pa.binary())
        return pa.table({"cell": table.column("cell").slice(0, 1), "bits": one(bit_field(hashes, times)),
                         "words": one(hashes[token]), "times": one(times[token]),
                         "n": pa.array([int(times[token].sum())]), "v": pa.array([int(token.sum())])})

    # As many tasks as cells, so a task's share does not grow with the corpus.
    dealt = counts.repartition(1 << (64 - shift), "cell")
    return dealt.groupBy("cell").applyInArrow(build, "cell long, bits binary, words binary, times binary, n long, v long")


_SCORES = ["n_tokens", "n_known", "base_score", "score"]


def _scores_from_broadcast(docs: DataFrame, cells: DataFrame, shift: int, n: int, v: int) -> DataFrame:
    rows = [r.asDict() for r in cells.select("cell", "bits", "words", "times").toLocalIterator()]
    # Plain values: a worker may not have this module.
    shared = docs.sparkSession.sparkContext.broadcast(vars(Cells(rows, shift)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Cells.__new__(Cells)
        vars(held).update(shared.value)
        for b in batches:
            for rows in _text_parts(b, 6 * PART_WORDS):
                part = Part.read(rows.column(1).to_pylist())
                scores = part.scored(held.exact(part.words), held.levels(part.words), held.levels(part.pairs), n, v)
                yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, scores)], names=["doc_id", *_SCORES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of each and compressed: small or like ones take little."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(x: bytes) -> np.ndarray:
    n = int.from_bytes(x[:8], "little")
    planes = np.frombuffer(pa.decompress(x[8:], 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def _packed_hashes(x: np.ndarray) -> bytes:
    """Sorted hashes, by their differences."""
    return _packed(np.diff(x, prepend=np.uint64(0)))


def _unpacked_hashes(x: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(x), dtype=np.uint64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, Part, np.ndarray, list]]:
    """Whether a block is to be scored, its texts, which of them count, and their ids."""
    held: dict[bool, tuple[Reader, list, list]] = {}
    for b in batches:
        for rows in _text_parts(b, 6 * PART_WORDS):
            ids, texts, counted, asked = (c.to_pylist() for c in rows.columns)
            for kind in {*asked}:
                own = [i for i, a in enumerate(asked) if a == kind]
                reader, counts, names = held.setdefault(kind, (Reader(), [], []))
                reader.add([texts[i] for i in own])
                counts += [counted[i] for i in own]
                names += [ids[i] for i in own]
                if len(reader.numbers) >= BLOCK_WORDS:
                    yield kind, reader.part(), np.array(counts, bool), names
                    del held[kind]
    for kind, (reader, counts, names) in held.items():
        yield kind, reader.part(), np.array(counts, bool), names


def _scores_from_cells(rows: DataFrame, shift: int) -> DataFrame:
    """n, v and the scores of the rows (doc_id, text, counted, asked) that are asked for, by a model of those that are counted."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    id_type = pa.list_(pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string())
    # The tokens of block b travel as cell -1 - b. Blocks that are only counted have number -1.
    texts = f"numbers binary, sizes binary, ids array<{kind}>"
    sent = pa.schema([("block", pa.int64()), ("cell", pa.int64()), *((c, pa.binary()) for c in ("words", "times", "pairs", "pair_times", "numbers", "sizes")),
                      ("ids", id_type)])
    answered = pa.schema([*((c, pa.int64()) for c in ("block", "cell", "n", "v")), *((c, pa.binary()) for c in ("words", "times", "levels", "pair_levels", "numbers", "sizes")),
                      ("ids", id_type)])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each block a row of its tokens, and one row for each cell."""
        name = TaskContext.get().partitionId() << 32
        for asked, part, counted, ids in _blocks(batches):
            times, pair_times = part.times(counted)
            words, pairs = dict(zip(*_pieces(part.words, shift))), dict(zip(*_pieces(part.pairs, shift)))
            out = []
            for cell in sorted({*words, *pairs}):
                (i, j), (k, m) = words.get(cell, (0, 0)), pairs.get(cell, (0, 0))
                out.append({"block": name if asked else -1, "cell": int(cell), "words": _packed_hashes(part.words[i:j]), "times": _packed(times[i:j]),
                            "pairs": _packed_hashes(part.pairs[k:m]), "pair_times": _packed(pair_times[k:m])})
            if asked:
                out.append({"block": name, "cell": -1 - name, "numbers": _packed(part.numbers), "sizes": _packed(part.sizes), "ids": ids})
                name += 1
            yield pa.RecordBatch.from_pylist(out, schema=sent)

    def answer(table: pa.Table) -> pa.Table:
        """A row of tokens as it is; else the sums of the cell and its answers to the blocks."""
        if table.column("cell")[0].as_py() < 0:
            return pa.Table.from_pylist(table.select(["block", "cell", "numbers", "sizes", "ids"]).to_pylist(), schema=answered)
        own = table.select(["block", "cell", "words", "times", "pairs", "pair_times"]).to_pylist()
        hashes = [_unpacked_hashes(r[c]) for c in ("words", "pairs") for r in own]
        times = np.concatenate([_unpacked(r[c]) for c in ("times", "pair_times") for r in own]).astype(np.int64)
        token = np.arange(len(times)) < sum(map(len, hashes[:len(own)]))
        ends = np.cumsum([0, *map(len, hashes)])
        hashes, first, at = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        times, token = np.bincount(at, times, len(hashes)).astype(np.int64), token[first]
        known = times > 0
        cell = {"cell": own[0]["cell"], "bits": bit_field(hashes[known], times[known]).tobytes(), "words": b"", "times": b""}
        levels = Cells([cell], shift).levels(hashes)
        known &= token
        out = [{"block": -1, "cell": cell["cell"], "n": int(times[known].sum()), "v": int(known.sum())}]
        for i, r in enumerate(own):
            if r["block"] >= 0:
                words, pairs = (at[ends[k]:ends[k + 1]] for k in (i, len(own) + i))
                out.append({"block": r["block"], "cell": r["cell"], "words": r["words"], "times": _packed(times[words]),
                            "levels": _packed(levels[words]), "pair_levels": _packed(levels[pairs])})
        return pa.Table.from_pylist(out, schema=answered)

    def score(table: pa.Table) -> pa.Table:
        # The row of tokens comes first, then the cells in order of their hashes.
        own, *cells = table.sort_by("cell").to_pylist()
        joined = lambda c, read: np.concatenate([read(r[c]) for r in cells])
        part = Part(joined("words", _unpacked_hashes), _unpacked(own["numbers"]).astype(np.int64), _unpacked(own["sizes"]).astype(np.int64))
        columns = part.scored(*(joined(c, _unpacked).astype(np.int64) for c in ("times", "levels", "pair_levels")), n, v)
        return pa.table([pa.array(own["ids"], id_type.value_type), *map(pa.array, columns)], names=["doc_id", *_SCORES])

    with shuffles_released(rows.sparkSession):
        # As many tasks as cells, so a task's share does not grow with the corpus.
        answers = (rows.mapInArrow(ask, f"block long, cell long, words binary, times binary, pairs binary, pair_times binary, {texts}")
                 .repartition(1 << (64 - shift), "cell").groupBy("cell")
                 .applyInArrow(answer, f"block long, cell long, n long, v long, words binary, times binary, levels binary, pair_levels binary, {texts}")
                 .checkpoint())
    sums = answers.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.count_if(F.col("cell") < 0).alias("blocks")).first()
    n, v = sums.n or 0, sums.v or 0
    return _with_total(answers.filter("block >= 0").repartition(max(1, sums.blocks), "block").groupBy("block").applyInArrow(
        score, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double"), n)


def _with_total(scores: DataFrame, n: int) -> DataFrame:
    return scores.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def scored(docs: DataFrame, train: DataFrame | Column, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row of `docs`, by a model of the texts of
    `train`, a frame or a condition on the rows of `docs` (whose texts are then read once where the filter is not broadcast)."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    frame = docs.filter(train) if isinstance(train, Column) else train
    size = frame.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    # The cells are the ranges of the leading bits of a hash.
    shift = 64 - max(0, math.ceil(math.log2(max(1, size / CELL_BYTES))))
    if size <= TEXT_BYTES * broadcast_bytes:
        with shuffles_released(spark):
            cells = filter_cells(ngram_counts(frame, shift), shift).checkpoint()
        sums = cells.agg(F.sum("n").alias("n"), F.sum("v").alias("v"),
                         F.sum(F.length("bits") + F.length("words") + F.length("times") / 2).alias("bytes")).first()
        if (sums.bytes or 0) <= broadcast_bytes:
            return _with_total(_scores_from_broadcast(docs, cells, shift, sums.n or 0, sums.v or 0), sums.n or 0)
    if isinstance(train, Column):
        rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("counted"), F.lit(True).alias("asked"))
    else:
        rows = (docs.select("doc_id", "text", F.lit(False).alias("counted"), F.lit(True).alias("asked"))
                .union(train.select(F.lit(None).cast(docs.schema["doc_id"].dataType), "text", F.lit(True), F.lit(False))))
    return _scores_from_cells(rows, shift)


def corpus_scores(docs: DataFrame) -> DataFrame:
    """The contract's query: all documents, by a model of those outside the held-out fold."""
    out = held_out(F.col("doc_id"))
    return (scored(docs, ~out)
            .select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"))
