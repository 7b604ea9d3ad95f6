"""Quality rules: fixed base counts, then a hashed n-gram log-likelihood ratio.

The target multinomial is estimated from trusted documents (rows of `labels`
with quality 1), the raw multinomial from all documents, both over the words
and word pairs of the lower-cased text hashed into BUCKETS buckets, with
add-one smoothing. An n-gram's ratio is log p_target - log p_raw, less the shift
that a fair draw of documents would show: were the trusted ones drawn at random within
each language (`lang`), as many n-grams of each as they hold, a bucket's count would be
about Poisson, and its expected log is taken off. So neither a language's share
among the trusted documents nor their number moves the ratio of clean text, and n-grams of a
language without trusted documents count 0 unless trusted ones of another hold them.
A document's ratio is the mean over its n-grams. It is kept if it passes the base rules and its ratio
is at least THRESHOLD; nothing is drawn at random, so every document gets the
same verdict on every run.

All of it is DataFrame and SQL functions. Bucket counts are summed before the
shuffle, so what is shuffled is bounded by tasks x languages x BUCKETS. The weights (one
number per bucket, a bounded vector) come back as one constant array.

Defined cases: a null or blank text has no words and no n-grams, its ratio is
0 and the base rules fail it; without any trusted document the ratio of every
text is 0; repeated rows give repeated results and count as often as they
occur; an empty table gives an empty result; null languages are one language,
as are all rows where there is no `lang`; columns beside `doc_id`, `text` and `lang` are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD_BREAK, bind, words
from ledgerlake.session import ensure_checkpoint_dir

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
BUCKETS = 10_000
BITMAP_BITS = 23
# Set on trusted documents left out of the counts; tests/llm hold what it keeps of them.
THRESHOLD = -0.06


def repeated_words(ws: Column) -> Column:
    """Words that lie in a window of WINDOW words which occurs twice or more.

    Windows are 96-bit hashes with their start. If all are distinct, nothing
    repeats. Otherwise sorting brings equal windows together, and the starts
    of those with an equal neighbour, in order, give the covered length.
    """
    hashes = F.transform(ws, lambda w: F.xxhash64(w))

    def window(h: Column, i: Column) -> list[Column]:
        return [F.get(h, i + k) for k in range(WINDOW)]

    def cover(h: Column, win: Column) -> Column:
        placed = F.array_sort(F.transform(win, lambda a, i: F.struct(a.alias("a"), F.hash(*window(h, i)).alias("b"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"])
            hit = F.transform(s, lambda x, i: F.when(
                F.coalesce(same(x, F.get(s, i - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, i + 1)), F.lit(False)),
                x["i"]))
            return F.array_sort(F.filter(hit, lambda x: x.isNotNull()))

        def length(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return bind(bind(placed, starts), length)

    def of(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*window(h, i)))
        # Distinct over longs hashes them; over structs it would compare all pairs.
        return bind(each, lambda win: F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(cover(h, win)))

    many = bind(hashes, of)
    return F.when(F.size(ws) > WINDOW, many).otherwise(F.lit(0))


def base_rules(docs: DataFrame) -> DataFrame:
    """Adds _words (array), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{WORD_BREAK}]"))
    counted = docs.withColumn("_words", words(F.col("text"))).select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0), lambda a, w: a + F.length(w)).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[" + SYMBOLS + "]")).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def ngram_buckets(ws: Column, buckets: int) -> Column:
    """Bucket of every lower-cased word and of every pair of neighbours."""
    def of(h: Column) -> Column:
        one = F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))
        two = F.transform(h, lambda x, i: F.pmod(F.xxhash64(F.get(h, i - 1), x), F.lit(buckets)).cast("int"))
        return F.concat(one, F.slice(two, F.lit(2), F.greatest(F.size(h) - 1, F.lit(0))))

    return bind(F.transform(ws, lambda w: F.xxhash64(F.lower(w))), of)


def _maybe_in(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id may be in `ids`: a bitmap of 2^BITMAP_BITS
    hashed ids (1 MB, whatever their number) goes to all tasks, and rows whose bit is not set
    need not be shuffled to the join that decides."""
    place = lambda: F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS)) + 1
    bits = (ids.select(F.bitmap_bucket_number(place()).alias("_bucket"), F.bitmap_bit_position(place()).alias("_at"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits")))
    at = F.bitmap_bit_position(place())
    byte = F.conv(F.hex(F.substr(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    return docs.join(F.broadcast(bits), F.bitmap_bucket_number(place()) == F.col("_bucket")).filter(is_set).select(docs.columns)


def _expected_log(mean: float) -> float:
    """The expectation of log(n + 1) for a Poisson count n."""
    if mean > 30:
        m = mean + 1
        return math.log(m) - mean / (2 * m ** 2) + mean / (3 * m ** 3) - (3 * mean ** 2 + mean) / (4 * m ** 4)
    total, p = 0.0, math.exp(-mean)
    for n in range(1, int(mean + 12 * math.sqrt(mean)) + 20):
        p *= mean / n
        total += p * math.log(n + 1)
    return total


def bucket_counts(docs: DataFrame, labels: DataFrame, buckets: int) -> tuple[dict[int, int], dict[int, int], dict[int, float]]:
    """Per bucket the n-grams of all documents, those of the trusted ones, and as many
    as the latter would hold were they drawn from all documents of their languages."""
    ensure_checkpoint_dir(docs.sparkSession)
    trusted = labels.filter("quality = 1").select("doc_id").distinct()
    texts = docs.select("doc_id", "text", F.xxhash64("lang" if "lang" in docs.columns else F.lit("")).alias("mix"))
    bucket = F.explode(ngram_buckets(words(F.col("text")), buckets)).alias("b")
    # A row per language and bucket: small, and read several times below.
    count = lambda of: of.select("mix", bucket).groupBy("mix", "b").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    raw = count(texts)
    # Trusted ids grow with the documents, so the join is a sort-merge join at every size.
    target = count(_maybe_in(texts, trusted).join(trusted.hint("merge"), "doc_id"))
    by = lambda of, key, out: of.groupBy(key).agg(F.sum("n").alias(out))
    share = by(raw, "mix", "_raw").join(by(target, "mix", "_target"), "mix").select("mix", (F.col("_target") / F.col("_raw")).alias("share"))
    # Summed in the order of the languages, so that the last digit is the same on every run.
    fair = (raw.join(F.broadcast(share), "mix").groupBy("b")
            .agg(F.array_sort(F.collect_list(F.struct("mix", (F.col("n") * F.col("share")).alias("x")))).alias("xs"))
            .select("b", F.aggregate("xs", F.lit(0.0), lambda a, x: a + x["x"]).alias("n")))
    return tuple({r.b: r.n for r in of.collect()} for of in (by(raw, "b", "n"), by(target, "b", "n"), fair))


def bucket_log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, less_shift: bool = False) -> list[float]:
    """log p_target - log p_raw per bucket, on request less the shift of a fair draw:
    a vector of `buckets` numbers, whatever the input's size."""
    raw, target, fair = bucket_counts(docs, labels, buckets)
    raw_all, target_all = sum(raw.values()), sum(target.values())
    if not target_all:
        return [0.0] * buckets
    log_raw = lambda b: math.log((raw.get(b, 0) + 1) / (raw_all + buckets))
    shift = lambda b: _expected_log(fair.get(b, 0.0)) - math.log(target_all + buckets) - log_raw(b)
    return [round(math.log((target.get(b, 0) + 1) / (target_all + buckets)) - log_raw(b) - (shift(b) if less_shift else 0), 9)
            for b in range(buckets)]


def mean_log_ratio(ws: Column, weights: list[float]) -> Column:
    """The length-normalised ratio; the weights are folded into one constant array."""
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = lambda g: F.aggregate(g, F.lit(0.0), lambda a, b: a + F.get(w, b))
    mean = bind(ngram_buckets(ws, len(weights)), lambda g: F.round(total(g) / F.size(g), 6))
    return F.when(F.size(ws) > 0, mean).otherwise(F.lit(0.0))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                  buckets: int = BUCKETS) -> DataFrame:
    """The contract's columns and log_ratio for a `documents` table."""
    weights = bucket_log_ratios(docs, labels, buckets, less_shift=True)
    ruled = base_rules(docs.select("doc_id", "text"))
    return (ruled.withColumn("log_ratio", mean_log_ratio(F.col("_words"), weights))
            .withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))
            .drop("text", "_words"))
