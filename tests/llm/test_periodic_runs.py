import hashlib
import random
import re
import zlib

import pytest
from ledgerlake.llm import periodic_runs as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """All lags one by one; a stretch of agreement and its least lag."""
    least = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                least.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in least.items()), key=lambda r: (r[0], r[2]))


def brute_kept(words, runs):
    gone = {j for s, n, q in runs for j in range(s + q, s + n)}
    return [w for j, w in enumerate(words) if j not in gone]


def made(rnd, alphabet):
    words = []
    for _ in range(rnd.randint(0, 6)):
        if rnd.random() < 0.4:
            words += [str(rnd.randrange(alphabet)) for _ in range(rnd.randint(0, 60))]
            continue
        base = [str(rnd.randrange(alphabet)) for _ in range(rnd.choice([1, 2, 3, 5, 8, 13, 16, 17, 18, 24, 25, 30, 36, 37, 54, 55, 81]))]
        if rnd.random() < 0.3:
            base = base * rnd.randint(2, 4) + base[:rnd.randint(0, len(base))]
        turn = base * rnd.randint(2, 6)
        turn = turn[:len(turn) - rnd.randint(0, len(base))]
        if turn and rnd.random() < 0.2:
            turn[rnd.randrange(len(turn))] = "x"
        words += turn
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_all_lags(seed):
    rnd, found = random.Random(seed), 0
    for _ in range(40):
        texts = [made(rnd, rnd.choice([1, 2, 3, 5, 50, 1000])) for _ in range(rnd.randint(1, 4))]
        part = pr.RunsOfPart(list(range(len(texts))), [" ".join(w) for w in texts], planted=False)
        for i, words in enumerate(texts):
            want = brute_runs(words)
            assert [tuple(r) for r in part.of(i).tolist()] == want
            assert part.kept(i) == brute_kept(words, want)
            found += len(want)
    assert found > 100


def test_words_of_fibonacci_and_of_one_letter():
    a, b = ["a"], ["b"]
    while len(b) < 500:
        a, b = b, b + a
    for words in (b[:500], ["a"] * 500, ["a", "b"] * 200 + ["a"]):
        part = pr.RunsOfPart([0], [" ".join(words)], planted=False)
        assert [tuple(r) for r in part.of(0).tolist()] == brute_runs(words)


def test_long_periods():
    rnd = random.Random(9)
    base = [str(rnd.randrange(10_000)) for _ in range(2501)]
    words = ["p"] + base * 3 + base[:77] + ["q"] + base * 2
    part = pr.RunsOfPart([0], [" ".join(words)], planted=False)
    assert part.of(0).tolist() == [[1, 3 * 2501 + 77, 2501]]


def digest(rows):
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        out.append((doc_id, len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(" ".join(brute_kept(words, runs)).encode()).hexdigest()))
    return sorted(out, key=str)


def test_digest_equals_brute_force(spark, documents):
    docs = documents.select("doc_id", "text").filter("length(text) < 8000")  # all lags of longer texts take brute force too long
    got = pr.run_digest(docs).collect()
    assert sorted(map(tuple, got), key=str) == digest([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r.n_runs > 0 for r in got) > 5


def test_edge_texts_repeated_rows_null_ids_and_clashing_columns(spark, make_docs, edge_texts):
    docs = make_docs([*enumerate(edge_texts), (3, "a"), (3, "a b " * 40), (3, "a b " * 40), (None, "x y z " * 30), (77, "k " * 24)])
    docs = docs.withColumnRenamed("lang", "start").withColumnRenamed("source", "n_runs")
    rows = [(r.doc_id, r.text if r.text is None or len(r.text) < 20_000 else "word " * 5_000) for r in docs.select("doc_id", "text").collect()]
    long = [r for r in rows if r[1] and len(r[1]) > 20_000]
    got = {str(tuple(r)) for r in pr.run_digest(docs).collect()}
    assert {str(r) for r in digest([r for r in rows if r not in long])} <= got
    assert pr.run_digest(docs).count() == len(rows) and len(long) == 1
    word = [r for r in pr.run_digest(docs).collect() if r.doc_id == long[0][0]][0]
    assert (word.n_runs, word.start, word.length, word.period, word.exponent_milli) == (1, 0, 5000, 1, 5_000_000)


def test_empty_table(spark, make_docs):
    empty = make_docs([(1, "a")]).filter("false")
    assert pr.run_digest(empty).collect() == [] and pr.periodic_runs(empty).collect() == []


def test_runs_and_collapsed_text(spark, make_docs):
    rows = {r.doc_id: r for r in pr.periodic_runs(make_docs([(1, "x  " + "a b c\n" * 10 + " y"), (2, "no run"), (3, None)])).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(1, 30, 3)] and rows[1].collapsed_text == "x a b c y"
    assert (rows[2].runs, rows[2].collapsed_text) == ([], "no run") and (rows[3].runs, rows[3].collapsed_text) == ([], "")


def test_small_parts_change_nothing(spark, documents, monkeypatch):
    whole = sorted(map(tuple, pr.run_digest(documents).collect()), key=str)
    monkeypatch.setattr(pr, "PART_WORDS", 100)
    assert sorted(map(tuple, pr.run_digest(documents).collect()), key=str) == whole
