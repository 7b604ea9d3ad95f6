"""Components of the similarity join against all pairs, in plain Python."""

import random
import re

from ledgerlake.llm import jaccard_join as jj


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = list(range(len(rows)))

    def find(k):
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            common = len(x & y)
            if common and 100 * common >= 80 * (len(x) + len(y) - common):
                up[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        r = find(k)
        low[r] = min(low.get(r, i), i)
    return sorted((i, len(s), low[find(k)]) for k, (i, s) in enumerate(sets))


def check(df):
    got = sorted(tuple(r) for r in jj.jaccard_components(df).collect())
    assert got == brute([(r.doc_id, r.text) for r in df.collect()])
    return got


def near_copies(seed, groups=12, size=9):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(40)]
    out = []
    for _ in range(groups):
        base = [word() for _ in range(rnd.randint(20, 200))] + passage * rnd.randint(0, 1)
        for _ in range(size):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, len(t) // 40))):
                t[rnd.randrange(len(t))] = word()
            out.append(" ".join(t[rnd.randint(0, 2):]))
            base = t if rnd.random() < 0.4 else base  # chains of links
    rnd.shuffle(out)
    return out


def test_tables(documents):
    check(documents)


def test_near_copies(make_docs):
    got = check(make_docs(near_copies(1)))
    assert len({c for _, _, c in got}) < len(got) / 2


def test_edges(make_docs, edge_texts):
    same = "One two  three\nfour FIVE six"
    check(make_docs(edge_texts + ["a b c", "A  b c", "a b", same, same.lower(), same.replace("  ", " ")]))


def test_threshold_is_exact(make_docs):
    # 20 shingles of which the last k differ: similar down to 16 of 18 + 2.
    base = [f"w{i}" for i in range(24)]
    texts = [" ".join(base[:24 - k] + [f"v{k}{i}" for i in range(j)]) for k in range(6) for j in range(6)]
    check(make_docs(texts))


def test_repeated_rows_and_empty(make_docs):
    df = make_docs([(5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f"), (5, "other text of one row here")])
    got = sorted(tuple(r) for r in jj.jaccard_components(df).collect())
    assert got == [(3, 2, 3), (5, 2, 3), (5, 2, 3), (5, 2, 5)]
    assert jj.jaccard_components(df.limit(0)).count() == 0


def test_one_per_component(make_docs):
    df = make_docs(["a b c d e f", "x", "a b c d e f", None, "", "x y"])
    assert sorted(r.doc_id for r in jj.one_per_component(df).collect()) == [0, 1, 3, 4, 5]
    assert jj.one_per_component(df).columns == df.columns
    df = make_docs([(5, "a b c d e f"), (5, "A b c d e f"), (7, "a b c d e f"), (5, "other text of one row here"), (5, ""), (5, ""),
                    (2, "x y"), (9, "x y")])
    got = sorted((r.doc_id, r.text.lower()) for r in jj.one_per_component(df).collect())
    assert got == [(2, "x y"), (5, ""), (5, ""), (5, "a b c d e f"), (5, "other text of one row here")]


def test_hashes_tell_shingles_apart():
    s = jj.Shingler()
    texts = [" ".join(f"{a}{b}" for b in "abcdefghij") for a in "klmnopqrstuvwxyz0123456789"]
    assert [len(s(t)) for t in texts] == [len(shingles(t)) for t in texts]
    assert len({tuple(s(t)) for t in texts}) == len(texts)
    assert list(s("A b\tc  d e")) == list(s(" a B c d E\n")) != list(s("ab c d e"))


def brute_links(rows):
    """(key, smallest key of an equal set, number of other rows linked) for each row, and the linked pairs of classes."""
    sets = [(i, frozenset(shingles(t))) for i, t in rows]
    low = {}
    for i, s in sets:
        low[s] = min(low.get(s, i), i)
    linked = lambda x, y: bool(x & y) and 100 * len(x & y) >= 80 * len(x | y)
    members = sorted((i, low[s] if s else i, sum(linked(s, t) for _, t in sets) - bool(s)) for i, s in sets)
    classes = sorted(low, key=lambda s: low[s])
    pairs = sorted((low[a], low[b]) for k, a in enumerate(classes) for b in classes[k + 1:] if linked(a, b))
    return members, pairs


def check_links(df):
    members, links = jj.jaccard_links(df)
    want = brute_links([(r.doc_id, r.text) for r in df.collect()])
    assert sorted(map(tuple, members.collect())) == want[0]
    assert sorted(map(tuple, links.collect())) == want[1]
    return want


def test_links_of_the_tables(documents):
    assert check_links(documents)[1]


def test_links_of_near_copies_and_edges(make_docs, edge_texts):
    rows = list(enumerate([*near_copies(2, groups=8), *edge_texts, "a b c", "A  b c", "a b"]))
    rows += rows[:5] + [(900, rows[0][1])]
    members, links = check_links(make_docs(rows))
    assert len(links) > 20 and max(n for *_, n in members) > 5


def test_no_links(make_docs):
    members, links = jj.jaccard_links(make_docs(["a b c d e f"]).limit(0))
    assert members.collect() == [] and links.collect() == []
    members, links = jj.jaccard_links(make_docs([None, "one two", "three four"]))
    assert sorted(map(tuple, members.collect())) == [(0, 0, 0), (1, 1, 0), (2, 2, 0)] and links.collect() == []


def variants(seed, size, changes, forks=0):
    """A base text and `size` copies of it, each with some words changed; `forks` further bases are changed copies themselves."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(4))

    def changed(t, k):
        t = list(t)
        for i in rnd.sample(range(len(t)), k):
            t[i] = word()
        return t

    bases = [[word() for _ in range(150)]]
    bases += [changed(bases[0], rnd.choice((3, 4, 5))) for _ in range(forks)]
    out = bases + [changed(rnd.choice(bases), rnd.choice(changes)) for _ in range(size)]
    out = [t[rnd.randint(0, 3):] if forks else t for t in out]
    rnd.shuffle(out)
    return [" ".join(t) for t in out]


def test_homes_lose_no_link(make_docs, monkeypatch):
    # With one hub a list, most links are left to the homes and to the last step.
    monkeypatch.setattr(jj, "HUBS", 1)
    monkeypatch.setattr(jj, "STAR_ENTRIES", 2)
    seen = []
    home_links = jj._home_links
    monkeypatch.setattr(jj, "_home_links", lambda *a: seen.append(home_links(*a)) or seen[-1])
    for seed in range(2):
        got = check(make_docs(variants(seed, 120, (0, 1, 2, 3, 4), forks=12)))
        assert 5 < len({c for _, _, c in got}) < len(got) - 20
    assert sum(links.count() for links in seen) > 5


def test_near_copies_meet_few_others(make_docs, monkeypatch):
    # Copies with three words changed lie at the threshold: like the base, hardly any like each other.
    from pyspark.sql.classic.dataframe import DataFrame

    made, join = [], DataFrame.join

    def counted(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if isinstance(on, str) and on == "a":
            made.append(out.count())
        return out

    monkeypatch.setattr(DataFrame, "join", counted)
    rows = []
    for size in (100, 200):
        made.clear()
        docs = make_docs(variants(5, size, (3, 3, 3, 4)))
        check(docs)
        rows.append(sum(made))
    assert rows[1] < 50 * 200, rows
