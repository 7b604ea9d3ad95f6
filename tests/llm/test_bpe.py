"""The automaton against the tokenizers library, and round trips."""

import hashlib
import itertools
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def automaton():
    return bpe.Automaton(open(PATH, encoding="utf-8").read(), max_stored=500)


def test_random_texts(library, automaton):
    rnd = random.Random(3)
    alphabet = "abcdeéinrst  \n\t'0123.,!?-_=😀日本ß \x85\x1c\x00AI𑗠"
    for _ in range(4000):
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        s += "<|endoftext|>" * (rnd.random() < 0.1) + s[:9]
        ids = automaton.encode(s)
        assert list(ids) == library.encode(s, add_special_tokens=False).ids, repr(s)
        assert automaton.decode(ids) == library.decode(list(ids), skip_special_tokens=False) == s


@pytest.mark.parametrize("s", ["a" * 5000, "=" * 900 + " " * 500 + "\n" * 99, "ab" * 900, "aab" * 500, "  " * 50 + "x",
                               "".join(map(chr, range(1, 0x900)))])
def test_long_runs(library, automaton, s):
    assert list(automaton.encode(s)) == library.encode(s, add_special_tokens=False).ids


def spec(merges):
    chars = bpe.byte_characters()
    vocab = {c: i for i, c in enumerate(chars)}
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    return json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
                       "pre_tokenizer": level, "post_processor": None, "decoder": level,
                       "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                                 "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False,
                                 "ignore_merges": False, "vocab": vocab, "merges": [list(m) for m in merges]}})


def test_arcs_are_the_gadgets_full_table():
    """The factored entries against the table that the gadgets build when written out."""
    rnd = random.Random(5)
    for _ in range(30):
        tokens, merges = list("abc"), []
        for _ in range(9):
            m = (rnd.choice(tokens), rnd.choice(tokens))
            if m[0] + m[1] not in tokens:
                merges.append(m)
                tokens.append(m[0] + m[1])
        a = bpe.Automaton(spec(merges))
        table = {x: set("abc") for x in "abc"}
        for u, v in merges:
            if u not in table or v not in table or v not in table[u]:
                continue
            table[u + v] = set(table[v])
            table[u].discard(v)
            for arcs in table.values():
                if u in arcs:
                    arcs.add(u + v)
        assert {t.decode() for t in a.tokens if set(t) <= set(b"abc")} == set(table)
        for x, y in itertools.product(table, table):
            assert a.arc(a.tokens[x.encode()], a.tokens[y.encode()]) == (y in table[x]), (merges, x, y)
        lib = Tokenizer.from_str(spec(merges))
        for w in map("".join, itertools.product("abc", repeat=7)):
            assert list(a.encode(w)) == lib.encode(w, add_special_tokens=False).ids, (merges, w)


def test_digests(documents, library):
    got = {r.doc_id: r for r in bpe.encoded(documents, PATH).collect()}
    for r in documents.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_edges(make_docs, edge_texts, library):
    df = make_docs(edge_texts)
    got = sorted((r.doc_id, r.n_tokens, r.ids) for r in bpe.encoded(df, PATH, with_ids=True).collect())
    assert got == [(i, len(x), x) for i, t in enumerate(edge_texts) for x in [library.encode(t or "", add_special_tokens=False).ids]]
    assert bpe.encoded(df.limit(0), PATH).count() == 0


def test_unsupported_files_raise():
    with pytest.raises(ValueError):
        bpe.Automaton(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_letters_newer_than_pythons_tables(library, automaton):
    for c in automaton.rare.pattern[len(r"[\U00010000-\U0010ffff"):-1]:
        for s in (f"a{c}b", f" {c}{c} 1{c}2", f"x {c}", f"{c}'s {c}\n{c}"):
            assert list(automaton.encode(s)) == library.encode(s, add_special_tokens=False).ids, repr(s)
    assert automaton.rare.search("\u0c5c") and not automaton.rare.search("abc é 日本 1")


def test_only_lengths_of_tokens_are_tried(automaton):
    """A word is cut by lengths that tokens with its first bytes have, not by every length up to the longest token."""
    for head, sizes in automaton.sizes.items():
        assert sizes[-1] == 1 and list(sizes) == sorted(set(sizes), reverse=True)
    assert all(len(t) in automaton.sizes[t[:3]] for t in automaton.tokens if len(t) > 2)
    tried = []

    class Tokens(dict):
        def get(self, key, default=None):
            tried.append(key)
            return super().get(key, default)

    word = b" denchzugebexqzjvkw"
    want = automaton.encode_word(word)
    plain, automaton.tokens = automaton.tokens, Tokens(automaton.tokens)
    try:
        assert automaton.encode_word(word) == want
    finally:
        automaton.tokens = plain
    assert len(tried) < 6 * len(want) and b"".join(automaton.labels[i] for i in want) == word
