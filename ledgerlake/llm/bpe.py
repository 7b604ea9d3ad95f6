"""Byte-level BPE by a tokenization automaton.

The automaton reads tokens: its states are the start and one state for each
token read last, its arcs are labelled by tokens, and its paths spell exactly the
tokenizations that the merges produce, one for each word. It is built
merge by merge. It starts with the byte tokens, all arcs allowed. The gadget of
merge (u, v) -> w, number i, does this:

* if state u has no arc v by now, w is never formed and gets no arcs;
* state w is a copy of state v as it is;
* the arc v leaves state u (u then v would have been merged);
* each state with an arc u gets an arc w beside it.

Every gadget thus copies one row and one column of the arc table and clears one
entry. The full table would have tokens^2 entries, so it is kept as these
steps: an entry that the merges before number t leave is found by following the
copy that made it (`_allowed`), and found entries are stored in a table of
bounded size, from which words are encoded.

A word is encoded by following arcs, the longest label first. A position from
which no arc leads on is left for good, as each prefix of a word has only one path.
Decoding emits the labels of the arcs.

Only byte-level vocabularies without normaliser, prefix space and ignored
merges are taken; anything else raises an error. Special tokens are cut out of the text first.

Defined cases: a null text counts as empty: no tokens, the digests of no
bytes; words of any length are encoded whole; repeated rows give repeated
results; an empty table gives an empty result; columns beside `doc_id` and `text`
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerlake.llm.common import small_batches

MAX_STORED = 400_000  # words that a worker keeps, and half of the table entries
_PLANE = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
# Fixed: white space as the pre-splitting pattern's \s has it, and that pattern.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
_SPLIT = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{{L}}]+| ?[{{N}}]+| ?[^{_SPACE}{{L}}{{N}}]+"
          f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable
    ones of Latin-1 for themselves, the others shifted to 256 and on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _class_body(prop: str) -> str:
    """The characters of the basic plane with a property, as the ranges of a character class of `re`."""
    runs: list[list[int]] = []
    for c in map(ord, regex.findall(prop, _PLANE)):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


class Automaton:
    def __init__(self, spec: str, max_stored: int = MAX_STORED):
        j = json.loads(spec)
        m, pre = j["model"], j["pre_tokenizer"]
        if (m["type"] != "BPE" or j["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]
                or not pre.get("use_regex", True) or m["ignore_merges"] or m["dropout"] or j["post_processor"]
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in j["added_tokens"])):
            raise ValueError("only plain byte-level BPE files are supported")
        chars = byte_characters()
        to_bytes = lambda s: bytes(chars[c] for c in s)
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # Classes of the basic plane spelled out: `re` looks them up in a table.
        self.split = re.compile(_SPLIT.format(L=_class_body(r"\p{L}"), N=_class_body(r"\p{N}")))
        # Letters and numbers beyond the basic plane, and those that are newer than Python's
        # tables, differ between Unicode versions.
        newer = "".join(c for c in regex.findall(r"[\p{L}\p{N}]", _PLANE) if unicodedata.category(c) == "Cn")
        self.rare = re.compile(rf"[\U00010000-\U0010ffff{newer}]")
        self.labels: list[bytes] = [b""] * (1 + max(chain(m["vocab"].values(), self.special.values())))
        for s, i in m["vocab"].items():
            self.labels[i] = to_bytes(s)
        for s, i in self.special.items():
            self.labels[i] = s.encode()
        self.max_stored = max_stored
        self.words: dict[str, bytes] = {}
        self.table: dict[int, bool] = {}
        self._compile(m["vocab"], [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in m["merges"]])

    def _compile(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        n = len(self.labels)
        self.made_at = [-1] * n  # number of the merge that makes a token
        self.row, self.column = [0] * n, [0] * n  # tokens whose row, column a token's was copied from
        self.cleared: dict[int, int] = {}  # entry -> number of the merge that cleared it
        self.tokens = {self.labels[i]: i for s, i in vocab.items() if len(s) == 1}
        self.width = n
        for i, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if self.labels[u] not in self.tokens or self.labels[v] not in self.tokens or not self._allowed(u, v, i):
                continue
            if self.labels[w] not in self.tokens:
                self.made_at[w], self.row[w], self.column[w] = i, v, u
                self.tokens[self.labels[w]] = w
            self.cleared[u * n + v] = i
        # Lengths that tokens with some first three bytes have, the longest first, down to one byte.
        sizes: dict[bytes, set[int]] = {}
        for t in self.tokens:
            if len(t) > 2:
                sizes.setdefault(t[:3], {1, 2} if t[:2] in self.tokens else {1}).add(len(t))
        self.sizes = {head: tuple(sorted(own, reverse=True)) for head, own in sizes.items()}

    def _allowed(self, x: int, y: int, before: int) -> bool:
        """Whether state x has an arc y after the merges numbered below `before`."""
        made, cleared, n = self.made_at, self.cleared, self.width
        while True:
            i = cleared.get(x * n + y)
            if i is not None and i < before:
                return False
            a, b = made[x], made[y]
            if b < 0 and a < 0:
                return True
            if b >= a:  # column y was copied in gadget b, after its row and its entry
                y, before = self.column[y], b + 1
            else:  # row x was copied first in gadget a
                x, before = self.row[x], a

    def arc(self, x: int, y: int) -> bool:
        key = x * self.width + y
        found = self.table.get(key)
        if found is None:
            if len(self.table) > 2 * self.max_stored:
                self.table.clear()
            found = self.table[key] = self._allowed(x, y, 1 << 62)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        whole = self.tokens.get(word)
        if whole is not None:  # a token spells itself
            return [whole]
        n, get, arc, sizes = len(word), self.tokens.get, self.arc, self.sizes.get
        known, width, labels = self.table.get, self.width, self.labels
        path: list[int] = []
        cuts: list[int] = []  # where the tokens of the path begin
        dead = set()
        at, room, row = 0, n, -1
        while at < n:
            for size in sizes(word[at:at + 3], (2, 1)):
                if size > room or (t := get(word[at:at + size])) is None or at + size in dead:
                    continue
                # A stored arc is looked up here: most are.
                if row < 0 or ((found := known(row + t)) or found is None and arc(path[-1], t)):
                    path.append(t)
                    cuts.append(at)
                    at, row = at + size, t * width
                    room = n - at
                    break
            else:  # no arc leads on from here
                dead.add(at)
                room, at = len(labels[path.pop()]) - 1, cuts.pop()
                row = path[-1] * width if path else -1
        return path

    def _ids(self, text: str) -> bytes:
        """Ids of text without special tokens, as little-endian 32-bit integers."""
        words = self.split.findall(text) if not self.rare.search(text) else _library_split(text)
        store = self.words
        if len(store) > self.max_stored:
            store.clear()
        for w in set(words):
            if w not in store:
                path = self.encode_word(w.encode())
                store[w] = struct.pack(f"<{len(path)}I", *path)
        return b"".join(map(store.__getitem__, words))

    def encode(self, text: str | None) -> np.ndarray:
        text, out, at = text or "", [], 0
        for m in self.cut.finditer(text) if self.cut else ():
            out += [self._ids(text[at:m.start()]), np.array([self.special[m.group()]], "<u4").tobytes()]
            at = m.end()
        return np.frombuffer(b"".join([*out, self._ids(text[at:])]), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.labels.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _library_split(text: str) -> list[str]:
    """The pre-split of the tokenizers library, whose Unicode tables count."""
    from tokenizers import pre_tokenizers

    return [text[a:b] for _, (a, b) in pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encoded(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row, and `ids` if asked for.

    The vocabulary file is read once, on the driver, and broadcast: its size does not depend on the data.
    """
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    Automaton(spec)  # raises here for what is not supported
    shared = docs.sparkSession.sparkContext.broadcast({"spec": spec})
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value  # one for each worker process: the automaton serves all its tasks
        if "automaton" not in own:
            own["automaton"] = Automaton(own["spec"])
        automaton = own["automaton"]
        for b in batches:
            ids = [automaton.encode(t) for t in b.column(1).to_pylist()]
            columns = [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([_sha(x.tobytes()) for x in ids], pa.string()),
                       pa.array([_sha(automaton.decode(x).encode()) for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names=names)

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)
