"""BPE encoding and decoding by a tokenization automaton.

The automaton reads token labels and accepts exactly the token sequences that the merges make of some text. It is
built by successive merge gadgets, one for each merge (a, b) -> c in order of priority: the arcs labelled a
are led to a copy of their state without the arcs labelled b, as a may no longer stand before b, and arcs labelled c lead from wherever a was
possible to where b leads. In every step all arcs with one label lead to one state, so that a state is its copy chain and
a label has one target.

Arcs that a gadget takes away are an interval. Tokens are numbered in preorder of the forest in which a
merge's left side is the parent of its result, newest children first. An arc c exists wherever the arc of its parent
did at the time of its merge; so a copy that loses b at step k loses b and what grew on b from step k on, which follow b at once.
A state's lost arcs are thus the intervals of its chain; its row of the transition table is filled as labels are met.

Encoding runs the automaton over the lattice of tokens in a pre-split word. As each prefix has one accepted token sequence, each
position has one state; arcs are table lookups. Decoding emits the labels of the arcs.

Words are split before by the normalizer and pre-tokenizer that the file names; ids of words are remembered by a worker, up
to a bound. Where splitting at blanks first changes nothing, which probes check, so are those of what stands between blanks.

Null texts count as empty; an empty text has no ids and the decoded text ''. Texts of any length are encoded whole, in time proportional to them. Null
and repeated ids are rows like others; an empty table gives no rows. Only key and text are read, so other
columns' names can't clash."""

from __future__ import annotations

import json
import re
import string
import sys
from array import array
from bisect import bisect_right
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words, and pieces between blanks, whose ids a worker remembers, and how long they may be.
WORDS, LONG = 500_000, 64
#: Texts whose parts between blanks must be split as the whole is, for parts to be remembered.
PROBES = ("a b", " two  words ", "line\none", "don't stop, now. (ok) 12 3", "\n\nx\n", "é ß 日本 語", "é ́x", "Hello world-wide web's e.g.")


class Automaton:
    """States are numbers from 0, where a word begins; labels are token ids."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        size = max(vocabulary.values(), default=-1) + 1
        birth, parent = [0] * size, [-1] * size
        steps, made = [], set()
        for k, (x, y) in enumerate(merges, 1):
            a, b, c = vocabulary[x], vocabulary[y], vocabulary[x + y]
            if c in made or x == "" or y == "":
                raise ValueError(f"two merges make {x + y!r}")
            made.add(c)
            birth[c], parent[c] = k, a
            steps.append((k, a, b, c))
        if any(birth[a] >= k or birth[b] >= k for k, a, b, _ in steps):
            raise ValueError("a merge comes before its parts are made")
        children: dict[int, list[int]] = {}
        for k, a, _, c in reversed(steps):
            children.setdefault(a, []).append(c)  # newest first
        self.number, end = _preorder(size, parent, children)

        def lost(b: int, k: int) -> tuple[int, int]:
            """b and what grew on it from step k on."""
            older = next((c for c in children.get(b, ()) if birth[c] < k), None)
            return self.number[b], self.number[older] if older is not None else end[b]

        self.base = [(0, 0, 0)]  # per state: the state it is a copy of, and the interval that it lost besides
        self.target, dead = [0] * size, [False] * size
        for k, a, b, c in steps:
            if dead[a] or dead[b] or self._lacks(self.target[a], self.number[b]):
                dead[c] = True  # these two never meet: other merges come before
                continue
            at = self.target[a]
            self.target[c] = self.target[b]
            self.base.append((at, *lost(b, k)))
            self.target[a] = len(self.base) - 1
        self.dead = dead
        self._rows: dict[int, tuple[list[int], list[int]]] = {}
        self.table: list[dict[int, int]] = [{} for _ in self.base]

    def _lacks(self, state: int, number: int) -> bool:
        while state:
            state, lo, hi = self.base[state]
            if lo <= number < hi:
                return True
        return False

    def _lost(self, state: int) -> tuple[list[int], list[int]]:
        """All intervals that a state lost, disjoint and in order."""
        if state not in self._rows:
            chain, at = [], state
            while at:
                at, lo, hi = self.base[at]
                chain.append((lo, hi))
            los, his = [], []
            for lo, hi in sorted(chain):
                if his and lo <= his[-1]:
                    his[-1] = max(his[-1], hi)
                else:
                    los.append(lo)
                    his.append(hi)
            self._rows[state] = los, his
        return self._rows[state]

    def arc(self, state: int, label: int) -> int:
        """Where the arc leads, or -1; kept in the state's row of the table."""
        los, his = self._lost(state)
        i = bisect_right(los, self.number[label]) - 1
        to = -1 if self.dead[label] or (i >= 0 and self.number[label] < his[i]) else self.target[label]
        self.table[state][label] = to
        return to


def _preorder(size: int, parent: list[int], children: dict[int, list[int]]) -> tuple[list[int], list[int]]:
    """Each token's number in preorder, and the number behind its last descendant's."""
    number, end, at = [0] * size, [0] * size, 0
    for root in range(size):
        if parent[root] >= 0:
            continue
        stack = [(root, False)]
        while stack:
            t, left = stack.pop()
            if left:
                end[t] = at
                continue
            number[t], at = at, at + 1
            stack.append((t, True))
            stack.extend((c, False) for c in reversed(children.get(t, ())))
    return number, end


class Tokenizer:
    """Encodes and decodes as the tokenizers library does with a file of kind BPE, special tokens of the text included."""

    def __init__(self, path: str):
        import tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")):
            raise ValueError("not a plain BPE model")
        plain = tokenizers.Tokenizer.from_file(path)
        self._normalizer, self._split = plain.normalizer, plain.pre_tokenizer
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        vocabulary = model["vocab"]
        self._merges, self._vocabulary = merges, vocabulary
        self.labels = {i: t for t, i in vocabulary.items()}
        self.special = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError("added tokens that take their surroundings aren't supported")
            self.special[t["content"]] = np.array([t["id"]], "<u4").tobytes()
            self.labels[t["id"]] = t["content"]
        self._specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.joined = (spec.get("decoder") or {"type": "none"})["type"]
        if self.joined not in ("none", "ByteLevel"):
            raise ValueError("not a decoder that is supported")
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {"": b""}
        between = lambda t: [w for p in t.replace("\n", " ").split(" ") for w in self.split(p)]
        #: signs that are a word of their own behind letters; nothing else is known of them
        self.signs = "".join(c for c in string.punctuation if all(self.split(w + c * k) == [w.lower(), c * k] for w in ("ab", "Zq") for k in (1, 2)))
        if self.split("Ab" + self.signs) != ["ab", self.signs]:
            self.signs = ""
        self.by_pieces = not any(" " in t or "\n" in t for t in self.special) and all(self.split(t) == between(t) for t in PROBES)

    @cached_property
    def automaton(self) -> Automaton:
        return Automaton(self._vocabulary, self._merges)

    @cached_property
    def trie(self) -> list:
        """[label or -1, {letter: node}]: the tokens by letters, the last one with the suffix."""
        root = [-1, {}]
        for token, i in self._vocabulary.items():
            node = root
            for symbol in self._symbols(token.removesuffix(self.suffix) if self.suffix else token, token):
                node = node[1].setdefault(symbol, [-1, {}])
            node[0] = i
        return root

    def _symbols(self, word: str, token: str | None = None) -> list[str]:
        """A word's letters; the last one has the suffix, unless a token says it has none."""
        symbols = list(word)
        if self.suffix and symbols and (token is None or token != word):
            symbols[-1] += self.suffix
        return symbols

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text:
            return []
        text = self._normalizer.normalize_str(text) if self._normalizer is not None else text
        return [w for w, _ in self._split.pre_tokenize_str(text)] if self._split is not None else [text]

    def word(self, word: str) -> bytes:
        """The ids of one pre-split word: the automaton's path through the lattice of tokens in it, longest tokens first.

        A prefix has one accepted path, so a position has one state; where a path doesn't go on to the end of the word, it is
        left for the next shorter token, and its positions aren't tried again."""
        symbols, root = self._symbols(word), self.trie[1]
        table, arc = self.automaton.table, self.automaton.arc
        n = len(symbols)
        tried = bytearray(n + 1)
        path: list[int] = []
        states, lattice, at = [0], [], 0
        while at < n:
            if len(lattice) < len(states):  # the tokens that begin here, the longest one last
                here, below = [], root
                for j in range(at, n):
                    node = below.get(symbols[j])
                    if node is None:
                        break
                    label, below = node
                    if label >= 0:
                        here.append((j + 1, label))
                lattice.append(here)
            here, state = lattice[-1], states[-1]
            row = table[state]
            while here:
                end, label = here.pop()
                if tried[end]:
                    continue
                to = row.get(label)
                if to is None:
                    to = arc(state, label)
                if to >= 0:
                    tried[end] = 1
                    path.append(label)
                    states.append(to)
                    at = end
                    break
            else:
                if not path:
                    raise ValueError(f"no tokens for {word!r}")
                lattice.pop()
                states.pop()
                path.pop()
        ids = array("I", path)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _known(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = self.word(word)
            if len(word) <= LONG:
                if len(self.words) >= WORDS:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def piece(self, text: str) -> bytes:
        """The ids of any text."""
        if self._specials is not None and self._specials.search(text):
            return b"".join(self.special[p] if i % 2 else self.piece(p) for i, p in enumerate(self._specials.split(text)))
        core = text.rstrip(self.signs) if self.signs else ""
        if core.isalpha() and core.isascii() and text.isascii():
            return self._known(core.lower()) + (self._known(text[len(core) :]) if len(core) < len(text) else b"")
        return b"".join(map(self._known, self.split(text)))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not self.by_pieces:
            return self.piece(text or "")
        parts = (text or "").replace("\n", " ").split(" ")
        out = list(map(self.pieces.get, parts))
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    p = parts[i]
                    ids = out[i] = self.pieces.get(p)
                    if ids is None:
                        ids = out[i] = self.piece(p)
                        if len(p) <= LONG:
                            if len(self.pieces) >= WORDS:
                                self.pieces = {"": b""}
                            self.pieces[p] = ids
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of the labels; special tokens are kept."""
        text = [self.labels[i] for i in np.frombuffer(ids, "<u4").tolist()]
        if self.joined == "none":
            return " ".join(text)
        return b"".join(map(_label_bytes, text)).decode("utf-8", "replace")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level tokens: themselves where printable, else the letters from 256 on in order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


_LETTERS = _byte_letters()


def _label_bytes(label: str) -> bytes:
    try:
        return bytes(map(_LETTERS.__getitem__, label))
    except KeyError:
        return label.encode()


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One for each file, kept by the process, as its table fills while it is used."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


#: Rows that are handed on at a time.
ROWS = 256


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, n_tokens, ids (little-endian unsigned 32-bit integers), as the tokenizers library gives with add_special_tokens=False."""

    def run(batches):
        t = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                ids = [t.encode(x.as_py()) for x in rows.column(1)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], [key, "n_tokens", "ids"])

    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens long, ids binary")


def decoded(ids: DataFrame, path: str, column: str = "ids", name: str = "text") -> DataFrame:
    """ids with the text of their tokens, as the library's decode gives with skip_special_tokens=False; null ids give null."""
    from pyspark.sql.types import StringType, StructField, StructType

    fields = [f for f in ids.schema.fields if f.name != name]

    def run(batches):
        t = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                text = [None if x is None else t.decode(x) for x in rows.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[rows.column(f.name) for f in fields], pa.array(text, pa.string())], [*[f.name for f in fields], name])

    return ids.mapInArrow(run, StructType([*fields, StructField(name, StringType())]))
