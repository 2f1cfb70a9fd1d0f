"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that BPE
produces.  It starts as one state with an arc to itself for every base symbol.
The merges are then applied in order, each by a gadget: for the merge of ``u``
and ``v``, the state behind arc ``u`` loses its arc ``v``, and an arc labelled
``uv`` leads from where ``u`` started to where ``v`` ended.  A gadget whose
path ``u v`` has been removed already adds nothing.

``compile_tables`` does this once on the driver.  There is one state per token,
the state behind its arc.  Written out, the arcs of tens of thousands of states
would be billions; but the state behind ``uv`` is that behind ``v`` as it was
when the gadget was made, and so is the label ``uv`` to the label ``u``.  A state
therefore keeps only the arcs that a gadget took from itself, and a link to the
state (and label) it inherits from with the gadget's rank: an entry per merge.

A word is read symbol by symbol, by a table of transitions over all tokens' symbols
with failure arcs (``goto``, ``back``): its state names the longest token that ends
here, ``shorter`` the next ones.  Every prefix of a word has one accepted path, so
exactly one of these tokens is an arc of the state in which the path of the prefix
before it ended; that token is kept per symbol.  No symbol is read twice: the work
is linear in the word, times at most the tokens that end alike.  The path is read
back from the word's end.  Decoding emits the labels of the arcs.

Size for 49k merges: about 89,000 symbol transitions and 48,900 gadgets, 3 MB sent with the
tasks.  Each distinct word of a slice of texts is encoded once, in sorted order, so
that common beginnings are read once.  Arcs already resolved through the links are
remembered per Python worker within ``ARC_ENTRIES``.

Defined results: a null text counts as empty (no ids, empty decoded text);
repeated rows stay; an empty table gives an empty result; other columns are
ignored.  The tokenizer must be a BPE file with byte-level symbols, a word-end
suffix and no post-processor or decoder.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .storage import make_importable
from .words import FAR, byte_characters, distinct_words, plain_letters, slices, split_marks, spread

#: Resolved arcs that are remembered per Python worker.
ARC_ENTRIES = 250_000
#: Symbols: the 256 bytes, and the 256 bytes as a word's last.
SYMBOLS = 512


class Tables(NamedTuple):
    """The compiled automaton."""

    rank: np.ndarray  # per token: its gadget's number, -1 for base symbols
    left: np.ndarray  # per token: label it inherits from
    right: np.ndarray  # per token: state it inherits from
    removed: np.ndarray  # arcs taken by gadgets: state * tokens + label,
    removed_by: np.ndarray  # and by which one
    edges: np.ndarray  # symbol transitions: node * SYMBOLS + symbol,
    to: np.ndarray  # and the node behind
    back: np.ndarray  # per node: failure arc
    longest: np.ndarray  # per node: longest token that ends here
    shorter: np.ndarray  # per token: next shorter token that ends alike
    length: np.ndarray  # per token: symbols


def has_arc(x: int, y: int, rank: list[int], left: list[int], right: list[int], removed: dict[int, int]) -> bool:
    """Whether the state behind token x has an arc y, by its own removed arcs
    and those of the states and labels it inherits from."""
    n, before = len(rank), len(rank)
    while True:
        by = removed.get(x * n + y)
        if by is not None and by < before:
            return False
        if rank[x] > rank[y]:
            before, x = rank[x], right[x]
        elif rank[y] >= 0:
            before, y = rank[y] + 1, left[y]  # of equal pairs the left one merges first
        else:
            return True


def compile_tables(spec: str) -> Tables:
    """Apply the gadgets of all merges in order, then lay out the symbol
    transitions of the tokens that are left."""
    model = json.loads(spec)["model"]
    ids, end = model["vocab"], model.get("end_of_word_suffix") or ""
    n = max(ids.values()) + 1
    rank, left, right = [-1] * n, [-1] * n, [-1] * n
    symbols: dict[int, tuple[int, ...]] = {}  # per token that has an arc
    for byte, c in byte_characters().items():
        if c in ids:
            symbols[ids[c]] = (byte,)
        if end and c + end in ids:
            symbols[ids[c + end]] = (byte + 256,)
    removed: dict[int, int] = {}
    for r, merge in enumerate(model["merges"]):
        u, v = (ids[x] for x in (merge if isinstance(merge, list) else merge.split(" ")))
        if u in symbols and v in symbols and has_arc(u, v, rank, left, right, removed):
            joined = ids[_joined(merge)]
            removed[u * n + v] = r
            rank[joined], left[joined], right[joined] = r, u, v
            symbols[joined] = symbols[u] + symbols[v]

    goto: dict[int, int] = {}
    token, parent, depth = [-1], [0], [0]
    for t, word in symbols.items():
        node = 0
        for s in word:
            key = node * SYMBOLS + s
            if key not in goto:
                goto[key] = len(token)
                token.append(-1)
                parent.append(key)
                depth.append(depth[node] + 1)
            node = goto[key]
        token[node] = t
    back, longest = [0] * len(token), token[:]
    shorter = [-1] * n
    for node in sorted(range(1, len(token)), key=depth.__getitem__):
        above, s = divmod(parent[node], SYMBOLS)
        if above:
            at = back[above]
            while at and at * SYMBOLS + s not in goto:
                at = back[at]
            back[node] = goto.get(at * SYMBOLS + s, 0)
        if token[node] < 0:
            longest[node] = longest[back[node]]
        else:
            shorter[token[node]] = longest[back[node]]
    length = [len(symbols.get(t, ())) for t in range(n)]
    pairs = [np.fromiter(x, "i8") for d in (removed, goto) for x in (d.keys(), d.values())]
    small = [np.array(x, "i4") for x in (rank, left, right, back, longest, shorter, length)]
    return Tables(*small[:3], pairs[0], pairs[1].astype("i4"), pairs[2], pairs[3].astype("i4"), *small[3:])


def _joined(merge: list | str) -> str:
    return "".join(merge) if isinstance(merge, list) else merge.replace(" ", "", 1)


class Automaton:
    def __init__(self, spec: str, tables: Tables | None = None):
        conf = json.loads(spec)
        model = conf["model"]
        if model["type"] != "BPE" or conf.get("decoder") or conf.get("post_processor"):
            raise ValueError("a BPE tokenizer without decoder or post-processor is expected")
        self.spec = spec
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.ids: dict[str, int] = model["vocab"]
        self.labels = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.last = 256 if model.get("end_of_word_suffix") else 0
        split = next(p for p in conf["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special_pattern = re.compile("|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) or r"(?!)")
        self.to_byte = {ord(c): b for b, c in byte_characters().items()}
        t = tables or compile_tables(spec)
        self.size = len(t.rank)
        self.inherit = [x.tolist() for x in (t.rank, t.left, t.right)]
        self.removed = dict(zip(t.removed.tolist(), t.removed_by.tolist()))
        self.goto = dict(zip(t.edges.tolist(), t.to.tolist()))
        self.back, self.longest, self.shorter, self.length = (
            x.tolist() for x in (t.back, t.longest, t.shorter, t.length)
        )
        top = max(self.labels) + 1
        self.numbers = pa.array(map(str, range(top)), pa.string())
        self.names = pa.array([self.labels.get(i, "") for i in range(top)], pa.string())
        self.arcs: dict[int, bool] = {}
        self._library = None

    def arc(self, x: int, y: int) -> bool:
        key = x * self.size + y
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= ARC_ENTRIES:
                self.arcs.clear()
            known = self.arcs[key] = has_arc(x, y, *self.inherit, self.removed)
        return known

    # -- words ----------------------------------------------------------

    def encode_words(self, words: list[bytes]) -> tuple[array, list[int]]:
        """The ids of pre-split words one after another, and their numbers. What a
        word has in common with the one before is not read again, so sorted words
        go fastest."""
        goto, back, longest, shorter, length = self.goto.get, self.back, self.longest, self.shorter, self.length
        arcs, arc, size, last = self.arcs.get, self.arc, self.size, self.last
        before = b""
        nodes: list[int] = [0]  # state before each symbol and at the end
        path: list[int] = []  # per symbol, the arc that ends with it
        ids, numbers = array("i"), []
        for word in words:
            final = len(word) - 1
            same, most = 0, min(final, len(before) - 1)  # the last symbols are others
            while same < most and word[same] == before[same]:
                same += 1
            del nodes[same + 1 :], path[same:]
            node = nodes[same]
            for i in range(same, final + 1):
                s = word[i] if i < final else word[i] + last
                after = goto(node * SYMBOLS + s)
                while after is None:
                    if not node:
                        raise ValueError(f"no arc for symbol {s}")
                    node = back[node]
                    after = goto(node * SYMBOLS + s)
                node = after
                token = longest[node]
                while (at := i - length[token]) >= 0:
                    known = arcs(path[at] * size + token)
                    if known or known is None and arc(path[at], token):
                        break
                    token = shorter[token]
                nodes.append(node)
                path.append(token)
            before = word
            out = []
            while final >= 0:
                out.append(path[final])
                final -= length[path[final]]
            out.reverse()
            ids.extend(out)
            numbers.append(len(out))
        return ids, numbers

    def encode_word(self, word: bytes) -> list[int]:
        return self.encode_words([word])[0].tolist()

    def pre_split(self, text: str) -> list[bytes]:
        """Words of a text without special tokens."""
        if FAR.search(text):  # split by the tokenizer file's own normalizer
            if self._library is None:
                from tokenizers import Tokenizer

                self._library = Tokenizer.from_str(self.spec)
            lib = self._library
            words = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(text))
            return [w.translate(self.to_byte).encode("latin-1") for w, _ in words]
        text = unicodedata.normalize("NFC", text)
        # str.lower() has a rule for a final sigma that the normalizer lacks
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return [w.encode() for w in self.pattern.findall(text)]

    def encode(self, text: str) -> list[int]:
        """Ids of a text, special tokens' strings included."""
        out: list[int] = []
        at = 0
        for m in [*self.special_pattern.finditer(text), None]:
            for word in self.pre_split(text[at : m.start() if m else len(text)]):
                out += self.encode_word(word)
            if m:
                out.append(self.special[m[0]])
                at = m.end()
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.labels[i] for i in ids])

    def table(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one after another, and their numbers."""
        letters, others = [], []  # one pre-split word each, or not
        for k, w in enumerate(words.to_pylist()):
            if w.isalpha() and plain_letters(w) and (w if w.islower() and w.isascii() else (w := w.lower())).isalpha():
                letters.append((w.encode(), k))
            else:
                others.append((w, k))
        letters.sort()
        ids, numbers = self.encode_words([w for w, _ in letters])
        for w, _ in others:
            own = self.encode(w)
            ids.extend(own)
            numbers.append(len(own))
        lengths, order = np.array(numbers, "i8"), np.argsort(np.array([k for _, k in letters + others], "i8"))
        return spread(np.array(ids, "i4"), lengths, order, np.arange(len(order) + 1))[0], lengths[order]

    def encode_decode(self, texts: pa.Array) -> list[pa.Array]:
        """Number of ids, ids as text and decoded text of each text; each distinct
        word of the texts is encoded once."""
        distinct, words, ends = distinct_words(texts)
        # two parts per distinct word: without its marks, and the marks
        cores, marks = (x.dictionary_encode() for x in split_marks(distinct, self.special_pattern.pattern if self.special else ""))
        (core_ids, core_n), (mark_ids, mark_n) = self.table(cores.dictionary), self.table(marks.dictionary)
        parts = np.stack([cores.indices.to_numpy(), marks.indices.to_numpy() + len(core_n)], axis=1).ravel()
        ids, at = spread(np.concatenate([core_ids, mark_ids]), np.concatenate([core_n, mark_n]), parts, np.arange(0, len(parts) + 1, 2))
        ids, ends = spread(ids, np.diff(at), words, ends)

        def text(names: pa.Array) -> pa.Array:
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names.take(pa.array(ids))), " ")

        return [pa.array(np.diff(ends), pa.int64()), text(self.numbers), text(self.names)]


_LOADED: dict[str, Automaton] = {}


def automaton(spec: str, tables: Tables) -> Automaton:
    """The automaton, once per Python worker."""
    key = hashlib.md5(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Automaton(spec, tables)
    return _LOADED[key]


def read_spec(path: str) -> str:
    """The tokenizer file; read on the driver and sent along with the tasks
    (a vocabulary of fixed size, 1.7 MB for 49k ids)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


_COLUMNS = ["doc_id", "n_tokens", "ids", "decoded"]


def encode_decode(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: ``ids`` are the decimal ids joined
    by one space, ``decoded`` the text made from them."""
    spec = read_spec(tokenizer_path)
    Automaton(spec, tables := compile_tables(spec))  # an unfit tokenizer is refused here
    make_importable(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = automaton(spec, tables)
        for batch in batches:
            for part in slices(batch, 1, 4096, 8 << 20):
                yield pa.RecordBatch.from_arrays([part.column(0), *coder.encode_decode(part.column(1))], _COLUMNS)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids string, decoded string")
