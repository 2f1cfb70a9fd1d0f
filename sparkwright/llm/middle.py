"""Fill-in-middle transformation with SWAR words.

A text is cut into prefix, middle and suffix at token boundaries, tokens being
``[A-Za-z]+|[^A-Za-z]`` over code points.  No token list is made.  The UTF-8
bytes are viewed as ``uint64`` words, eight bytes each, and the last byte of
every token is marked in all eight bytes at once by arithmetic:

* a byte is an ASCII letter, or a continuation byte, by carries into its high
  bit;
* it ends a token unless the next byte is a continuation byte, or both are
  letters (the next byte's bit comes by a shift, over the words' border too).

``bitwise_count`` gives the tokens per word and their running sum the token
number at each word's end.  A cut behind the k-th token is searched in that
sum; the place inside the word is a select: one multiplication adds up the
marks byte by byte, and the bytes with a smaller sum are counted.

The form of a document (plain, psm or spm) and its cuts follow from the sha256
of ``seed:doc_id``.  A text that holds a marker stays plain, so the output can
be taken apart again: ``restored`` does that from output and form alone.

Scale: one pass, no shuffle; memory is a few times the longest text.

Defined results: a null text is empty; an empty text is plain; a null id is
hashed as the word ``null``; repeated rows stay and are cut alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import make_importable

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_BYTES = np.uint64(0x0101010101010101)
_HIGH = _BYTES * np.uint64(0x80)
_LOW = ~_HIGH
_CASE = _BYTES * np.uint64(0x20)
#: Added to a byte below 128 these carry into its high bit from "a", and from
#: the character after "z".
_FROM_A, _PAST_Z = _BYTES * np.uint64(0x80 - ord("a")), _BYTES * np.uint64(0x80 - ord("z") - 1)


def as_words(data: bytes) -> np.ndarray:
    """The bytes as little-endian words; zeros fill the last one."""
    out = np.zeros(-(-len(data) // 8), "<u8")
    out.view("u1")[: len(data)] = np.frombuffer(data, "u1")
    return out


def _of_next(marks: np.ndarray) -> np.ndarray:
    """Each byte's mark replaced by that of the byte after it."""
    out = marks >> np.uint64(8)
    out[:-1] |= marks[1:] << np.uint64(56)
    return out


def unit_ends(data: bytes) -> np.ndarray:
    """Per word the high bits of the bytes that end a token."""
    words = as_words(data)
    folded = (words & _LOW) | _CASE
    letters = (folded + _FROM_A) & ~(folded + _PAST_Z) & ~words & _HIGH
    inside = words & ~(words << np.uint64(1)) & _HIGH  # 10xxxxxx
    ends = ~_of_next(inside) & ~(letters & _of_next(letters)) & _HIGH
    if len(data) % 8:
        ends[-1] &= np.uint64((1 << 8 * (len(data) % 8)) - 1)
    return ends


def select_in_word(marks: int, nth: int) -> int:
    """The byte (0 to 7) that holds the ``nth`` mark (from 1) of a word."""
    marks, every = marks >> 7, int(_BYTES)
    sums = marks * every & 0xFFFFFFFFFFFFFFFF  # byte j: marks in bytes 0 to j
    reached = (sums | int(_HIGH)) - nth * every & int(_HIGH)
    return 8 - reached.bit_count()


class Units:
    """Token boundaries of a UTF-8 text."""

    def __init__(self, data: bytes):
        self.marks = unit_ends(data)
        self.seen = np.cumsum(np.bitwise_count(self.marks), dtype="i8")

    def __len__(self) -> int:
        return int(self.seen[-1]) if len(self.seen) else 0

    def end_of(self, k: int) -> int:
        """Bytes of the first ``k`` tokens."""
        if not k:
            return 0
        word = int(np.searchsorted(self.seen, k))
        before = int(self.seen[word - 1]) if word else 0
        return 8 * word + select_in_word(int(self.marks[word]), k - before) + 1


def draws(doc_id, seed: str) -> list[int]:
    """Four numbers of 32 bits for a document."""
    digest = sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def transform(doc_id, text: str | None, seed: str, plain_percent: int, spm_percent: int) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    text = text or ""
    data = text.encode()
    units = Units(data)
    n = len(units)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= 100 - plain_percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = (units.end_of(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = (part.decode() for part in (data[:first], data[first:second], data[second:]))
    if h4 % 100 < spm_percent:
        form, output = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, output = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return n, form, len(prefix), len(middle), output


def fill_in_middle(documents: DataFrame, seed: str = "1", plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per document."""
    make_importable(documents.sparkSession)
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [
                    transform(i, t, seed, plain_percent, spm_percent)
                    for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    in_order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    whole = lambda form: F.concat(*(F.get(parts, F.lit(k)) for k in in_order[form]))
    return F.when(form == "psm", whole("psm")).when(form == "spm", whole("spm")).otherwise(output)
