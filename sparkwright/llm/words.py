"""Helpers shared by the tokenizing operators: white-space words and a bounded
cache of what each word encodes to."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space for str.split(), not for Unicode
_SPACE = regex.compile(r"\s+")
#: From here on character classes differ between Unicode versions.
FAR = re.compile("[԰-\U0010ffff]")
_TAILS = ".,;:!?#$%&*()"

#: Cached words per Python worker, twice with those of the time before.
CACHE_WORDS = 250_000
#: Longer words are encoded each time.
CACHE_LENGTH = 48


def byte_characters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: bytes that are
    printable in Latin-1 as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def split_words(text: str) -> list[str]:
    """Maximal runs without Unicode white space."""
    if _SEPARATORS.search(text):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


def slices(batch: pa.RecordBatch, texts: int, rows: int = 1024, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of up to ``rows`` rows, and of up to ``size`` bytes of
    column ``texts`` unless a single text is longer."""
    length = pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(length, dtype="i8")
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, "right"))))
        yield batch.slice(at, to - at)
        at = to


def distinct_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts (cut at ASCII white space; there may be an
    empty one), the number of each word in order, and where texts begin and
    end among them."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    encoded = cut.flatten().dictionary_encode()
    ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), dtype="i8")
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False), np.concatenate([[0], ends])


#: Letters and digits that every Unicode version has as such, in lower case too.
_INSIDE = "[A-Za-z0-9À-ÖØ-öø-įı-ɏ]"


def split_marks(words: pa.Array, whole: str) -> tuple[pa.Array, pa.Array]:
    """Each word without the marks at its end, A-Z lower-cased, and the marks.
    Words without a letter or digit before the marks, and those that match
    ``whole`` in any case, stay as they are, with no marks."""
    core = pc.ascii_rtrim(words, characters=_TAILS)
    apart = pc.match_substring_regex(core, _INSIDE + "$")
    if whole:
        apart = pc.and_not(apart, pc.match_substring_regex(words, whole, ignore_case=True))
    marked = pc.and_(apart, pc.less(pc.binary_length(core), pc.binary_length(words)))
    marks = pc.replace_substring_regex(pc.filter(words, marked), f"(?s)^.*{_INSIDE}", "")
    none = pa.array(np.full(len(words), ""), words.type)
    return pc.if_else(apart, pc.ascii_lower(core), words), pc.replace_with_mask(none, marked, marks)


def spread(values: np.ndarray, lengths: np.ndarray, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each word of ``words`` in order, from the values of the
    distinct ones (``lengths`` each), and where texts begin and end."""
    n = lengths[words]
    reached = np.concatenate([[0], np.cumsum(n)])
    begins = np.cumsum(lengths) - lengths
    places = np.repeat(begins[words] - reached[:-1], n) + np.arange(reached[-1])
    return values[places], reached[ends]


def plain_letters(word: str) -> bool:
    """Letters only, of which normalizing and lower-casing are plain."""
    return word.isalpha() and (
        word.isascii() or not FAR.search(word) and "Σ" not in word and unicodedata.is_normalized("NFC", word)
    )


class WordCache(dict):
    """Maps words to values that are kept per worker.

    Beyond ``size`` words it starts anew, and words of the time before are taken
    over when they come again.  ``letters`` encodes a lower-case word of plain
    letters, ``any_word`` any word; ``join`` puts two values together.  A word
    that is plain letters and marks after them is its letters' value and the
    marks', so that ``Word,`` and ``word`` are encoded once."""

    def __init__(self, letters: Callable, any_word: Callable, join: Callable, size: int = CACHE_WORDS):
        super().__init__()
        self.letters, self.any_word, self.join, self.size = letters, any_word, join, size
        self.marks: dict = {}
        self.before: dict = {}

    def __missing__(self, word: str):
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        value = self.before.get(word)
        if value is None:
            value = self.letters(word) if word.isascii() and word.isalpha() and word.islower() else self._other(word)
        if len(word) <= CACHE_LENGTH:
            self[word] = value
        return value

    def _other(self, word: str):
        core = word.rstrip(_TAILS)
        mark = word[len(core) :]
        low = core.lower()
        if not (plain_letters(core) and low.isalpha()):
            value = self.any_word(word)
        else:
            value = self.get(low)
            if value is None:
                value = self.letters(low)
                if len(low) <= CACHE_LENGTH:
                    self[low] = value
            if mark:
                last = self.marks.get(mark)
                if last is None:
                    last = self.any_word(mark)
                    if len(mark) <= 4:
                        self.marks[mark] = last
                value = self.join(value, last)
        return value

    def many(self, words: list[str]) -> list:
        return list(map(self.__getitem__, words))
