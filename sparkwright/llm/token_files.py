"""Token ids in patched frame-of-reference blocks.

File format.  A data set is a folder of Parquet files whose rows are segments
``part, segment, n_ids, data``; Spark's writer commits them, so a lost task
leaves nothing behind, and any store that Spark reaches will do.  ``data`` is
one binary segment, little-endian:

    4s magic, u32 block size, u32 documents, u32 blocks, u64 ids
    documents x (u8 has an id, i64 doc_id, u32 ids)
    blocks x u32  start of the block in the body (the index)
    blocks x u32  block minimum
    blocks x u8   bit width
    blocks x u16  number of exceptions
    body: per block the packed offsets, then exceptions (u16 place, u32 offset)

An id's offset is its distance from the block's minimum.  The width is what
the ``percentile``-th smallest offset of the block needs; offsets that need
more bits are exceptions, stored whole, and zero in the packed part.  Every
block starts on a byte named in the index, so one block can be read alone.

Order: parts ascend by ``doc_id`` (their bounds are quantiles of the ids), as
do the rows of a part and its segments, so reading parts and segments in order
gives ascending ``doc_id``.

Defined results: a null text counts as empty, so its document has the end id
alone; a null ``doc_id`` comes first; equal ``doc_id``s are ordered by their
ids' bytes and stay; an empty table writes no segment and reads back empty;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import make_importable
from .words import WordCache, byte_characters, distinct_words, slices, split_marks, spread

MAGIC, HEAD = b"PFR1", struct.Struct("<4sIIIQ")
_DOC = np.dtype([("has", "u1"), ("doc_id", "<i8"), ("n", "<u4")])
_EXCEPTION = np.dtype([("at", "<u2"), ("value", "<u4")])
#: Ids of a segment: a segment is closed when it has as many (4 MB unpacked).
SEGMENT_IDS = 1 << 20


# -- blocks ---------------------------------------------------------------


def pack(ids: np.ndarray, docs: np.ndarray, block: int = 256, percentile: int = 90) -> bytes:
    """One segment. ``docs`` has a row of ``_DOC`` per document."""
    n = len(ids)
    count = -(-n // block)
    padded = np.full(count * block, ids[-1] if n else 0, "<u4")
    padded[:n] = ids
    rows = padded.reshape(count, block)
    low = rows.min(axis=1) if count else np.zeros(0, "<u4")
    offsets = rows - low[:, None]
    at = max(0, -(-block * percentile // 100) - 1)
    typical = np.partition(offsets, at, axis=1)[:, at] if count else low
    width = np.where(typical > 0, np.floor(np.log2(np.maximum(typical, 1).astype("f8"))) + 1, 0).astype("u1")
    outside = (offsets.astype("u8") >> width.astype("u8")[:, None]) > 0
    n_out = outside.sum(axis=1).astype("<u2")
    packed_size = width.astype("i8") * (block // 8)
    starts = np.zeros(count + 1, "i8")
    np.cumsum(packed_size + n_out.astype("i8") * _EXCEPTION.itemsize, out=starts[1:])
    if starts[-1] >= 1 << 32:
        raise ValueError("segment too large")
    body = np.zeros(starts[-1], "u1")
    inside = np.where(outside, 0, offsets)
    for w in np.unique(width[width > 0]):
        which = np.flatnonzero(width == w)
        bits = (inside[which][:, :, None] >> np.arange(w, dtype="<u4")).astype("u1") & 1
        data = np.packbits(bits.reshape(len(which), -1), axis=1, bitorder="little")
        body[starts[which][:, None] + np.arange(data.shape[1])] = data
    where, place = np.nonzero(outside)
    exceptions = np.zeros(len(where), _EXCEPTION)
    exceptions["at"], exceptions["value"] = place, offsets[where, place]
    first = np.concatenate([[0], np.cumsum(n_out.astype("i8"))])[:-1]
    to = (starts[:-1] + packed_size - first * _EXCEPTION.itemsize)[where] + np.arange(len(where)) * _EXCEPTION.itemsize
    body[to[:, None] + np.arange(_EXCEPTION.itemsize)] = exceptions.view("u1").reshape(len(where), _EXCEPTION.itemsize)
    return b"".join(
        [
            HEAD.pack(MAGIC, block, len(docs), count, n),
            docs.tobytes(),
            starts[:-1].astype("<u4").tobytes(),
            low.astype("<u4").tobytes(),
            width.tobytes(),
            n_out.tobytes(),
            body.tobytes(),
        ]
    )


class Segment:
    """Reads a segment, as a whole or block by block."""

    def __init__(self, data: bytes):
        magic, self.block, n_docs, self.count, self.n = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment")
        self.at = HEAD.size
        self.data = data
        self.docs = self._take(_DOC, n_docs)
        self.starts = self._take("<u4", self.count).astype("i8")
        self.low = self._take("<u4", self.count)
        self.width = self._take("u1", self.count)
        self.n_out = self._take("<u2", self.count).astype("i8")
        self.body = np.frombuffer(data, "u1", offset=self.at)

    def _take(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self.data, kind, n, self.at)
        self.at += out.nbytes
        return out

    def blocks(self, which: np.ndarray) -> np.ndarray:
        """The ids of some blocks, a row each (the last block is padded)."""
        out = np.zeros((len(which), self.block), "<u4")
        for w in np.unique(self.width[which]):
            rows = np.flatnonzero(self.width[which] == w)
            if w:
                data = self.body[self.starts[which[rows]][:, None] + np.arange(int(w) * self.block // 8)]
                bits = np.unpackbits(data, axis=1, bitorder="little").reshape(len(rows), self.block, int(w))
                whole = np.zeros((len(rows), self.block), "<u4")
                for k in range(int(w)):
                    whole |= bits[:, :, k].astype("<u4") << np.uint32(k)
                out[rows] = whole
        n_out = self.n_out[which]
        row = np.repeat(np.arange(len(which)), n_out)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_out) - n_out, n_out)
        begin = (self.starts + self.width.astype("i8") * (self.block // 8))[which][row] + nth * _EXCEPTION.itemsize
        found = np.ascontiguousarray(self.body[begin[:, None] + np.arange(_EXCEPTION.itemsize)]).reshape(-1).view(_EXCEPTION)
        out[row, found["at"]] = found["value"]
        return out + self.low[which][:, None]

    def ids(self) -> np.ndarray:
        return self.blocks(np.arange(self.count)).reshape(-1)[: self.n]

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, from its own blocks only."""
        begin = int(self.docs["n"][:k].sum(dtype="i8"))
        end = begin + int(self.docs["n"][k])
        first, last = begin // self.block, -(-end // self.block)
        flat = self.blocks(np.arange(first, last)).reshape(-1)
        return flat[begin - first * self.block : end - first * self.block]


# -- tokenizing -----------------------------------------------------------

class Encoder:
    """Texts to ids through the tokenizers library, each distinct word of a
    slice once.  The pre-tokenizer must not reach over white space
    (``tokenizer`` checks).  A word of plain letters is one pre-split word,
    which goes to the library's BPE model as it is."""

    def __init__(self, spec: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(spec)
        tok.no_truncation()
        tok.no_padding()
        model, characters, code = tok.model, byte_characters(), {"<u2": "H", "<u4": "I"}[kind]
        self.kind = kind

        def letters(word: str) -> bytes:
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(characters)
            return array(code, [t.id for t in model.tokenize(word)]).tobytes()

        def any_word(word: str) -> bytes:
            return np.array(tok.encode(word, add_special_tokens=False).ids, kind).tobytes()

        self.cache = WordCache(letters, any_word, lambda a, b: a + b)
        self.special = "|".join(re.escape(t["content"]) for t in json.loads(spec)["added_tokens"])

    def _table(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one after another, and their numbers."""
        data = [self.cache[w] if w else b"" for w in words.to_numpy(zero_copy_only=False).tolist()]
        ids = np.frombuffer(b"".join(data), self.kind)
        return ids, np.fromiter(map(len, data), "i8", len(data)) // ids.itemsize

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none), and where texts begin and end."""
        distinct, words, ends = distinct_words(texts)
        # two parts per distinct word: without its marks, and the marks
        cores, marks = (x.dictionary_encode() for x in split_marks(distinct, self.special))
        (core_ids, core_n), (mark_ids, mark_n) = self._table(cores.dictionary), self._table(marks.dictionary)
        parts = np.stack([cores.indices.to_numpy(), marks.indices.to_numpy() + len(core_n)], axis=1).ravel()
        ids, at = spread(np.concatenate([core_ids, mark_ids]), np.concatenate([core_n, mark_n]), parts, np.arange(0, len(parts) + 1, 2))
        return spread(ids, np.diff(at), words, ends)

    def with_end(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        """Each text's ids and the end id."""
        ids, ends = self.encode(texts)
        ids = np.insert(ids, ends[1:], end_id)
        at = (ends + np.arange(len(ends))).tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]


_LOADED: dict[str, Encoder] = {}


def encoder(spec: str, kind: str) -> Encoder:
    """The encoder and its word cache, once per Python worker."""
    key = hashlib.md5(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(spec, kind)
    return _LOADED[key]


def _fits(spec: str) -> bool:
    """Whether it is a byte-level BPE for which white space only separates
    words, and marks are apart from letters: checked on a probe."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(spec)
    ids = lambda x: tok.encode(x, add_special_tokens=False).ids
    return '"ByteLevel"' in spec and ids(" a \n\tb's, É. ") == ids("a") + ids("b") + ids("'s") + ids(",") + ids("é") + ids(".")


def vocabulary_size(spec: str, end_id: int) -> int:
    """One more than the largest id."""
    from tokenizers import Tokenizer

    return max(end_id, *Tokenizer.from_str(spec).get_vocab().values()) + 1


def id_kind(spec: str, end_id: int) -> str:
    return "<u2" if vocabulary_size(spec, end_id) <= 1 << 16 else "<u4"


def tokenizer(path: str, end_id: int) -> tuple[str, str]:
    """The tokenizer file's content, and the numpy kind that holds its ids."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    if not _fits(spec):
        raise ValueError("a byte-level tokenizer that drops white space is expected")
    return spec, id_kind(spec, end_id)


def encode_ids(documents: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``doc_id, width, ids``: the ids of a text and the end id, ``width``
    bytes each (two, or four if the vocabulary needs them)."""
    spec, kind = tokenizer(tokenizer_path, end_id)
    make_importable(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(spec, kind)
        for batch in batches:
            for part in slices(batch, 1):
                ids = [d.tobytes() for d in one.with_end(part.column(1), end_id)]
                width = pa.array([int(kind[-1])] * len(ids), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), width, pa.array(ids, pa.binary())], ["doc_id", "width", "ids"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, width int, ids binary"
    )


# -- files ----------------------------------------------------------------


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``part, doc_id, width, ids`` rows to segments, one part after
    another."""
    held: list[tuple] = []
    state = {"part": None, "segment": 0, "ids": 0}

    def close() -> Iterator[pa.RecordBatch]:
        if held:
            docs = np.array([(d is not None, d or 0, len(b)) for d, b in held], _DOC)
            ids = np.concatenate([b for _, b in held]).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in ((state["part"], pa.int32()), (state["segment"], pa.int32()), (len(ids), pa.int64()), (pack(ids, docs), pa.binary()))],
                ["part", "segment", "n_ids", "data"],
            )
            held.clear()
            state["segment"] += 1
            state["ids"] = 0

    for batch in batches:
        for k in range(batch.num_rows):
            part, doc_id, width, data = (c[k].as_py() for c in batch.columns)
            ids = np.frombuffer(data, f"<u{width}")
            if part != state["part"]:
                yield from close()
                state.update(part=part, segment=0)
            held.append((doc_id, ids))
            state["ids"] += len(ids)
            if state["ids"] >= SEGMENT_IDS:
                yield from close()
    yield from close()


def write_ids(encoded: DataFrame, bounds: list[int], path: str) -> None:
    """Write ``doc_id, width, ids`` rows in ascending ``doc_id`` order.  ``bounds``
    are the first ids of the parts after the first."""
    part = F.lit(0)
    if bounds:
        firsts = F.array(*[F.lit(b).cast("long") for b in bounds])
        part = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(firsts, lambda b: b <= F.col("doc_id"))))
    dealt = encoded.select(part.cast("int").alias("part"), "doc_id", "width", "ids").repartition(len(bounds) + 1, "part")
    packed = dealt.sortWithinPartitions("part", "doc_id", "ids").mapInArrow(
        _pack_rows, "part int, segment int, n_ids long, data binary"
    )
    packed.write.option("compression", "none").parquet(path)


def part_bounds(documents: DataFrame, parts: int) -> list[int]:
    """Quantiles of ``doc_id`` that cut the documents into ``parts``."""
    wanted = [k / parts for k in range(1, parts)]
    if not wanted:
        return []
    row = documents.select(F.percentile_approx(F.col("doc_id").cast("long"), wanted, 10_000)).first()
    return sorted(set(row[0] or []))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32``, all from the files.

    ``start`` counts the ids before it: the totals of the parts before (as many
    rows as parts), of the segments before, and of the segment's rows before."""
    make_importable(spark)
    files = spark.read.schema("part int, segment int, n_ids long, data binary").parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(*(c.to_pylist() for c in batch.columns)):
                seg = Segment(data)
                ids, n = seg.ids(), seg.docs["n"].astype("i8")
                end = np.cumsum(n)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((end - n).tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), part, "i4")),
                        pa.array(np.full(len(n), number, "i4")),
                        pa.array(seg.docs["doc_id"].astype("i8"), mask=seg.docs["has"] == 0),
                        pa.array(end - n),
                        pa.array(n),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "segment", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    rows = files.select("part", "segment", "data").mapInArrow(
        run, "part int, segment int, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("base"))
    seen = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("segment"))), F.lit(0))
    offsets = files.select("part", "segment", seen.alias("seen")).join(parts, "part")
    offsets = offsets.select("part", "segment", (F.col("base") + F.col("seen")).alias("offset"))
    placed = rows.join(offsets, ["part", "segment"])
    return placed.select("doc_id", (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def write_documents(documents: DataFrame, tokenizer_path: str, end_id: int, folder: str) -> str:
    """Tokenize and write; as many parts as the session's shuffle partitions.
    Returns the path of the data set, a new one below ``folder``."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = f"{folder.rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write_ids(encode_ids(documents, tokenizer_path, end_id), part_bounds(documents, parts), path)
    return path
