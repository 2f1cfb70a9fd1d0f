"""Lexical retrieval packing of documents into token sequences.

Documents are tokenized, each with an end id, and dealt out in shards of about
``SHARD_TOKENS`` ids.  A shard has a BM25 inverted index of its documents, with
the tokenizer's ids as terms and with document frequencies and mean length of
the whole table.  Windows of ``window`` ids are filled one after another:

* the seed is the rest of the document that was cut last, or the first unused
  document;
* the seed's query, its ``query_terms`` heaviest terms, returns the unused
  documents of the shard with a common term, best first;
* they fill the window greedily: the best that fits whole, as long as one does;
  then the best that does not fit is cut at the window's end, and its rest is
  the next seed;
* without any neighbour left the next seed goes into the same window.

So every window is full but a shard's last.  That one is cut into sequences
whose lengths are powers of two, the largest first, which need no padding.

Shards are made of documents that share a term: a document's routing term is
its minwise token under weights that grow with the id (byte-pair encodings
give frequent strings small ids), so documents meet with a probability that
follows the share of their rarer tokens in common.  Terms whose documents are
more than a shard, a large group of copies for instance, are split over as
many shards as they need, by a hash of the row; small ones share a shard.

Scale: the texts are read once; ids go to the shared folder, then through one
shuffle by shard.  A task holds one shard, which is bounded but for its longest
document.  The driver and each task hold numbers per term of the vocabulary,
nothing per document.

Defined results: a null text is empty and has the end id alone; null ids stay;
repeated rows and equal ids are documents of their own; equal scores go by the
order of the shard's rows; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import token_files
from .storage import make_importable, settle
from .words import slices

WINDOW = 4096
#: Ids of a shard, about.
SHARD_TOKENS = 1 << 20
#: Terms of a seed's query.
QUERY_TERMS = 32
K1, B = 1.2, 0.75


def routing_ranks(size: int) -> np.ndarray:
    """Per token id an exponential draw over its weight, ((id + 1) / size)^2;
    a document's routing term has the least."""
    draws = np.random.default_rng(20240711).standard_exponential(size)
    return (draws / (np.arange(1, size + 1) / size) ** 2).astype("f4")


def encode(documents: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``doc_id, term, n, ids``: per document its routing term, number of ids
    and ids; and, with null ``ids``, each task's documents ``n`` per ``term``."""
    spec, kind = token_files.tokenizer(tokenizer_path, end_id)
    size = token_files.vocabulary_size(spec, end_id)
    make_importable(documents.sparkSession)
    id_type = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "term", "n", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = token_files.encoder(spec, kind)
        ranks, used, id_arrow = routing_ranks(size), np.zeros(size, "i8"), None
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for part in slices(batch, 1):
                docs = one.with_end(part.column(1), end_id)
                for ids in docs:
                    ordered = np.sort(ids, kind="stable")
                    used[ordered[np.flatnonzero(np.diff(ordered, prepend=ordered[0] ^ 1))]] += 1
                columns = [
                    part.column(0),
                    pa.array([ids[ranks[ids].argmin()] for ids in docs], pa.int32()),
                    pa.array(list(map(len, docs)), pa.int64()),
                    pa.array([ids.tobytes() for ids in docs], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
        seen = np.flatnonzero(used)
        if len(seen):
            columns = [pa.nulls(len(seen), id_arrow), pa.array(seen, pa.int32()), pa.array(used[seen]), pa.nulls(len(seen), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, term int, n long, ids binary")


def shard_plan(totals: dict[int, int], shard_tokens: int) -> list[tuple[int, int, int]]:
    """``term, first, splits`` from the ids per routing term: its documents go
    to ``splits`` shards from ``first`` on."""
    out, shard, filled = [], 0, 0
    for term, n in sorted(totals.items()):
        if n >= shard_tokens:
            if filled:
                shard, filled = shard + 1, 0
            splits = -(-n // shard_tokens)
            out.append((term, shard, splits))
            shard += splits
        else:
            out.append((term, shard, 1))
            filled += n
            if filled >= shard_tokens:
                shard, filled = shard + 1, 0
    return out


# -- one shard ------------------------------------------------------------


class Index:
    """BM25 inverted index of a shard's documents, given as arrays of ids."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        lengths = np.array([len(d) for d in docs])
        flat = np.concatenate(docs)
        doc = np.repeat(np.arange(len(docs)), lengths)
        order = np.argsort(flat, kind="stable")  # by term, then document
        terms, doc = flat[order], doc[order]
        first = np.flatnonzero((np.diff(terms, prepend=terms[0]) != 0) | (np.diff(doc, prepend=-1) != 0))
        tf = np.diff(first, append=len(flat))
        self.terms, self.docs = terms[first].astype("i8"), doc[first]
        bound = K1 * (1 - B + B * lengths / mean_length)
        self.weights = idf[self.terms] * tf * (K1 + 1) / (tf + bound[self.docs])
        self.starts = np.searchsorted(self.terms, np.arange(len(idf) + 1))
        self.by_doc = np.argsort(self.docs, kind="stable")
        self.doc_starts = np.searchsorted(self.docs[self.by_doc], np.arange(len(docs) + 1))
        self.n = len(docs)

    def query(self, doc: int, query_terms: int) -> np.ndarray:
        """The heaviest terms of a document."""
        own = self.by_doc[self.doc_starts[doc] : self.doc_starts[doc + 1]]
        if len(own) > query_terms:
            own = own[np.argsort(-self.weights[own], kind="stable")[:query_terms]]
        return self.terms[own]

    def neighbours(self, doc: int, unused: np.ndarray, query_terms: int = QUERY_TERMS) -> np.ndarray:
        """Unused documents with a term of the query, by falling score."""
        lists = [slice(self.starts[t], self.starts[t + 1]) for t in self.query(doc, query_terms)]
        found = np.concatenate([self.docs[s] for s in lists])
        scores = np.bincount(found, np.concatenate([self.weights[s] for s in lists]), self.n)
        scores[~unused] = 0
        some = np.flatnonzero(scores)
        return some[np.argsort(-scores[some], kind="stable")]


def fill(lengths: np.ndarray, neighbours: Callable[[int, np.ndarray], np.ndarray], window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``doc, start, length, sequence, offset`` that hold every id once.
    ``neighbours(doc, unused)`` returns documents in the order of choice."""
    unused = np.ones(len(lengths), bool)
    out: list[tuple[int, int, int, int, int]] = []
    sequence, offset, first, rest = 0, 0, 0, None

    def put(doc: int, start: int) -> tuple[int, int] | None:
        """As much as has room; what is left of the document."""
        nonlocal sequence, offset
        n = min(int(lengths[doc]) - start, window - offset)
        out.append((doc, start, n, sequence, offset))
        unused[doc] = False
        offset += n
        if offset == window:
            sequence, offset = sequence + 1, 0
        return (doc, start + n) if start + n < lengths[doc] else None

    while True:
        if rest is None:
            while first < len(lengths) and not unused[first]:
                first += 1
            if first == len(lengths):
                break
            rest = first, 0
        seed = rest[0]
        rest = put(*rest)
        if rest or not offset:
            continue
        found = neighbours(seed, unused)
        size, too_long = lengths[found], None
        while len(found) and offset:
            fits = size <= window - offset
            k = int(fits.argmax())
            if not fits[k]:
                k = len(found)
            if k and too_long is None:
                too_long = int(found[0])
            if k < len(found):
                put(int(found[k]), 0)
            found, size = found[k + 1 :], size[k + 1 :]
        if offset and too_long is not None:
            rest = put(too_long, 0)
    return powers_of_two(out, offset)


def powers_of_two(pieces: list[tuple[int, int, int, int, int]], length: int) -> list[tuple[int, int, int, int, int]]:
    """The last sequence, of ``length`` ids if it is not full, cut into
    sequences of a power of two each, the largest first."""
    if not length:
        return pieces
    last = pieces[-1][3]
    begin = next(k for k, p in enumerate(pieces) if p[3] == last)
    out, room, sequence, offset = pieces[:begin], 1 << length.bit_length() - 1, last, 0
    for doc, start, n, _, _ in pieces[begin:]:
        while n:
            some = min(n, room - offset)
            out.append((doc, start, some, sequence, offset))
            start, n, offset = start + some, n - some, offset + some
            if offset == room:
                length, sequence, offset = length - room, sequence + 1, 0
                room = 1 << max(length.bit_length() - 1, 0)
    return out


# -- the table ------------------------------------------------------------


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    end_id: int,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    query_terms: int = QUERY_TERMS,
) -> DataFrame:
    """Pieces of documents: ``doc_id, start, length, ids`` (little-endian,
    32 bits each), ``doc_tokens, sequence_id, offset``."""
    spark = documents.sparkSession
    spec, kind = token_files.tokenizer(tokenizer_path, end_id)
    encoded = settle(encode(documents, tokenizer_path, end_id).withColumn("row", F.monotonically_increasing_id()))
    is_doc = F.col("ids").isNotNull()
    # two numbers per term of the vocabulary
    table = encoded.groupBy(is_doc.alias("is_doc"), "term").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()
    totals = {r["term"]: r["n"] for r in table if r["is_doc"]}
    n_docs = sum(r["rows"] for r in table if r["is_doc"])
    mean_length = sum(totals.values()) / max(n_docs, 1)
    used = np.zeros(token_files.vocabulary_size(spec, end_id))
    for r in table:
        if not r["is_doc"]:
            used[r["term"]] = r["n"]
    idf = np.log1p((n_docs - used + 0.5) / (used + 0.5))

    plan = shard_plan(totals, shard_tokens)
    shards = max((first + splits for _, first, splits in plan), default=1)
    places = F.broadcast(spark.createDataFrame(plan, "term int, first int, splits int"))  # at most the vocabulary
    shard = F.col("first") + F.pmod(F.xxhash64("row"), F.col("splits")).cast("int")
    dealt = encoded.where(is_doc).join(places, "term").select(shard.alias("shard"), "row", "doc_id", "ids")
    parts = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
    sorted_rows = dealt.repartitionById(parts, F.col("shard") % parts).sortWithinPartitions("shard", "row")
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    id_arrow: list[pa.DataType] = []

    def one(shard: int, keys: list, docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        index = Index(docs, idf, mean_length)
        lengths = np.array([len(d) for d in docs])
        pieces = fill(lengths, lambda doc, unused: index.neighbours(doc, unused, query_terms), window)
        for at in range(0, len(pieces), 2048):
            doc, start, length, sequence, offset = zip(*pieces[at : at + 2048])
            data = [docs[d][s : s + n].astype("<u4").tobytes() for d, s, n in zip(doc, start, length)]
            columns = [
                pa.array([keys[d] for d in doc], id_arrow[0]),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(data, pa.binary()),
                pa.array(lengths[list(doc)]),
                pa.array((shard << 32) + np.array(sequence, "i8")),
                pa.array(offset, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, docs = None, [], []
        for batch in batches:
            id_arrow[:] = [batch.schema.field(2).type]
            numbers = batch.column(0).to_pylist()
            for k, key, data in zip(numbers, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if k != at and docs:
                    yield from one(at, keys, docs)
                    keys, docs = [], []
                at = k
                keys.append(key)
                docs.append(np.frombuffer(data, kind))
        if docs:
            yield from one(at, keys, docs)

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return sorted_rows.mapInArrow(
        run, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
