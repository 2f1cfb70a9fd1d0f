"""Packing: every id once, full windows, neighbours by BM25."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkwright.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def check_layout(pieces, lengths, window):
    """Every id of every document once; sequences gapless, full or a power of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset in pieces:
        assert length > 0
        by_doc[doc].append((start, length))
        by_sequence[sequence].append((offset, length))
    assert sorted(by_doc) == list(range(len(lengths)))
    for doc, parts in by_doc.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == lengths[doc]
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and at.bit_count() == 1
    return by_sequence


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=30), st.randoms(use_true_random=False))
def test_fill_holds_every_id_once(lengths, rng):
    def neighbours(doc, unused):
        some = [int(d) for d in np.flatnonzero(unused) if rng.random() < 0.5]
        rng.shuffle(some)
        return np.array(some, "i8")

    sequences = check_layout(packing.fill(np.array(lengths), neighbours, 16), lengths, 16)
    full = sum(sum(n for _, n in parts) == 16 for parts in sequences.values())
    assert full == sum(lengths) // 16


def test_fill_prefers_what_fits_then_cuts_the_best():
    # seed 0 (10 of 16): 1 is too long, 2 and 3 fit; then 1 is cut and goes on as the next seed
    order = np.array([1, 2, 3])
    pieces = packing.fill(np.array([10, 9, 3, 2]), lambda doc, unused: order[unused[order]], 16)
    assert pieces == [(0, 0, 10, 0, 0), (2, 0, 3, 0, 10), (3, 0, 2, 0, 13), (1, 0, 1, 0, 15), (1, 1, 8, 1, 0)]


def test_powers_of_two():
    pieces = [(0, 0, 16, 0, 0), (1, 0, 7, 1, 0), (2, 0, 4, 1, 7)]
    assert packing.powers_of_two(pieces, 11) == [
        (0, 0, 16, 0, 0), (1, 0, 7, 1, 0), (2, 0, 1, 1, 7), (2, 1, 2, 2, 0), (2, 3, 1, 3, 0),
    ]


def bm25(docs, idf, mean_length, seed, query_terms):
    """Scores of all documents for a seed, term by term."""

    def weight(term, doc):
        tf = docs[doc].tolist().count(term)
        bound = packing.K1 * (1 - packing.B + packing.B * len(docs[doc]) / mean_length)
        return idf[term] * tf * (packing.K1 + 1) / (tf + bound)

    terms = sorted(set(docs[seed].tolist()), key=lambda t: (-weight(t, seed), t))[:query_terms]
    return [sum(weight(t, d) for t in terms) for d in range(len(docs))]


def test_neighbours_equal_brute_force():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 40, rng.integers(1, 30)).astype("<u2") for _ in range(60)]
    idf = rng.random(40) + 0.1
    index = packing.Index(docs, idf, 15.0)
    for seed in range(0, 60, 7):
        unused = rng.random(60) < 0.7
        scores = bm25(docs, idf, 15.0, seed, 6)
        expected = sorted((d for d in range(60) if unused[d] and scores[d] > 0), key=lambda d: -scores[d])
        found = index.neighbours(seed, unused, 6).tolist()
        assert sorted(found) == sorted(expected)
        assert [round(scores[d], 9) for d in found] == [round(scores[d], 9) for d in expected]


def test_shard_plan_splits_and_joins():
    plan = packing.shard_plan({1: 5, 2: 6, 3: 35, 4: 1, 5: 9, 6: 30}, 10)
    assert plan == [(1, 0, 1), (2, 0, 1), (3, 1, 4), (4, 5, 1), (5, 5, 1), (6, 6, 3)]
    assert packing.shard_plan({}, 10) == []


def ids_of(library, text, end=2):
    return [*library.encode(text or "", add_special_tokens=False).ids, end]


def check_pieces(pieces, documents, library, window=4096):
    """``pieces`` as op11 returns them against the library's ids of each row."""
    wanted = {i: ids_of(library, t) for i, t in documents}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = wanted[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert len(ids) == p["length"] and p["doc_tokens"] == len(wanted[p["doc_id"]])
        assert p["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        by_doc[p["doc_id"]].append((p["start"], p["length"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(wanted)
    for doc, parts in by_doc.items():
        assert sum(n for _, n in parts) == len(wanted[doc])
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:]))
    for parts in by_sequence.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:])) and min(parts)[0] == 0
        assert sum(n for _, n in parts) <= window
    return [sum(n for _, n in parts) for parts in by_sequence.values()]


def test_op11_against_the_library(spark, sf_dir, library):
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sizes = check_pieces(queries.op11_packing(spark, sf_dir).collect(), documents, library)
    assert all(n.bit_count() == 1 for n in sizes)  # no padding at all
    assert sum(n == 4096 for n in sizes) == sum(sizes) // 4096


def test_many_shards_and_a_hot_group(spark, library):
    texts = [(i, "the same long passage of a large group of copies") for i in range(300)]
    texts += [(1000 + i, f"document {i} about topic{i % 7} and topic{i % 11}") for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    pieces = packing.pack(df, PATH, 2, window=64, shard_tokens=500).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(pieces, texts, library, 64)
    per_shard = defaultdict(int)
    for p in pieces:
        per_shard[p["sequence_id"] >> 32] += p["length"]
    assert len(per_shard) > 10 and max(per_shard.values()) < 1500


def test_neighbours_share_a_window(spark):
    texts = [(t * 100 + i, f"{word} " * 20) for i in range(10) for t, word in enumerate(("zebra", "violin", "glacier"))]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    pieces = packing.pack(df, PATH, 2, window=128).collect()
    topics = defaultdict(set)
    for p in pieces:
        topics[p["sequence_id"]].add(p["doc_id"] // 100)
    assert sum(len(t) == 1 for t in topics.values()) >= len(topics) - 3


def test_odd_rows(spark, library):
    schema = "doc_id long, text string, ids int, term string, row int, shard int, n string, start int"
    texts = [(None, "a b"), (1, None), (1, ""), (2, "x y " * 9000), (3, "A b"), (3, "A b")]
    df = spark.createDataFrame([(i, t, 1, "t", 2, 3, "n", 4) for i, t in texts], schema)
    pieces = packing.pack(df, PATH, 2).collect()
    wanted = sum(len(ids_of(library, t)) for _, t in texts)
    assert sum(p["length"] for p in pieces) == wanted
    assert {p["doc_id"] for p in pieces} == {None, 1, 2, 3}
    assert sum(p["length"] for p in pieces if p["doc_id"] == 1) == 2  # an end id each
    assert sum(p["length"] for p in pieces if p["doc_id"] == 3) == 2 * len(ids_of(library, "A b"))
    empty = packing.pack(df.where("false"), PATH, 2)
    assert empty.count() == 0
