"""BPE automaton and token files against the tokenizers library."""

import hashlib
import itertools
import json
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkwright.llm import bpe, queries, token_files, words
from sparkwright.llm.storage import shared_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\t", "a", "Hello World's 12 é x", "'s't 're I'LL", "a<|endoftext|> B<|ENDOFTEXT|><|startoftext|>",
    "ΑΣ ΣΑΣ", "İstanbul ǅ", "é ́x", "日本語 text १२ ٣", "a\x1cb\x1fc\x85d\xa0e", "<b>", "\\", "aaaaaaaaaaaaaaaa" * 50,
    "x" * 5000 + "ab" * 3000, "😀😀 ͸࢏ z", "﻿abc​def", "!!!???...", "1234567890" * 20, "a\0b",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_automaton_equals_library(library):
    a = bpe.Automaton(bpe.read_spec(PATH))
    rng = random.Random(5)
    texts = [t or "" for t in ODD]
    texts += ["".join(rng.choice("abcdeinorst ' .é") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(chr(rng.randrange(1, 0x3000)) for _ in range(20)) for _ in range(500)]
    labels = [s.removesuffix("</w>") for s in list(a.ids)[512::37]]
    texts += [x + y for x, y in zip(labels, reversed(labels))]
    for t in texts:
        ids, decoded = expected(library, t)
        assert a.encode(t) == ids, t
        assert a.decode(ids) == decoded


def test_arc_table_may_start_anew(monkeypatch, library):
    monkeypatch.setattr(bpe, "ARC_ENTRIES", 3)
    a = bpe.Automaton(bpe.read_spec(PATH))
    for t in ("international nationality", "thorough thought"):
        assert a.encode(t) == expected(library, t)[0]


def test_tables_are_compiled_whole():
    t = bpe.compile_tables(bpe.read_spec(PATH))
    made = t.rank >= 0
    # one removed arc per gadget, that of its own state and label
    assert sorted(t.removed) == sorted(t.left[made].astype("i8") * len(t.rank) + t.right[made])
    assert len(set(t.edges.tolist())) == len(t.edges) and (np.sort(t.to) == np.arange(1, len(t.back))).all()
    assert (t.length[t.left[made]] + t.length[t.right[made]] == t.length[made]).all()
    assert sum(x.nbytes for x in t) < 5e6


def naive_bpe(word, merges):
    """The merges in order, each on all its pairs from the left."""
    for u, v in merges:
        out = []
        for s in word:
            if out and out[-1] == u and s == v:
                out[-1] = u + v
            else:
                out.append(s)
        word = out
    return word


def small_spec(rng):
    letters = list("abc")
    vocab, merges = [*letters, *(c + "</w>" for c in letters)], []
    while len(merges) < 12:
        u = rng.choice([x for x in vocab if not x.endswith("</w>")])
        v = rng.choice(vocab)
        if u + v not in vocab:
            merges.append((u, v))
            vocab.append(u + v)
    split = {"type": "Split", "pattern": {"Regex": r"\w+"}}
    conf = {
        "model": {"type": "BPE", "vocab": {x: i for i, x in enumerate(vocab)}, "merges": [f"{u} {v}" for u, v in merges], "end_of_word_suffix": "</w>"},
        "added_tokens": [], "pre_tokenizer": {"pretokenizers": [split]},
    }
    return json.dumps(conf), vocab, merges


def test_automaton_accepts_what_merging_gives():
    rng = random.Random(3)
    for _ in range(60):
        spec, vocab, merges = small_spec(rng)
        a = bpe.Automaton(spec)
        for n in range(1, 8):
            for word in itertools.product("abc", repeat=n):
                want = naive_bpe([*word[:-1], word[-1] + "</w>"], merges)
                assert [vocab[i] for i in a.encode_word("".join(word).encode())] == want, (word, merges)


def test_words_after_one_another(library):
    a = bpe.Automaton(bpe.read_spec(PATH))
    words_ = ["national", "nationality", "nation", "nation", "n", "", "nationwide", "zebra", "national"]
    ids, numbers = a.encode_words([w.encode() for w in words_])
    want = [expected(library, w)[0] for w in words_]
    assert numbers == [len(w) for w in want] and list(ids) == sum(want, [])


def test_long_word_takes_linear_time(library):
    a = bpe.Automaton(bpe.read_spec(PATH))
    rng = random.Random(1)
    long = "".join(rng.choice("abcdeinorst") for _ in range(1_000_000))
    assert a.encode_word(long.encode()) == expected(library, long)[0]
    seconds = []
    for n in (250_000, 1_000_000):
        at = time.process_time()
        a.encode_word(long[:n].encode())
        seconds.append(time.process_time() - at)
    assert seconds[1] < 10 * seconds[0]


def test_small_word_cache():
    asked = []
    cache = words.WordCache(lambda w: asked.append(w) or f"<{w}>", lambda w: f"[{w}]", lambda a, b: a + b, 4)
    assert cache.many(["a", "b", "A", "b,", "c3", "Σ"]) == ["<a>", "<b>", "<a>", "<b>[,]", "[c3]", "[Σ]"]
    assert asked == ["a", "b"]
    assert cache.many(["d", "a"]) == ["<d>", "<a>"] and len(cache) <= 5
    assert cache.many(["x" * 100]) == [f"<{'x' * 100}>"] and "x" * 100 not in cache
    assert cache.many([".", "é́", "İ", "e\u0301", "a.."]) == ["[.]", "[é́]", "[İ]", "[e\u0301]", "<a>[..]"]


def odd_documents(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "null id", "x"), (3, "twice", "y"), (3, "twice", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_op6_whole_table(spark, sf_dir, library):
    got = {r.doc_id: r for r in queries.op6_bpe(spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for r in texts:
        ids, decoded = expected(library, r.text)
        row = got[r.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encode_decode_odd_rows(spark, library):
    df = odd_documents(spark)
    got = bpe.encode_decode(df, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    rows = got.collect()
    want = sorted((str(r.doc_id), *expected(library, r.text)) for r in df.collect())
    assert sorted((str(r.doc_id), [int(i) for i in r.ids.split()], r.decoded) for r in rows) == want
    assert bpe.encode_decode(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 50, n).astype("<u4")
    ids[rng.random(n) < 0.05] = 4_000_000_000
    docs = np.array([(1, -5, n // 3), (0, 0, 0), (1, 1 << 62, n - n // 3)], token_files._DOC)
    seg = token_files.Segment(token_files.pack(ids, docs))
    assert (seg.ids() == ids).all() and (seg.docs == docs).all()
    assert (seg.document(0) == ids[: n // 3]).all() and (seg.document(2) == ids[n // 3 :]).all()
    assert len(seg.document(1)) == 0
    if n == 5000:
        assert seg.width.max() <= 6 and seg.n_out.sum() > 0  # outliers do not widen the blocks


def brute_files(rows, library):
    start, out = 0, []
    coded = [(d, np.array(expected(library, t)[0] + [1], "<u4").tobytes()) for d, t in rows]
    for d, b in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        out.append((d, start, len(b) // 4, zlib.crc32(b)))
        start += len(b) // 4
    return out


def test_op10_whole_table(spark, sf_dir, library):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op10_token_files(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(brute_files(texts, library))


def test_files_odd_rows(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    df = odd_documents(spark)
    path = token_files.write_documents(df, PATH, 1, shared_folder(spark))
    got = token_files.read_documents(spark, path).collect()
    want = brute_files([(r.doc_id, r.text) for r in df.collect()], library)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    empty = token_files.write_documents(df.limit(0), PATH, 1, shared_folder(spark))
    assert token_files.read_documents(spark, empty).count() == 0


def test_unfit_tokenizer_is_refused(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        token_files.encode_ids(df, public_tokenizers.path("byte_bpe_50k.json"), 1)
    with pytest.raises(ValueError):
        bpe.Automaton(bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json")))
