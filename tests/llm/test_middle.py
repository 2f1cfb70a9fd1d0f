"""Fill-in-middle: token boundaries against a token list, exact round trip."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkwright.llm import middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
ODD = [None, "", "a", "Z", "é", "\n", "ab", "a b", "é日😀x", "abcdefgh", "abcdefgh ", "abcdefghi\0j", "zé" * 9, "@[`{", "AZaz" * 30, "\0\0\0"]


def slow(doc_id, text):
    """The same by a token list."""
    text = text or ""
    units = UNIT.findall(text)
    h1, h2, h3, h4 = middle.draws(doc_id, "1")
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abzAZ@[`{ \0\n\x7f\x80é߿ࠀ￿𐀀😀"))
def test_boundaries_equal_token_list(text):
    data = text.encode()
    units = middle.Units(data)
    tokens = UNIT.findall(text)
    assert len(units) == len(tokens)
    at = 0
    for k, token in enumerate(["", *tokens]):
        at += len(token.encode())
        assert units.end_of(k) == at


def test_every_byte_pair():
    for a in range(128):
        for b in range(128):
            text = chr(a) + chr(b)
            assert len(middle.Units(text.encode())) == len(UNIT.findall(text)), text


def test_select_in_word():
    for marks in range(1, 256):
        word = sum(0x80 << 8 * k for k in range(8) if marks >> k & 1)
        places = [k for k in range(8) if marks >> k & 1]
        assert [middle.select_in_word(word, r + 1) for r in range(len(places))] == places


def test_transform_equals_token_list():
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab <P>SMé😀\n") for _ in range(rng.randrange(200))) for _ in range(2000)]
    for i, text in enumerate(texts):
        assert middle.transform(i, text, "1", 10, 20) == slow(i, text)


def test_draws_are_the_hash():
    from hashlib import sha256

    groups = re.findall("." * 8, sha256(b"1:77").hexdigest())
    assert middle.draws(77, "1") == [int(g, 16) for g in groups[:4]]


def test_round_trip_and_odd_rows(spark):
    from pyspark.sql import functions as F

    texts = [*ODD, "<P>", "a<S>b", "<M", "<<P", "P>" * 20, "< P>", "word " * 20000]
    rows = [(i, t, "x", 5, "f") for i, t in enumerate(texts * 4)] + [(None, "a b c", "x", 5, "f"), (0, "q", None, None, None), (0, "q", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, n int, form string")
    done = middle.fill_in_middle(df).withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(done) == len(rows)
    key = lambda i, t: (i is None, i or 0, t)
    assert sorted(key(r["doc_id"], r["back"]) for r in done) == sorted(key(i, t or "") for i, t, *_ in rows)
    assert {r["form"] for r in done} == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(df.where("false")).count() == 0


def test_rates(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "'some words here' AS text")
    forms = {r["form"]: r["count"] for r in middle.fill_in_middle(df).groupBy("form").count().collect()}
    assert forms["plain"] == pytest.approx(300, abs=60) and forms["spm"] == pytest.approx(540, abs=80)
    other = {r["form"]: r["count"] for r in middle.fill_in_middle(df, plain_percent=0, spm_percent=100).groupBy("form").count().collect()}
    assert other == {"spm": 3000}
