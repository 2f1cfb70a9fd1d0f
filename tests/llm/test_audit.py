"""Filter audit: Shapley values against all orders, rows against a simulation."""

import random
import re
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest

from sparkwright.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_orders(v):
    """Shapley values by their definition."""
    m = len(v).bit_length() - 1
    total = [0] * m
    for order in permutations(range(m)):
        s = 0
        for i in order:
            total[i] += v[s | 1 << i] - v[s]
            s |= 1 << i
    return [Fraction(t, factorial(m)) for t in total]


def test_least_squares_give_shapley_values():
    rng = random.Random(1)
    for m in (2, 3, 5):
        for _ in range(20):
            v = [rng.randrange(1000) for _ in range(1 << m)]
            assert audit.shapley(v) == by_orders(v)
    assert audit.shapley([0] * 32) == [0] * 5


def test_solve_needs_pivots():
    one = Fraction(1)
    assert audit.solve([[0 * one, one], [2 * one, one]], [3 * one, 7 * one]) == [2, 3]


def failing(text, others):
    text = text or ""
    words = WORD.findall(text)
    tests = {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
        "E": others,
    }
    return {f for f, failed in tests.items() if failed}


@pytest.mark.parametrize("text", [None, "", "a", "A", "a\x0bb\x1cc\x85d", "É" * 9 + "E", "x " * 99, "w%", "AB cdefghijklmnopqr", "AB cdefghijklmnopqrst"])
def test_failures(text):
    text = text or ""
    mask = audit.failures(text.encode(), len(text))
    assert {f for k, f in enumerate("ABCDE") if mask >> k & 1} == failing(text, False)


def simulate(rows, labels):
    """All orders, one document after another."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    fails = []
    for i, text, lang in rows:
        copy = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in rows)
        fails.append((lang or "", failing(text, copy), i in good, i in toxic))
    out, total = {}, {}
    for part in {f[0] for f in fails}:
        for order in permutations("ABCDE"):
            left = [f for f in fails if f[0] == part]
            for step, name in enumerate(order, 1):
                gone = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                all_failing = sum(f[0] == part and name in f[1] for f in fails)
                only = sum(f[0] == part and f[1] == {name} for f in fails)
                key = part, "".join(order), step
                out[key] = [len(left), len(gone), all_failing - len(gone), only, sum(f[2] for f in gone), sum(f[3] for f in gone)]
                total[part, name] = total.get((part, name), 0) + len(gone)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_simulation(spark):
    rng = random.Random(4)
    long = " ".join(f"w{k}" for k in range(120))
    texts = [None, "", "short", "SHOUT", "a # b", long, long + " %", "w " * 150, long.upper(), "W & " * 80]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(120)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    docs = spark.createDataFrame([(*r, "x", 1, b"y") for r in rows], "doc_id long, text string, lang string, part string, n int, digest binary")
    df = audit.audit(docs, spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, good int"))
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in audit.COLUMNS) for r in df.collect()}
    assert found == simulate(rows, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(docs.where("false"), labels).count() == 0
    rows = audit.audit(docs, labels).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""}
    assert {r["removed"] for r in rows if r["step"] == 1 and r["filter_order"][0] == "A"} == {1}


def test_copies_of_one_text_are_counted_before_they_meet(spark):
    """A large group of copies: at most a row per part, labels and failures."""
    docs = spark.range(5000).selectExpr("id AS doc_id", "'the same' AS text", "'en' AS lang")
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    table = audit.failure_table(docs, labels).collect()
    assert sorted((r["failed"], r["n"], r["good"]) for r in table) == [(1, 1, 1), (1 | audit.COPY, 4999, 0)]
