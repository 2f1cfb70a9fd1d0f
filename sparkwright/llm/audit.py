"""Filter interaction audit: exact Shapley values by constrained least squares.

Five filters are applied to whole texts.  A document's failures are a mask of
five bits, so everything about the filters' interaction follows from 32
numbers per part of the corpus: ``v(S)``, the documents that a set ``S`` of
filters (a coalition) removes.

The Shapley values are the minimum of the kernel-weighted squares
``sum_S w(|S|) (v(S) - sum_{i in S} x_i)^2`` over all coalitions but the empty
and the full one, under the efficiency constraint ``sum_i x_i = v(all)``.  The
normal equations with the constraint's multiplier are solved in rationals, so
the values are exact; times the number of orders they are whole numbers (what
a filter removes, summed over all orders).

Step counts are differences of coalitions: in an order, the filter after the
set ``S`` removes ``v(S + i) - v(S)``, and likewise for good and toxic losses.

Failure conditions (words are maximal runs of ``[^\\x20\\x09-\\x0D]``): A under
100 words; B 100 * distinct words < 80 * words; C 100 * ``[A-Z]`` characters >
10 * code points; D holds any of ``[#$%&*|]``; E the text is that of a row with
a smaller ``doc_id``, in the whole table, removed or not.

Scale: one pass over the texts gives a row of mask, digest (sha256) and part;
these are counted before each shuffle.  The smallest id of a text is found
among its counts, of which there are at most four per part and text, so copies of
one text never meet in one task as rows.  32 numbers per part go on to the
solver, a part per row.

Defined results: a null text is empty (and a copy of other empty ones); a null
part is the empty string; a row without an id never fails E and makes no other
row fail it; repeated rows count each, and rows of one id are no copies of each
other; a document is good or toxic if any label row of its id says so; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import cache
from hashlib import sha256
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import make_importable

FILTERS = "ABCDE"
MIN_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
CAPITALS, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: Bit of the filter that looks at other rows.
COPY = 1 << FILTERS.index("E")


def failures(data: bytes, characters: int) -> int:
    """Mask of the filters A to D that a UTF-8 text fails."""
    words = data.split()  # on bytes: ASCII white space only
    capitals = len(data) - len(data.translate(None, CAPITALS))
    tests = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * characters,
        len(data.translate(None, MARKS)) < len(data),
    )
    return sum(1 << k for k, failed in enumerate(tests) if failed)


def judge(documents: DataFrame, part: str = "lang") -> DataFrame:
    """``doc_id, part, failed, digest`` per row; ``failed`` without E."""
    make_importable(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                texts = [t or "" for t in some.column(2).to_pylist()]
                data = [t.encode() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        some.column(1),
                        pa.array([failures(d, len(t)) for d, t in zip(data, texts)], pa.int32()),
                        pa.array([sha256(d).digest() for d in data], pa.binary()),
                    ],
                    ["doc_id", "part", "failed", "digest"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    own = documents.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    return own.mapInArrow(run, f"doc_id {kind}, part string, failed int, digest binary")


def failure_table(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, failed, n, good, toxic``: documents by the filters they fail,
    32 rows per part at most."""
    rows = judge(documents, part).groupBy("part", "failed", "digest", "doc_id").agg(F.count("*").alias("n"))
    marks = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marked = rows.join(marks.where("good OR toxic"), "doc_id", "left")
    no = F.lit(False)
    kinds = ["part", "failed", "digest", "good", "toxic"]
    counted = marked.withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}).groupBy(kinds).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low"),
    )
    first = F.min("low.doc_id").over(Window.partitionBy("digest"))
    originals = F.col("without_id") + F.when(F.col("low.doc_id") == first, F.col("low.n")).otherwise(0)
    split = counted.withColumn("originals", originals)
    both = F.array(
        F.struct(F.col("failed"), F.col("originals").alias("n")),
        F.struct(F.col("failed").bitwiseOR(COPY).alias("failed"), (F.col("n") - F.col("originals")).alias("n")),
    )
    flat = split.select("part", "good", "toxic", F.inline(both))
    return flat.groupBy("part", "failed").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


# -- coalitions -----------------------------------------------------------


def removed_by(counts: list[int]) -> list[int]:
    """``v``: per coalition (a mask) the documents whose failures meet it."""
    return [sum(n for failed, n in enumerate(counts) if failed & s) for s in range(len(counts))]


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Exact solution of a regular linear system."""
    n = len(right)
    rows = [[*r, b] for r, b in zip(matrix, right)]
    for k in range(n):
        pivot = next(i for i in range(k, n) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(n):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k])]
    return [r[n] for r in rows]


@cache
def kernel(m: int) -> list[tuple[int, Fraction]]:
    """Coalitions of ``m`` players, but for none and all, with their weights."""
    sizes = {s: s.bit_count() for s in range(1, (1 << m) - 1)}
    return [(s, Fraction(m - 1, comb(m, k) * k * (m - k))) for s, k in sizes.items()]


def shapley(v: list[int]) -> list[Fraction]:
    """Shapley values of the game ``v`` (by coalition mask)."""
    m = len(v).bit_length() - 1
    # normal equations, with the multiplier of the efficiency constraint last
    matrix = [[Fraction(0)] * (m + 1) for _ in range(m + 1)]
    right = [Fraction(0)] * m + [Fraction(v[-1] - v[0])]
    for s, weight in kernel(m):
        inside = [i for i in range(m) if s >> i & 1]
        for i in inside:
            right[i] += weight * (v[s] - v[0])
            for j in inside:
                matrix[i][j] += weight
    for i in range(m):
        matrix[i][m] = matrix[m][i] = Fraction(1)
    return solve(matrix, right)[:m]


COLUMNS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def steps(n: list[int], good: list[int], toxic: list[int]) -> Iterator[tuple]:
    """``filter_order, step`` and ``COLUMNS`` for every order of the filters,
    from documents by failure mask."""
    m = len(FILTERS)
    everyone, whole = sum(n), (1 << m) - 1
    v, g, t = removed_by(n), removed_by(good), removed_by(toxic)
    in_orders = [int(x * factorial(m)) for x in shapley(v)]
    for order in permutations(range(m)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = v[after] - v[before]
            alone = v[whole] - v[whole ^ 1 << i]
            yield (
                "".join(FILTERS[k] for k in order), step,
                everyone - v[after], removed, v[1 << i] - removed, alone, g[after] - g[before], t[after] - t[before], in_orders[i],
            )
            before = after


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, filter_order, step`` and ``COLUMNS``: a row per part, order of
    the filters and step."""
    failed = failure_table(documents, labels, part)
    tables = failed.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("rows"))
    names = ["part", "filter_order", "step", *COLUMNS]
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(COLUMNS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = {k: [0] * (1 << len(FILTERS)) for k in ("n", "good", "toxic")}
                for row in rows:
                    for k, table in counts.items():
                        table[row["failed"]] += row[k]
                found = [(name, *r) for r in steps(**counts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    make_importable(documents.sparkSession)
    return tables.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS))
