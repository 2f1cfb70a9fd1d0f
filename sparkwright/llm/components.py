"""Connected components of a table of links, by local contraction and
alternating star operations.

First each task replaces its links by stars (``contract``): the links are dealt
to tasks of about ``LINKS_PER_TASK``, and a task links each of its nodes to the
smallest one that its own links reach.  If one task holds all links, that is
the result.  Otherwise star operations follow.  Large star: every node links
its larger neighbours to the smallest node around it.  Small star: every node
links its smaller neighbours to the smallest.  Repeated until nothing changes,
each component is a star around its smallest node.  Links stay in Spark; each round is written to the shared folder, and the
driver sees one count and one checksum.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import make_importable, settle

LINKS_PER_TASK = 200_000


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``a, b`` of one task to links of each node with the smallest node
    of its part."""
    parent: dict = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(up, up)  # halves the path
            x = parent[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    stars = [(x, r) for x in list(parent) if (r := root(x)) != x]
    for at in range(0, len(stars), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c in zip(*stars[at : at + 10_000])], ["a", "b"])


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct ``a > b`` pairs."""
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lows = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    moved = both.join(lows, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    lows = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(lows, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(lows.select("a", F.col("low").alias("b"))).distinct()


def _sum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``node, component`` for every node with a link in ``a, b`` (any ordered
    type); ``component`` is the smallest node reachable."""
    make_importable(links.sparkSession)
    stars = settle(_ordered(links))
    kind = stars.schema["a"].dataType.simpleString()
    tasks = -(-stars.count() // LINKS_PER_TASK)
    stars = settle(stars.coalesce(max(1, tasks)).mapInArrow(contract, f"a {kind}, b {kind}"))
    before = _sum(stars) if tasks > 1 else (0,)
    for _ in range(rounds):
        if not before[0]:
            break
        stars = settle(_small_star(_large_star(stars)))
        after = _sum(stars)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
