"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds its distinct shingles of five words (64-bit hashes); a
document of fewer words has its whole sequence as one.  Documents are linked
if the Jaccard similarity of their sets is ``LEAST`` or more, and a group is a
connected component of links.

1. One pass hashes each set to a class (128 bits of the whole set), a sketch
   (the low bytes of ``WIDTH`` minwise tokens) and its paths.  Equal sets are
   one class from here on, so exact copies cost one row however many they are.
2. Chosen paths: each of ``TREES`` independent trees starts at its root; a node
   picks one or two of the minwise tokens (4/3 on average, the inverse of the
   threshold, as a function of the node alone) and a document goes on to one
   child per picked token, named by the token's value.  Similar sets share a
   path with a probability that falls only slowly with the depth, others soon
   part.  ``recall_of_pair`` gives the recall of the trees for a similarity.
3. Nodes of ``NODE`` documents or fewer are compared exhaustively on sketches.
   In larger ones all documents are first compared with one of them (the
   pivot), and those close to it leave, which loses nothing: the distance of
   sketches is a metric, so whatever is near them is linked to the pivot by the
   wider bound.  All others within the wider bound are linked to the pivot, so
   only pairs with a document beyond it (far) are still to be found.  A node
   with no far documents is done; up to ``NODE`` far ones are compared with all
   of the node, chunk by chunk; more branch further, from ``FIRST_DEPTH`` in
   ``REPEATS`` independent subtrees, so that the recall holds at any depth.
   Nodes still large at ``DEPTH`` are compared in all pairs of chunks.  A node reports a spanning forest of its pairs, not
   all pairs.
4. Components of these candidate pairs are families.  A family's full sets are
   made anew from the texts and compared exactly; a family of more than
   ``FAMILY`` shingles is dealt out in all pairs of chunks.  Each comparison
   reports a spanning forest of the true links.
5. Components of the true links, and the smallest ``doc_id`` of each.

Scale: texts are read in place twice; only members of families have their
sets shuffled, once.  Tables keyed by document stay in Spark.  A family's
members' ids are broadcast under ``BROADCAST_ROWS`` (counted), else joined by
shuffle.  Node and family tasks are bounded by ``NODE`` and ``FAMILY``.

Defined results: a null text or one without words has an empty set and is
linked with nothing; null ids take part, but a component's id is the smallest
id that is not null (null if there is none), and a null id is kept only there;
rows of equal id are kept or dropped alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import make_importable, settle

SHINGLE, LEAST = 5, (75, 100)
TREES, WIDTH, FIRST_DEPTH, DEPTH = 10, 128, 3, 24
#: Sketch agreements: candidates (4 standard deviations below 0.75), and
#: documents so close to a pivot that they leave a large node.
NEAR, CLOSE = 76, 115
WIDE = NEAR + CLOSE - WIDTH
NODE, FAMILY = 1000, 4_000_000
#: Subtrees of a branching first node: keeps ``recall_of_pair`` at ``DEPTH``.
REPEATS = 15
BROADCAST_ROWS = 1_000_000

_RNG = np.random.default_rng(20240229)
_STEP = _RNG.integers(0, 1 << 63, SHINGLE, "u8") * np.uint64(2) + np.uint64(1)
_TIMES = _RNG.integers(0, 1 << 31, WIDTH, "u4") * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, WIDTH, "u4")
_ROOTS = _RNG.integers(0, 1 << 63, TREES, "u8")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingles."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, "u8")
    hashed = np.array(list(map(xxhash.xxh3_64_intdigest, words)), "u8")
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, "u8")
    for k in range(size):
        total += hashed[k : k + n] * _STEP[k]
    return np.unique(_mix(total))


def minwise(shingles: np.ndarray) -> np.ndarray:
    """``WIDTH`` minwise tokens of a set that is not empty."""
    x = (shingles >> np.uint64(32)).astype("u4")
    low = None
    for at in range(0, len(x), 2048):
        part = (x[at : at + 2048] * _TIMES[:, None] + _PLUS[:, None]).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return low


def children(keys: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level down: the rows' indices and child nodes.  ``tokens`` has the
    minwise tokens of each row's document."""
    drawn = _mix(keys)
    out, rows = [], np.arange(len(keys))
    for nth in range(2):
        if nth:  # a second child for a third of the nodes
            rows = np.flatnonzero(drawn % np.uint64(3) == 0)
        place = ((drawn[rows] >> np.uint64(8 + 16 * nth)) % np.uint64(WIDTH)).astype("i8")
        value = tokens[rows, place].astype("u8")
        out.append((rows, _mix(keys[rows] + np.uint64(nth + 1) * _STEP[0] + value * _STEP[1] + place.astype("u8") * _STEP[2])))
    return np.concatenate([r for r, _ in out]), np.concatenate([c for _, c in out])


def recall_of_pair(similarity: float, trees: int = TREES, depth: int = FIRST_DEPTH) -> float:
    """Chance that a pair meets in some node at ``depth``."""
    lost = 0.0
    for below in range(depth):
        if below and below == depth - FIRST_DEPTH:
            lost **= REPEATS
        one = 1 - similarity + similarity * lost
        lost = one * 2 / 3 + one**2 / 3
    return 1 - lost**trees


def paths(tokens: np.ndarray) -> list[np.ndarray]:
    """Per row of ``tokens`` its nodes at ``FIRST_DEPTH``, over all trees."""
    docs = np.repeat(np.arange(len(tokens)), TREES)
    keys = np.tile(_ROOTS, len(tokens))
    for _ in range(FIRST_DEPTH):
        rows, keys = children(keys, tokens[docs])
        docs = docs[rows]
    order = np.argsort(docs, kind="stable")
    cuts = np.searchsorted(docs[order], np.arange(1, len(tokens)))
    return [np.unique(k) for k in np.split(keys[order], cuts)]


def _class_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def describe(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, cls, sketch, nodes``; the last three null for an
    empty set."""
    make_importable(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t) for t in part.column(1).to_pylist()]
                full = [k for k, s in enumerate(sets) if len(s)]
                tokens = np.array([minwise(sets[k]) for k in full], "u4").reshape(len(full), WIDTH)
                cls, sketch, nodes = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                for k, t, p in zip(full, tokens, paths(tokens) if full else []):
                    cls[k], sketch[k], nodes[k] = _class_of(sets[k]), t.astype("u1").tobytes(), p.view("i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(list(map(len, sets)), pa.int64()),
                        pa.array(cls, pa.binary()),
                        pa.array(sketch, pa.binary()),
                        pa.array(nodes, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "cls", "sketch", "nodes"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, cls binary, sketch binary, nodes array<long>"
    )


# -- comparison within groups ----------------------------------------------


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of equal first column from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for begin, end in zip(cuts, cuts[1:]):
            if held and held[0].column(0)[0].as_py() != key[begin]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def _forest(n: int, near) -> list[tuple[int, int]]:
    """Spanning forest of the graph in which ``near(i, others)`` says which of
    the others are linked with i."""
    out, left = [], np.arange(n)
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = near(i, left)
            found = left[hit].tolist()
            out += [(i, j) for j in found]
            queue += found
            left = left[~hit]
    return out


def _pairs(cls: list[bytes], forest: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([cls[i] for i, _ in forest], pa.binary()), pa.array([cls[j] for _, j in forest], pa.binary())], ["a", "b"]
    )


def _sketches(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "u1").reshape(-1, WIDTH)


def _compare_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``key, cls, sketch`` to candidate pairs ``a, b``."""
    found: list[tuple[bytes, bytes]] = []
    for group in _groups(batches):
        cls, sketch = group["cls"].to_pylist(), _sketches(group["sketch"])
        near = lambda i, others: (sketch[others] == sketch[i]).sum(axis=1) >= NEAR  # noqa: B023, E731
        found += [(cls[i], cls[j]) for i, j in _forest(len(cls), near)]
        if len(found) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*set(found))], ["a", "b"])
            found = []
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*set(found))], ["a", "b"])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, cls, sketch, pivot, pivot_sketch`` of large nodes to ``key, cls,
    pivot, agree``."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        agree = (_sketches(table["sketch"]) == _sketches(table["pivot_sketch"])).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("cls"), batch.column("pivot"), pa.array(agree, pa.int64())],
            ["key", "cls", "pivot", "agree"],
        )


def _descend(repeats: int):
    """``key, cls, sketch`` to the children ``key, cls``, in ``repeats``
    independent subtrees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = pa.Table.from_batches([batch.slice(at, 1024)])
                keys, sketch = part["key"].to_numpy().view("u8"), _sketches(part["sketch"])
                for nth in range(repeats):
                    rows, down = children(_mix(keys + np.uint64(nth) * _STEP[3]) if nth else keys, sketch)
                    cls = part["cls"].combine_chunks().take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(down.view("i8")), cls], ["key", "cls"])

    return run


def _with_far(rows: DataFrame) -> DataFrame:
    """Deal ``key, cls, agree, m`` of nodes with few far documents out in
    chunks, the far ones to each chunk."""
    chunks = F.ceil(F.col("m") / NODE).cast("long")
    own = F.array(F.pmod(F.xxhash64("cls", F.lit(7)), chunks))
    each = F.explode(F.when(F.col("agree") < WIDE, F.sequence(F.lit(0).cast("long"), chunks - 1)).otherwise(own))
    return rows.withColumn("_chunk", each).select(F.xxhash64("key", "_chunk").alias("key"), "cls")


def _chunk_pairs(df: DataFrame, key: str, chunks: str, cls: str) -> DataFrame:
    """Deal each group out in all pairs of its ``chunks``: every row goes to
    the pairs of its chunk with each chunk, under a new ``key``."""
    own = F.pmod(F.xxhash64(F.col(cls), F.lit(7)), F.col(chunks))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(chunks) - 1))
    dealt = df.withColumn("_own", own).withColumn("_other", other)
    pair = F.xxhash64(F.col(key), F.least("_own", "_other"), F.greatest("_own", "_other"))
    return dealt.withColumn(key, F.when(F.col(chunks) == 1, F.col(key)).otherwise(pair)).drop("_own", "_other")


def _by_group(df: DataFrame, key: str, run, schema: str) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key).sortWithinPartitions(key).mapInArrow(run, schema)


def candidates(classes: DataFrame) -> DataFrame:
    """Candidate pairs ``a, b`` of ``cls, sketch, nodes`` that keep families
    connected."""
    sketches = classes.select("cls", "sketch")
    level = classes.select(F.explode("nodes").alias("key"), "cls")
    found, leaves = [], []
    for depth in range(FIRST_DEPTH, DEPTH + 1):
        sizes = level.groupBy("key").agg(F.count("*").alias("m"), F.min("cls").alias("pivot")).where("m > 1")
        live = settle(level.join(sizes, "key"))
        leaves.append(live.where(F.col("m") <= NODE).select("key", "cls", F.lit(1).cast("long").alias("chunks")))
        large = live.where(F.col("m") > NODE)
        if not large.take(1):
            break
        if depth == DEPTH:
            leaves.append(large.select("key", "cls", F.ceil(F.col("m") * 2 / NODE).cast("long").alias("chunks")))
            break
        pivots = sketches.select(F.col("cls").alias("pivot"), F.col("sketch").alias("pivot_sketch"))
        measured = large.join(sketches, "cls").join(pivots, "pivot").select("key", "cls", "sketch", "pivot", "pivot_sketch")
        seen = settle(measured.mapInArrow(_measure, "key long, cls binary, pivot binary, agree long"))
        found.append(seen.where((F.col("agree") >= WIDE) & (F.col("cls") != F.col("pivot"))).select(F.col("cls").alias("a"), F.col("pivot").alias("b")))
        far = seen.groupBy("key").agg(F.count_if(F.col("agree") < WIDE).alias("far"), F.count_if(F.col("agree") < CLOSE).alias("m"))
        stay = seen.where(F.col("agree") < CLOSE).join(far.where("far > 0"), "key")
        leaves.append(_with_far(stay.where(F.col("far") <= NODE)).withColumn("chunks", F.lit(1).cast("long")))
        branching = stay.where(F.col("far") > NODE).join(sketches, "cls").select("key", "cls", "sketch")
        repeats = REPEATS if depth == FIRST_DEPTH else 1
        level = branching.mapInArrow(_descend(repeats), "key long, cls binary").distinct()
    nodes = leaves[0]
    for more in leaves[1:]:
        nodes = nodes.unionByName(more)
    dealt = _chunk_pairs(nodes.join(sketches, "cls"), "key", "chunks", "cls").select("key", "cls", "sketch")
    out = _by_group(dealt, "key", _compare_nodes, "a binary, b binary")
    for more in found:
        out = out.unionByName(more)
    return out


def _sets_of(rows: DataFrame) -> DataFrame:
    """``family, chunks, cls, text`` to ``family, chunks, cls, shingles``; rows
    whose text is not of the class (another text under the id) go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(3).to_pylist()]
            same = [_class_of(s) == c for s, c in zip(sets, batch.column(2).to_pylist())]
            kept = batch.select([0, 1, 2]).filter(pa.array(same, pa.bool_()))
            data = pa.array([s.tobytes() for s, ok in zip(sets, same) if ok], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept.columns, data], ["family", "chunks", "cls", "shingles"])

    return rows.select("family", "chunks", "cls", "text").mapInArrow(
        run, "family long, chunks long, cls binary, shingles binary"
    )


def _compare_families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``family, cls, shingles`` to true links ``a, b``."""
    part, whole = LEAST
    for group in _groups(batches):
        sets = {}  # a class may come from several rows of one id
        for cls, data in zip(group["cls"].to_pylist(), group["shingles"].to_pylist()):
            sets[cls] = np.frombuffer(data, "u8")
        cls = list(sets)
        size = np.array([len(s) for s in sets.values()])
        local = np.unique(np.concatenate(list(sets.values())), return_inverse=True)[1]
        ends = np.cumsum(size)
        marked = np.zeros(local.max() + 1, "u1")
        each = np.split(local, ends[:-1])

        def linked(i, others):
            fit = (size[others] * whole >= size[i] * part) & (size[i] * whole >= size[others] * part)  # noqa: B023
            some = others[fit]
            if len(some):
                marked[each[i]] = 1  # noqa: B023
                flat = marked[np.concatenate([each[j] for j in some])]  # noqa: B023
                cuts = np.concatenate([[0], np.cumsum(size[some])[:-1]])  # noqa: B023
                both = np.add.reduceat(flat, cuts, dtype="i8")
                marked[each[i]] = 0  # noqa: B023
                fit[fit] = whole * both >= part * (size[i] + size[some] - both)  # noqa: B023
            return fit

        forest = _forest(len(cls), linked)
        if forest:
            yield _pairs(cls, forest)


def true_links(documents: DataFrame, families: DataFrame) -> DataFrame:
    """Links ``a, b`` that keep the linked classes connected. ``families`` has
    ``family, chunks, cls, rep`` (a document id of the class)."""
    members = F.broadcast(families) if families.count() <= BROADCAST_ROWS else families
    texts = documents.select("doc_id", "text").join(members, F.col("doc_id").eqNullSafe(F.col("rep")))
    dealt = _chunk_pairs(_sets_of(texts), "family", "chunks", "cls").select("family", "cls", "shingles")
    return _by_group(dealt, "family", _compare_families, "a binary, b binary")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document."""
    described = settle(describe(documents))
    full = described.where("cls IS NOT NULL")
    classes = settle(
        full.groupBy("cls").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("nodes").alias("nodes")
        )
    )
    grouped = components(candidates(classes.select("cls", "sketch", "nodes")))
    grouped = grouped.select(F.col("node").alias("cls"), F.xxhash64("component").alias("family"))
    weights = grouped.join(classes.select("cls", "rep", "n"), "cls")
    totals = weights.groupBy("family").agg(F.sum("n").alias("n"))
    chunks = totals.select("family", F.when(F.col("n") <= FAMILY, 1).otherwise(F.ceil(F.col("n") * 2 / FAMILY)).cast("long").alias("chunks"))
    families = settle(weights.join(chunks, "family").select("family", "chunks", "cls", "rep"))
    stars = components(true_links(documents, families))
    placed = classes.select("cls", "rep").join(stars, F.col("cls") == F.col("node"), "left")
    placed = placed.select("cls", "rep", F.coalesce("component", "cls").alias("component"))
    lows = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    ids = placed.join(lows, "component").select("cls", "component_id")
    out = described.select("doc_id", "n_shingles", "cls").join(ids, "cls", "left")
    own = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
