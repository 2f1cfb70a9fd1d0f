"""Fitted trees as tables: nodes, paths of rows, class counts, rounds and votes.

A fitted tree or ensemble is laid out as one row per node (``node_table``).
Nodes are numbered as in a heap: the root is 1, the children of ``n`` are
``2n`` and ``2n + 1``, so a leaf's number holds its whole path.  Rows find
their leaves through the model's leaf column, a projection without a shuffle;
everything about nodes is then a map-side combined count.
The node table is model state: it grows with depth and trees, not with rows.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

NODE_SCHEMA = StructType([
    StructField("tree", IntegerType(), False),
    StructField("node", LongType(), False),
    StructField("parent", LongType(), True),
    StructField("depth", IntegerType(), False),
    StructField("feature", StringType(), True),
    StructField("threshold", DoubleType(), True),
    StructField("left_categories", ArrayType(DoubleType()), True),
    StructField("prediction", DoubleType(), False),
    StructField("impurity", DoubleType(), False),
    StructField("gain", DoubleType(), True),
    StructField("rows", DoubleType(), False),
    StructField("stats", ArrayType(DoubleType()), False),
])


def trees_of(model) -> list:
    """The trees of an ensemble, or a single tree as a list of one."""
    return list(getattr(model, "trees", None) or [model])


def _walk(node, number: int, depth: int):
    """``(number, depth, java node)`` of a node and all below it."""
    yield number, depth, node
    if node.subtreeDepth() > 0:
        yield from _walk(node.leftChild(), 2 * number, depth + 1)
        yield from _walk(node.rightChild(), 2 * number + 1, depth + 1)


def _split_of(node) -> tuple[int, float | None, list[float] | None]:
    """Feature slot, and the threshold or the categories that go left."""
    split = node.split()
    if "Categorical" in split.getClass().getSimpleName():
        return split.featureIndex(), None, sorted(float(c) for c in split.leftCategories())
    return split.featureIndex(), float(split.threshold()), None


def node_rows(model, names: list[str]) -> list[tuple]:
    """Rows of ``NODE_SCHEMA``; a leaf has no feature, threshold and gain."""
    out = []
    for t, tree in enumerate(trees_of(model)):
        for number, depth, node in _walk(tree._call_java("rootNode"), 1, 0):
            inner = node.subtreeDepth() > 0
            slot, threshold, categories = _split_of(node) if inner else (None, None, None)
            out.append((t, number, number // 2 if number > 1 else None, depth, names[slot] if inner else None, threshold,
                        categories, float(node.prediction()), float(node.impurity()), float(node.gain()) if inner else None,
                        float(node.impurityStats().count()), [float(x) for x in node.impurityStats().stats()]))
    return out


def node_table(spark: SparkSession, model, names: list[str]) -> DataFrame:
    """M1 / I6. One row per node of every tree.  ``rows`` is the weight of its
    training rows; ``stats`` is that by class (classification), or number, sum
    and sum of squares of the target (regression, as in boosted trees)."""
    return spark.createDataFrame(node_rows(model, names), NODE_SCHEMA)


def leaves_of(tree) -> list[tuple[int, object]]:
    """Number and node of a tree's leaves, from left to right, which is the
    order of Spark's leaf indices."""
    return [(number, node) for number, _, node in _walk(tree._call_java("rootNode"), 1, 0) if node.subtreeDepth() == 0]


def with_leaf_indices(df: DataFrame, model, output_col: str) -> DataFrame:
    """Adds the array of the leaf index that a row reaches in each tree."""
    off = {model.predictionCol: "", model.probabilityCol: "", model.rawPredictionCol: "", model.leafCol: output_col}
    scored = model.copy(off).transform(df)
    if model.hasParam("numTrees") or getattr(model, "trees", None):
        return scored.withColumn(output_col, vector_to_array(F.col(output_col)))
    return scored.withColumn(output_col, F.array(F.col(output_col)))


def leaf_values(model, indices_col: str, value) -> Column:
    """The array, over the trees, of ``value(number, node)`` of a row's leaf: a
    lookup by index in a constant array per tree."""
    at = [F.element_at(F.lit([value(*leaf) for leaf in leaves_of(t)]), F.get(F.col(indices_col), F.lit(k)).cast("int") + 1)
          for k, t in enumerate(trees_of(model))]
    return F.array(*at)


def path_of(leaf: Column) -> Column:
    """The numbers of a leaf and all nodes above it, the root last."""
    depth = F.floor(F.log2(leaf)).cast("int")
    return F.transform(F.sequence(F.lit(0), depth), lambda k: F.call_function("shiftright", leaf, k))


def node_counts(df: DataFrame, model, label_col: str = "label") -> DataFrame:
    """Rows per node and label, ``(tree, node, label, n)``, by routing every
    row through every tree; combined by leaf before the shuffle, then counted
    for each node of the leaf's path."""
    routed = with_leaf_indices(df, model, "_leaves").select(
        F.col(label_col).cast("double").alias("label"),
        F.posexplode(leaf_values(model, "_leaves", lambda number, node: number)).alias("tree", "leaf"))
    leaves = routed.groupBy("tree", "leaf", "label").agg(F.count(F.lit(1)).alias("n"))
    per_node = leaves.select("tree", F.explode(path_of(F.col("leaf"))).alias("node"), "label", "n")
    return per_node.groupBy("tree", "node", "label").agg(F.sum("n").alias("n"))


def importance_from_nodes(nodes: DataFrame, names: list[str], per_tree: bool = True) -> DataFrame:
    """I6 from the node table: each feature's gains weighted by the node's rows,
    summed over the trees and scaled to 1.  ``per_tree`` scales each tree to 1
    first, as for a forest; boosted trees count with what they gained."""
    inner = nodes.where(F.col("feature").isNotNull())
    gained = inner.groupBy("tree", "feature").agg(F.sum(F.col("rows") * F.col("gain")).alias("gain"))
    if per_tree:
        totals = gained.groupBy("tree").agg(F.sum("gain").alias("total")).where("total > 0")
        gained = gained.join(totals, "tree").withColumn("gain", F.col("gain") / F.col("total"))
    summed = gained.groupBy("feature").agg(F.sum("gain").alias("gain"))
    scale = summed.agg(F.sum("gain").alias("scale"))  # one row
    every = nodes.sparkSession.createDataFrame([(n,) for n in names], "feature string")
    return every.join(summed, "feature", "left").join(F.broadcast(scale), how="cross").select(
        "feature", F.coalesce(F.col("gain") / F.col("scale"), F.lit(0.0)).alias("importance"))


# ---- boosted trees: the margin after every round ------------------------------------


def staged_margins(df: DataFrame, model, output_col: str = "margins") -> DataFrame:
    """M10. Adds the array of running margins, one per round, in one projection."""
    steps = F.transform(
        F.arrays_zip(leaf_values(model, "_leaves", lambda number, node: float(node.prediction())).alias("x"),
                     F.lit([float(w) for w in model.treeWeights]).alias("w")),
        lambda s: s["x"] * s["w"])
    add = lambda acc, x: F.concat(acc, F.array(x + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0))))
    running = F.aggregate(steps, F.array().cast("array<double>"), add)
    return with_leaf_indices(df, model, "_leaves").withColumn(output_col, running).drop("_leaves")


def loss_by_round(staged: DataFrame, label_col: str = "label", margins_col: str = "margins") -> DataFrame:
    """``(round, loss)``: the mean log-loss ``2 ln(1 + exp(-2 y F))`` with y = -1
    or 1, which the boosting rounds descend; one aggregate."""
    sign = F.col(label_col).cast("double") * 2 - 1
    long = staged.select(sign.alias("y"), F.posexplode(margins_col).alias("round", "margin"))
    loss = 2 * F.log1p(F.exp(-2 * F.col("y") * F.col("margin")))
    return long.groupBy((F.col("round") + 1).cast("int").alias("round")).agg(F.avg(loss).alias("loss"))


# ---- forests: one vote per tree ------------------------------------------------------


def leaf_votes(df: DataFrame, model, key_col: str) -> DataFrame:
    """M11. One row per row and tree: ``(key, tree, leaf, p1)``, ``p1`` the share
    of class 1 among the leaf's training rows (binary forests)."""
    def share(number: int, node) -> float:
        stats = [float(x) for x in node.impurityStats().stats()]
        return stats[1] / sum(stats)

    each = F.arrays_zip(leaf_values(model, "_leaves", lambda number, node: number).alias("leaf"),
                        leaf_values(model, "_leaves", share).alias("p1"))
    long = with_leaf_indices(df, model, "_leaves").select(key_col, F.posexplode(each).alias("tree", "at"))
    return long.select(key_col, "tree", "at.leaf", "at.p1")


def tally_votes(votes: DataFrame, key_col: str) -> DataFrame:
    """``(key, trees, votes, p1)``: trees whose leaf has more of class 1, and
    the mean share, which is the forest's probability."""
    return votes.groupBy(key_col).agg(
        F.count(F.lit(1)).cast("int").alias("trees"), F.count_if(F.col("p1") > 0.5).cast("int").alias("votes"),
        F.avg("p1").alias("p1"))
