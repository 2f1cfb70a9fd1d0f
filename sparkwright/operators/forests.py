"""Forest search: each forest fitted once for all its depths.

Spark grows trees level by level, so that one of depth 5 is one of depth 10 cut
there: ``nested_search`` fits the deepest point of those that differ in nothing
else, and reads the others off its trees (``cut_shares``).  Strategies that
leave the same number of features to a node are alike too (``sqrt`` and ``log2``
of three).  Draws and features of a node depend on the seed and its place only,
so all points have the areas that fits of their own would have.

On large tables rows are grouped first.  A forest reads a feature only through
at most ``maxBins`` bins, so rows of the same bins and label are alike to every
tree.  ``grouped_search`` counts such rows once per fold and fits Spark's trees
on the counts as weights: the passes over all rows do not depend on the number
of grid points, trees and levels.

* Bins are learnt per fold on its training rows, from quantiles of all of them.
* Bootstrap: a row is drawn Poisson(rate) times for each tree, so ``n`` alike
  rows together Poisson(rate * n) times.  The draws are seeded by group and
  tree, whatever the partitioning.
* Each tree is a forest of one, fitted on its own weights; the forest's score is
  the sum of its trees' shares of class 1, as in Spark.
* Scores are equal within a group, so the weighted area is that of all rows.

Groups are at most ``2 * maxBins ** features`` and never more than the rows;
with many features there may be nearly as many, and nothing is saved.
"""

from __future__ import annotations

import math
from collections import Counter
from contextlib import ExitStack
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import partitioning
from ..functions.partitioning import persisted
from ..session import scratch_path, shared_root
from .trees import with_leaf_indices
from .tune import ROWS_PER_TASK, SearchResult

#: Quantiles from which the bins are chosen; rarer values may share a bin.
QUANTILES = 2_000

#: Rows of a group on average, of all groups that there can be, for grouping to pay.
ROWS_PER_GROUP = 16

#: Parameters that a grid may vary: they change neither bins nor draws.
GRID_PARAMS = {"featureSubsetStrategy", "maxDepth", "impurity", "minInfoGain"}


# ---- points that share their trees ---------------------------------------------------


def features_per_node(strategy: str, n_features: int) -> int | str:
    """Features that a node of a forest chooses from; other strategies by name."""
    if strategy == "all":
        return n_features
    if strategy in ("auto", "sqrt"):
        return math.ceil(math.sqrt(n_features))
    if strategy == "log2":
        return max(1, math.ceil(math.log(n_features) / math.log(2)))
    if strategy == "onethird":
        return math.ceil(n_features / 3)
    return strategy


def _fits_one_pass(forest: RandomForestClassifier, n_features: int) -> bool:
    """Whether the nodes of the deepest level of all trees are split in one pass,
    whose order of nodes is then that of the levels: their bins in the memory
    that a pass is given (three numbers each)."""
    nodes = forest.getNumTrees() * 2.0 ** max(0, forest.getMaxDepth() - 1)
    return nodes * n_features * (forest.getMaxBins() * 3 * 8 + 64) < forest.getMaxMemoryInMB() * 2**20


def alike_points(forest: RandomForestClassifier, grid: list[dict], n_features: int) -> list[list[int]]:
    """The points of ``grid`` in groups that differ in depth only, the deepest
    point of a group first."""
    groups: dict[tuple, list[int]] = {}
    for k, point in enumerate(grid):
        own = forest.copy(point)
        other = sorted((p.name, repr(v)) for p, v in point.items() if p.name not in ("maxDepth", "featureSubsetStrategy"))
        key = (features_per_node(own.getFeatureSubsetStrategy(), n_features) if own.getNumTrees() > 1
               else own.getFeatureSubsetStrategy(), *other, *(() if _fits_one_pass(own, n_features) else (k,)))
        groups.setdefault(key, []).append(k)
    return [sorted(g, key=lambda k: -forest.copy(grid[k]).getMaxDepth()) for g in groups.values()]


def cut_shares(nodes: dict[int, tuple], depth: int) -> list[float]:
    """For each leaf of a tree, from left to right, the share of class 1 where
    its rows end in the tree cut at ``depth``.  As in Spark, two leaves of the
    same prediction with one parent are one leaf."""
    def walk(number: int, level: int) -> tuple[list[float], bool]:
        prediction, stats, left, right = nodes[number]
        share = stats[1] / sum(stats) if sum(stats) else 0.0
        if left < 0:
            return [share], True
        (a, a_ends), (b, b_ends) = walk(left, level + 1), walk(right, level + 1)
        one = level >= depth or a_ends and b_ends and nodes[left][0] == nodes[right][0]
        return ([share] * (len(a) + len(b)), True) if one else (a + b, False)

    return walk(0, 0)[0]


def saved_shares(spark: SparkSession, root: str, depths: list[int]) -> list[np.ndarray]:
    """Per tree of the models saved as ``<root>/model=0``, ``model=1``.., in
    order, the ``cut_shares`` of its leaves, a column per depth.  The nodes of a
    tree are read in a task; the driver gets a number per leaf and depth."""
    def cut(nodes: pd.DataFrame) -> pd.DataFrame:
        of = {n[0]: n[1:] for n in nodes[["id", "prediction", "stats", "left", "right"]].itertuples(index=False, name=None)}
        shares = np.array([cut_shares(of, depth) for depth in depths]).T
        return pd.DataFrame({"model": [nodes["model"].iloc[0]], "tree": [nodes["tree"].iloc[0]], "shares": [shares.ravel()]})

    node = F.col("nodeData")
    saved = spark.read.option("basePath", root).parquet(f"{root}/model=*/data").select(
        F.col("model").cast("int").alias("model"), F.col("treeID").cast("int").alias("tree"), node["id"].alias("id"),
        node["prediction"].alias("prediction"), node["impurityStats"].alias("stats"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"))
    found = saved.groupBy("model", "tree").applyInPandas(cut, "model int, tree int, shares array<double>").collect()
    return [np.array(r.shares).reshape(-1, len(depths)) for r in sorted(found, key=lambda r: (r.model, r.tree))]


def _scored_at(df: DataFrame, leaves, shares: list[np.ndarray], depths: list[int], keep: list[str]) -> DataFrame:
    """``keep`` and a column ``score_<depth>`` for each depth: the sum of the
    trees' shares of class 1, ``leaves`` being the array of the leaf indices."""
    @F.pandas_udf("array<double>")
    def score(at: pd.Series) -> pd.Series:
        ends = np.array(at.tolist(), dtype=float).astype(int).reshape(-1, len(shares))
        total = np.zeros((len(ends), len(depths)))
        for k, held in enumerate(shares):
            total += held[ends[:, k]]
        return pd.Series(list(total))

    scored = df.select(*keep, score(leaves).alias("_scores"))
    return scored.select(*keep, *(F.get("_scores", F.lit(k)).alias(f"score_{d}") for k, d in enumerate(depths)))


def _areas(scored: DataFrame, evaluator: BinaryClassificationEvaluator, depths: list[int]) -> dict[int, float]:
    with persisted(scored) as rows:
        return {d: float(evaluator.evaluate(rows, {evaluator.rawPredictionCol: f"score_{d}"})) for d in depths}


def _depths(forest: RandomForestClassifier, grid: list[dict], points: list[int]) -> list[int]:
    return sorted({forest.copy(grid[k]).getMaxDepth() for k in points})


def _gathered(forest: RandomForestClassifier, grid: list[dict], groups: list[list[int]], found: list[dict[int, float]],
              num_folds: int) -> list[list[float]]:
    """Per point the areas of every fold, from those per group, fold and depth."""
    by_fold: list[list[float]] = [[] for _ in grid]
    for g, points in enumerate(groups):
        for k in points:
            by_fold[k] = [areas[forest.copy(grid[k]).getMaxDepth()] for areas in found[g * num_folds:(g + 1) * num_folds]]
    return by_fold


def nested_search(forest: RandomForestClassifier, grid: list[dict], evaluator: BinaryClassificationEvaluator,
                  df: DataFrame, num_folds: int, fold_col: str = "fold", parallelism: int = 4) -> SearchResult:
    """T10. K-fold search of a binary forest over ``grid``: one fit per fold for
    all points that differ in depth only, ``parallelism`` at once over all
    folds.  The winner is refitted on all rows."""
    spark, label, features = df.sparkSession, forest.getLabelCol(), forest.getFeaturesCol()
    with persisted(df) as rows, ThreadPool(parallelism) as pool:
        sizes = dict(rows.groupBy(fold_col).count().collect())
        if set(sizes) - set(range(num_folds)):
            raise ValueError(f"folds are numbered from 0 to {num_folds - 1}")
        for fold in range(num_folds):
            for part, n in (("training", sum(sizes.values()) - sizes.get(fold, 0)), ("validation", sizes.get(fold, 0))):
                if not n:
                    raise ValueError(f"The {part} data at fold {fold} is empty.")
        groups = alike_points(forest, grid, len(rows.select(features).first()[0]))

        def score(job):
            points, fold = job
            depths = _depths(forest, grid, points)
            model = forest.fit(rows.where(F.col(fold_col) != fold), grid[points[0]])
            routed = with_leaf_indices(rows.where(F.col(fold_col) == fold), model, "_leaves")
            model.save(f"{(root := scratch_path(spark, 'trees'))}/model=0")
            return _areas(_scored_at(routed, F.col("_leaves"), saved_shares(spark, root, depths), depths, [label]), evaluator, depths)

        found = pool.map(inheritable_thread_target(spark)(score), [(g, fold) for g in groups for fold in range(num_folds)], chunksize=1)
        by_fold = _gathered(forest, grid, groups, found, num_folds)
        result = SearchResult(grid, [sum(m) / num_folds for m in by_fold], evaluator, fold_metrics=by_fold)
        result.best_model = forest.fit(rows, grid[result.best])
    return result


# ---- grouped rows --------------------------------------------------------------------


def pays_to_group(n_rows: int, forest: RandomForestClassifier, n_features: int) -> bool:
    """Fits on groups are many small ones, a tree each: only for rows enough."""
    return n_rows > partitioning.SPREAD_ROWS and n_rows > ROWS_PER_GROUP * 2 * forest.getMaxBins() ** n_features


def equal_shares(values: list[float], bins: int) -> list[float]:
    """Lower edges of all bins but the first: one bin per value if there are
    few enough, else equal shares of what is left after each bin (a frequent
    value takes one bin, not several)."""
    counts = sorted(Counter(values).items())
    if len(counts) <= bins:
        return [v for v, _ in counts[1:]]
    edges, taken, left, free = [], 0, len(values), bins
    for value, n in counts:
        if taken and free > 1 and taken + n / 2 > left / free:
            edges.append(value)
            taken, left, free = 0, left - taken, free - 1
        taken += n
    return edges


def learn_bins(df: DataFrame, cols: list[str], bins: int) -> Bucketizer:
    """Bins of ``cols`` into columns ``bin_0``, ``bin_1``..; one pass."""
    found = df.approxQuantile(cols, [k / QUANTILES for k in range(QUANTILES + 1)], 0.5 / QUANTILES)
    splits = [[-np.inf, *equal_shares(values, bins), np.inf] for values in found]
    # a single bin is cut at infinity: Bucketizer wants two
    splits = [s if len(s) > 2 else [-np.inf, np.finfo(float).max, np.inf] for s in splits]
    return Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[f"bin_{k}" for k in range(len(cols))])


def group_rows(df: DataFrame, bins: Bucketizer, label_col: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``(bin_0.., label, by.., n)``: the rows of each group, map-side combined.
    The label's two classes are fixed, whatever labels a draw holds."""
    names = bins.getOutputCols()
    classes = {"ml_attr": {"type": "nominal", "name": label_col, "vals": ["0", "1"]}}
    counted = bins.transform(df.select(*bins.getInputCols(), label_col, *by)).groupBy(*names, label_col, *by).agg(
        F.count(F.lit(1)).alias("n"))
    # bins are plain numbers: marked as nominal, trees would take them for categories
    return counted.select(*(F.col(c).alias(c, metadata={}) for c in names),
                          F.col(label_col).cast("double").alias(label_col, metadata=classes), *by,
                          F.col("n").cast("double").alias("n"))


def bootstrapped(groups: DataFrame, names: list[str], label_col: str, trees: int, rate: float, seed: int) -> DataFrame:
    """Adds ``draws``: for each tree, how often the rows of the group are drawn."""
    @F.pandas_udf("array<double>")
    def draw(key: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([np.random.default_rng(k % 2**64).poisson(rate * m, trees).astype(float)
                          for k, m in zip(key.tolist(), n.tolist())])

    return groups.withColumn("draws", draw(F.xxhash64(*names, label_col, F.lit(seed)), "n"))


@dataclass
class GroupedForest:
    """A forest of single trees over binned features."""
    bins: Bucketizer
    trees: list[RandomForestClassificationModel]

    def score_groups(self, groups: DataFrame, output_col: str = "score") -> DataFrame:
        """Adds the sum of the trees' shares of class 1, to rows with ``features``."""
        scored, kept = groups, groups.columns
        for k, tree in enumerate(self.trees):
            only = {tree.rawPredictionCol: "", tree.predictionCol: "", tree.probabilityCol: f"p_{k}"}
            scored = tree.copy(only).transform(scored)
        total = sum((vector_to_array(F.col(f"p_{k}"))[1] for k in range(len(self.trees))), F.lit(0.0))
        return scored.select(*kept, total.alias(output_col))

    def score(self, df: DataFrame, output_col: str = "score") -> DataFrame:
        """The same for plain rows."""
        names = self.bins.getOutputCols()
        binned = self.bins.transform(df).select(*df.columns, *(F.col(c).alias(c, metadata={}) for c in names))
        ready = VectorAssembler(inputCols=names, outputCol="features").transform(binned)
        return self.score_groups(ready, output_col).drop("features", *names)


def _checked(forest: RandomForestClassifier, grid: list[dict]) -> None:
    other = {p.name for point in grid for p in point} - GRID_PARAMS
    if other:
        raise ValueError(f"a grouped search does not vary {sorted(other)}")
    if not forest.getBootstrap() or forest.getMinInstancesPerNode() != 1 or forest.isSet(forest.weightCol):
        raise ValueError("grouped rows need the bootstrap, no weights and minInstancesPerNode=1")


def _fit_tree(forest: RandomForestClassifier, point: dict, groups: DataFrame, k: int) -> RandomForestClassificationModel:
    """Tree ``k``: a forest of one on the rows drawn for it."""
    tree = forest.copy(point)
    if tree.getFeatureSubsetStrategy() == "auto" and forest.getNumTrees() > 1:
        tree.setFeatureSubsetStrategy("sqrt")  # what it means in a forest
    tree.setNumTrees(1).setBootstrap(False).setSubsamplingRate(1.0).setSeed(forest.getSeed() + k).setWeightCol("drawn")
    drawn = groups.select("features", forest.getLabelCol(), F.col("draws")[k].alias("drawn"))
    return tree.fit(drawn.where("drawn > 0"))


def grouped_search(forest: RandomForestClassifier, grid: list[dict], evaluator: BinaryClassificationEvaluator,
                   df: DataFrame, cols: list[str], num_folds: int, fold_col: str = "fold",
                   parallelism: int | None = None) -> SearchResult:
    """T10. K-fold search of a binary forest over ``grid`` on rows grouped by
    the bins of ``cols``, points that differ in depth only sharing their trees;
    as many fits at once as the cluster has cores
    (``parallelism``).  The winner is refitted on all rows."""
    _checked(forest, grid)
    spark, label = df.sparkSession, forest.getLabelCol()
    shared_root(spark)
    n_trees, names = forest.getNumTrees(), [f"bin_{k}" for k in range(len(cols))]
    weighted = evaluator.copy({evaluator.rawPredictionCol: "score", evaluator.labelCol: label, evaluator.weightCol: "n"})

    with persisted(df.select(*(F.col(c).cast("double").alias(c) for c in cols), label, fold_col)) as rows, \
            ExitStack() as held, ThreadPool(parallelism or spark.sparkContext.defaultParallelism) as pool:
        def in_parallel(work, items):
            return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)

        def laid_out(groups):
            """In parts of a task each and in a fixed order, so that fits repeat;
            checkpointed, as every fit would plan the whole lineage again."""
            with persisted(groups) as counted:
                parts = max(1, -(-counted.count() // ROWS_PER_TASK))
                ordered = counted.repartition(parts, *names, label).sortWithinPartitions(*names, label)
                ready = VectorAssembler(inputCols=names, outputCol="features").transform(ordered).checkpoint()
            return held.enter_context(persisted(ready))

        def prepare(fold):
            seen = rows if fold is None else rows.where(F.col(fold_col) != fold)
            bins = learn_bins(seen, cols, forest.getMaxBins())
            groups = bootstrapped(group_rows(seen, bins, label), names, label, n_trees, forest.getSubsamplingRate(),
                                  forest.getSeed())
            unseen = None if fold is None else laid_out(group_rows(rows.where(F.col(fold_col) == fold), bins, label))
            return bins, laid_out(groups), unseen

        rows.count()
        folds = in_parallel(prepare, range(num_folds))

        def grow(job):
            point, fold, k, root = job
            tree = _fit_tree(forest, point, folds[fold][1], k)
            tree.save(f"{root}/model={k}")
            return tree

        def score(job):
            depths, fold, trees, root = job
            routed = folds[fold][2]
            for k, tree in enumerate(trees):
                routed = with_leaf_indices(routed, tree, f"leaf_{k}")
            leaves = F.concat(*(f"leaf_{k}" for k in range(n_trees)))
            return _areas(_scored_at(routed, leaves, saved_shares(spark, root, depths), depths, [label, "n"]), weighted, depths)

        groups, areas = alike_points(forest, grid, len(cols)), []
        for points in groups:
            roots = [scratch_path(spark, "trees") for _ in range(num_folds)]
            grown = in_parallel(grow, [(grid[points[0]], fold, k, roots[fold]) for fold in range(num_folds) for k in range(n_trees)])
            depths = _depths(forest, grid, points)
            areas += in_parallel(score, [(depths, fold, grown[fold * n_trees:(fold + 1) * n_trees], roots[fold])
                                         for fold in range(num_folds)])
        by_fold = _gathered(forest, grid, groups, areas, num_folds)
        result = SearchResult(grid, [sum(m) / num_folds for m in by_fold], evaluator, fold_metrics=by_fold)
        bins, every, _ = prepare(None)
        result.best_model = GroupedForest(bins, in_parallel(lambda k: _fit_tree(forest, grid[result.best], every, k), range(n_trees)))
    return result
