import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sparkwright.functions import partitioning
from sparkwright.operators import forests, tune
from sparkwright.plans import search
from conftest import SF_SMALL

COLS = ["a", "b"]


def _rows(spark, n=6000):
    """``b`` has more values than bins; the label follows both, with noise."""
    df = spark.range(n).selectExpr("id", "cast(id % 7 as double) a", "cast(id * 37 % 997 as double) b",
                                   "cast(conv(substring(md5(cast(id as string)), 1, 4), 16, 10) as int) % 100 noise")
    return df.selectExpr("id", "a", "b", "cast(if(10 * a + b / 10 + noise / 2 > 100, 1, 0) as int) label",
                         "cast(id % 3 as int) fold")


def _forest(**params):
    return RandomForestClassifier(numTrees=8, seed=5, **params)


def test_edges_share_evenly_and_keep_frequent_values_apart():
    assert forests.equal_shares([3.0, 1.0, 2.0, 1.0], 4) == [2.0, 3.0]
    assert forests.equal_shares([7.0] * 9, 4) == []
    assert forests.equal_shares([float(k) for k in range(100)], 4) == [25.0, 50.0, 75.0]
    edges = forests.equal_shares([0.0] * 900 + [float(k) for k in range(1, 101)], 5)
    assert edges == [1.0, 26.0, 51.0, 76.0]


def test_groups_count_every_row(spark):
    df = _rows(spark)
    bins = forests.learn_bins(df, COLS, 8)
    groups = forests.group_rows(df, bins, "label").collect()
    assert sum(g.n for g in groups) == 6000 and len(groups) <= 2 * 7 * 8
    assert {g.bin_0 for g in groups} == set(range(7)) and {g.bin_1 for g in groups} == set(range(8))


def test_draws_are_poisson_and_independent_of_partitions(spark):
    df = _rows(spark)
    names = ["bin_0", "bin_1"]
    groups = forests.group_rows(df, forests.learn_bins(df, COLS, 8), "label")
    drawn = [sorted(forests.bootstrapped(groups.repartition(k), names, "label", 200, 1.0, 5).select(
        *names, "label", "n", "draws").collect()) for k in (1, 7)]
    assert drawn[0] == drawn[1]
    big = max(drawn[0], key=lambda g: g.n)
    mean = sum(big.draws) / 200
    assert abs(mean - big.n) < 5 * (big.n / 200) ** 0.5
    assert 0.6 * big.n < sum((x - mean) ** 2 for x in big.draws) / 200 < 1.6 * big.n


def test_search_agrees_with_forests_on_rows(spark):
    df = _rows(spark)
    forest = _forest()
    grid = [{forest.featureSubsetStrategy: "all", forest.maxDepth: 2}, {forest.featureSubsetStrategy: "all", forest.maxDepth: 6}]
    evaluator = BinaryClassificationEvaluator(numBins=0)
    found = forests.grouped_search(forest, grid, evaluator, df, COLS, 3)
    plain = tune.cross_validate(forest, grid, evaluator, VectorAssembler(inputCols=COLS, outputCol="features").transform(df).select(
        "features", "label", "fold"), 3)
    assert found.best == 1 and [len(m) for m in found.fold_metrics] == [3, 3]
    assert all(abs(a - b) < 0.01 for a, b in zip(found.metrics, plain.avgMetrics))
    again = forests.grouped_search(forest, grid, evaluator, df.repartition(5), COLS, 3)
    assert again.metrics == found.metrics
    # the refitted winner has all trees and scores plain rows; the area of groups is that of rows
    assert len(found.best_model.trees) == 8
    scored = found.best_model.score(df)
    assert scored.columns == [*df.columns, "score"] and scored.count() == 6000
    assert scored.agg(F.min("score") >= 0, F.max("score") <= 8).first() == (True, True)


def test_unsuitable_grids_raise(spark):
    df, forest = _rows(spark, 50), _forest()
    with pytest.raises(ValueError, match="maxBins"):
        forests.grouped_search(forest, [{forest.maxBins: 4}], BinaryClassificationEvaluator(), df, COLS, 3)
    with pytest.raises(ValueError, match="minInstancesPerNode"):
        forests.grouped_search(_forest(minInstancesPerNode=3), [{}], BinaryClassificationEvaluator(), df, COLS, 3)


def test_fits_of_a_large_search_do_not_read_all_rows(spark, monkeypatch):
    """Every fit read all training rows of its fold before, however many."""
    sizes = []
    fit = RandomForestClassifier.fit

    def counted(self, dataset, params=None):
        sizes.append(dataset.count())
        return fit(self, dataset, params)

    monkeypatch.setattr(RandomForestClassifier, "fit", counted)
    monkeypatch.setattr(partitioning, "SPREAD_ROWS", 500)
    monkeypatch.setattr(search.tune, "forest_grid", lambda f: [{f.featureSubsetStrategy: "all", f.maxDepth: 2}])
    monkeypatch.setattr(search.models, "random_forest", lambda: RandomForestClassifier(numTrees=2, maxBins=3))
    table = search.t10_grid_forest(spark, SF_SMALL).collect()
    assert len(table) == 1 and 0.5 < table[0].metric <= 1
    assert len(sizes) == 6 * 2 and max(sizes) <= 2 * 3 ** 3


def test_points_that_differ_in_depth_share_a_fit(spark, monkeypatch):
    """Every point was fitted for itself before: 13 fits of 2 folds and 6 points."""
    df = VectorAssembler(inputCols=COLS, outputCol="features").transform(_rows(spark)).selectExpr(
        "features", "label", "cast(id % 2 as int) fold").repartition(3)
    forest, evaluator = _forest(), BinaryClassificationEvaluator(numBins=0)
    grid = [{forest.featureSubsetStrategy: s, forest.maxDepth: d} for s in ("all", "sqrt") for d in (1, 7, 3)]
    assert forests.alike_points(forest, grid, 2) == [[1, 4, 2, 5, 0, 3]]
    assert forests.alike_points(forest, grid, 5) == [[1, 2, 0], [4, 5, 3]]
    plain = tune.cross_validate(forest, grid, evaluator, df, 2)
    fits, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    found = forests.nested_search(forest, grid, evaluator, df, 2)
    assert len(fits) == 3
    assert all(abs(a - b) < 1e-12 for a, b in zip(found.metrics, plain.avgMetrics))
    assert found.best_model.toDebugString == plain.bestModel.toDebugString


def test_cut_trees_merge_leaves_of_one_prediction():
    nodes = {0: (0.0, [10.0, 6.0], 1, 2), 1: (0.0, [7.0, 1.0], -1, -1), 2: (1.0, [3.0, 5.0], 3, 4), 3: (1.0, [0.0, 2.0], -1, -1),
             4: (0.0, [3.0, 3.0], 5, 6), 5: (0.0, [3.0, 1.0], -1, -1), 6: (1.0, [0.0, 2.0], -1, -1)}
    assert forests.cut_shares(nodes, 3) == [1 / 8, 1.0, 1 / 4, 1.0]
    assert forests.cut_shares(nodes, 2) == [1 / 8, 1.0, 1 / 2, 1 / 2]
    assert forests.cut_shares(nodes, 1) == [1 / 8, 5 / 8, 5 / 8, 5 / 8]
    nodes[2] = (0.0, [5.0, 3.0], 3, 4)  # at depth 1 both sides say 0: one leaf
    assert forests.cut_shares(nodes, 1) == [6 / 16] * 4


def test_nested_search_wants_rows_in_every_fold(spark):
    df = VectorAssembler(inputCols=COLS, outputCol="features").transform(_rows(spark, 60)).select("features", "label", "fold")
    for rows, folds, said in ((df, 4, "validation data at fold 3 is empty"), (df.where("fold = 1"), 2, "validation data at fold 0"),
                              (df, 2, "from 0 to 1")):
        with pytest.raises(ValueError, match=said):
            forests.nested_search(_forest(), [{}], BinaryClassificationEvaluator(), rows, folds)


def test_middling_tables_are_not_grouped():
    """600,000 events were fitted as 1,220 single trees before."""
    forest = RandomForestClassifier()
    assert not forests.pays_to_group(600_000, forest, 3)
    assert forests.pays_to_group(6_000_000, forest, 3)
    assert not forests.pays_to_group(6_000_000, forest, 4)
