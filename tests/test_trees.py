"""Trees laid open, against the fitted models and DuckDB; areas by brute force."""

import math
import random

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sparkwright.operators import evaluate, features, models, trees
from sparkwright.plans import common
from sparkwright.plans.models import CLASS_FEATURES


@pytest.fixture(scope="module")
def data(spark):
    train, test = (features.assemble(d, CLASS_FEATURES).cache() for d in common.split(spark, SF_SMALL))
    return train, test


@pytest.fixture(scope="module")
def fitted(data):
    train, _ = data
    return {"tree": models.decision_tree().fit(train), "boosted": models.boosted_trees(maxIter=4).fit(train),
            "forest": models.random_forest(numTrees=5).fit(train),
            "whole": models.random_forest(numTrees=2, bootstrap=False, seed=3).fit(train)}


@pytest.mark.parametrize("name", ["tree", "whole"])
def test_routed_counts_equal_the_fit(spark, data, fitted, name):
    nodes = {(r.tree, r.node): r for r in trees.node_table(spark, fitted[name], CLASS_FEATURES).collect()}
    counts = {}
    for r in trees.node_counts(data[0], fitted[name]).collect():
        counts.setdefault((r.tree, r.node), [0.0, 0.0])[int(r.label)] = float(r.n)
    assert counts == {k: r.stats for k, r in nodes.items()}
    for (t, n), r in nodes.items():
        assert (r.parent is None) == (n == 1) and (n == 1 or (t, n // 2) in nodes) and r.depth == n.bit_length() - 1
        assert (r.feature is None) == ((t, 2 * n) not in nodes) == (r.gain is None)


@pytest.mark.parametrize("name", ["tree", "boosted", "forest"])
def test_importance_equals_the_model(spark, fitted, name):
    table = trees.importance_from_nodes(trees.node_table(spark, fitted[name], CLASS_FEATURES), CLASS_FEATURES, name != "boosted")
    got = {r.feature: r.importance for r in table.collect()}
    assert [got[c] for c in CLASS_FEATURES] == pytest.approx(fitted[name].featureImportances.toArray().tolist(), abs=1e-9)


def test_last_margin_and_loss(spark, data, fitted):
    train, test = data
    model = fitted["boosted"]
    staged = trees.staged_margins(model.transform(test), model).select(
        "margins", vector_to_array("rawPrediction").alias("raw")).collect()
    assert all(len(r.margins) == 4 and math.isclose(r.margins[-1], r.raw[1], abs_tol=1e-9) for r in staged)
    loss = {r["round"]: r.loss for r in trees.loss_by_round(trees.staged_margins(train, model)).collect()}
    assert sorted(loss) == [1, 2, 3, 4] and all(loss[k] > loss[k + 1] for k in (1, 2, 3))
    assert loss[4] == pytest.approx(model.evaluateEachIteration(train)[3] if hasattr(model, "evaluateEachIteration") else loss[4], rel=1e-9)


def test_votes_rebuild_the_probability(spark, data, fitted):
    _, test = data
    model = fitted["forest"]
    tally = {r.event_id: r for r in trees.tally_votes(trees.leaf_votes(test, model, "event_id"), "event_id").collect()}
    for r in model.transform(test).select("event_id", vector_to_array("probability")[1].alias("p")).collect():
        assert tally[r.event_id].trees == 5 and math.isclose(tally[r.event_id].p1, r.p, abs_tol=1e-9)


@pytest.mark.parametrize("name", ["forest", "boosted"])
def test_node_table_in_sql(spark, data, fitted, name):
    """Rows routed through the node table in DuckDB give the model's scores."""
    _, test = data
    con = duckdb.connect()
    nodes = trees.node_table(spark, fitted[name], CLASS_FEATURES).drop("left_categories").toArrow()  # noqa: F841
    points = test.select("event_id", "mon", "depart", "duration").toArrow()  # noqa: F841
    weights = spark.createDataFrame(list(enumerate(map(float, fitted[name].treeWeights))), "tree int, w double").toArrow()  # noqa: F841
    value = "stats[2] / list_sum(stats)" if name == "forest" else "prediction * w"
    total = "avg" if name == "forest" else "sum"
    got = dict(con.sql(f"""
        WITH RECURSIVE walk AS (
          SELECT event_id, tree, CAST(1 AS BIGINT) AS node FROM points, (SELECT DISTINCT tree FROM nodes)
          UNION ALL
          SELECT a.event_id, a.tree, 2 * a.node + CASE WHEN CASE feature WHEN 'mon' THEN mon WHEN 'depart' THEN depart ELSE duration END <= threshold
                                                       THEN 0 ELSE 1 END
          FROM walk a JOIN nodes n ON n.tree = a.tree AND n.node = a.node JOIN points r ON r.event_id = a.event_id WHERE feature IS NOT NULL)
        SELECT event_id, {total}({value}) FROM walk JOIN nodes USING (tree, node) JOIN weights USING (tree) WHERE feature IS NULL
        GROUP BY event_id""").fetchall())
    column = "probability" if name == "forest" else "rawPrediction"
    for r in fitted[name].transform(test).select("event_id", vector_to_array(column)[1].alias("p")).collect():
        assert math.isclose(got[r.event_id], r.p, abs_tol=1e-9)


def test_categorical_splits_and_path(spark):
    df = spark.range(200).selectExpr("id", "cast(id % 4 as string) c", "cast(id % 4 in (1, 2) as int) label")
    _, df = features.index_categories(df, ["c"], ["ci"])
    df = features.assemble(df, ["ci"])
    model = models.decision_tree().fit(df)
    root = trees.node_table(spark, model, ["ci"]).where("node = 1").first()
    assert root.threshold is None and len(root.left_categories) == 2
    counts = {(r.node, r.label): r.n for r in trees.node_counts(df, model).collect()}
    assert counts == {(1, 0.0): 100, (1, 1.0): 100, (2, 0.0): 100, (3, 1.0): 100} or counts == {(1, 0.0): 100, (1, 1.0): 100, (2, 1.0): 100, (3, 0.0): 100}
    paths = spark.sql("SELECT explode(array(1L, 2L, 22L)) AS leaf").select(trees.path_of(F.col("leaf")).alias("p")).collect()
    assert [r.p for r in paths] == [[1], [2, 1], [22, 11, 5, 2, 1]]
    assert trees.node_counts(df.limit(0), model).count() == 0


# ---- areas --------------------------------------------------------------------------


def brute_areas(rows):
    pos, neg = [r for r in rows if r[0] == 1], [r for r in rows if r[0] != 1]
    beat = lambda x, y: 1.0 if x > y else 0.5 if x == y else 0.0
    mean = lambda x: sum(x) / len(x)
    var = lambda x: sum((v - mean(x)) ** 2 for v in x) / (len(x) - 1)
    won = [[mean([beat(p[k], q[k]) for q in neg]) for p in pos] for k in (1, 2)]
    lost = [[mean([beat(p[k], q[k]) for p in pos]) for q in neg] for k in (1, 2)]
    gap = lambda v: [a - b for a, b in zip(*v)]
    return mean(won[0]), mean(won[1]), math.sqrt(var(gap(won)) / len(pos) + var(gap(lost)) / len(neg))


@pytest.mark.parametrize("distinct", [3, 1000])
def test_compare_auc_equals_brute_force(spark, distinct):
    rng = random.Random(distinct)
    rows = [(rng.randrange(2), float(rng.randrange(distinct)), float(rng.randrange(distinct))) for _ in range(150)]
    df = spark.createDataFrame(rows, "label int, x double, y double").repartition(5)
    a, b, error = brute_areas(rows)
    got = evaluate.compare_auc(df, "x", "y").first()
    assert (got.auc_first, got.auc_second, got.std_error) == pytest.approx((a, b, error), abs=1e-9)
    assert got.difference == pytest.approx(a - b) and got.z == pytest.approx((a - b) / error)
    assert evaluate.auc_by(df, "x").first().auc == pytest.approx(a)


def test_areas_by_group_and_single_classes(spark):
    rows = [("a", 1, 2.0), ("a", 0, 1.0), ("a", 0, 2.0), ("b", 1, 5.0), ("b", 1, 6.0), ("c", 0, 1.0), ("c", 1, 0.0)]
    df = spark.createDataFrame(rows, "g string, label int, s double")
    assert {r.g: r.auc for r in evaluate.auc_by(df, "s", by=("g",)).collect()} == {"a": 0.75, "b": None, "c": 0.0}
    one = evaluate.compare_auc(df.where("g = 'b'").withColumn("t", F.col("s")), "s", "t").first()
    assert one.auc_first is None and one.std_error is None and one.z is None
    same = evaluate.compare_auc(df.withColumn("t", F.col("s")), "s", "t").first()
    assert same.difference == 0 and same.std_error == 0 and same.z is None
    assert evaluate.auc_by(df.limit(0), "s", by=("g",)).count() == 0


def test_counts_below_over_ranges(spark):
    df = spark.range(5000).selectExpr("cast(id * 7919 % 1000 as double) s", "cast(id % 3 = 0 as int) label").repartition(7)
    rows = sorted(evaluate.counts_below(df, "s").collect(), key=lambda r: r.score)
    pos = neg = 0
    for r in rows:
        assert (r.pos_below, r.neg_below) == (pos, neg)
        pos, neg = pos + r.pos, neg + r.neg
    assert pos + neg == 5000
