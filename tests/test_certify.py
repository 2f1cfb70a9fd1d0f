"""Gradients, products of columns and conditions of an optimum, against numpy."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkwright.operators import certify, features, models, tune


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 3)), 3)
    x[rng.random((300, 3)) < 0.4] = 0.0
    y = np.round(x @ [1.0, -2.0, 0.0] + rng.normal(size=300), 3)
    data = [(*map(float, a), float(b), int(b > 0), int(k % 3)) for k, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "a double, b double, c double, y double, label int, fold int").repartition(4)
    return features.assemble(df, ["a", "b", "c"]).cache(), x, y


def gram_of(x, y):
    full = np.column_stack([y, np.ones(len(y)), x])
    return full.T @ full


def as_matrix(rows, width):
    out = np.zeros((width, width))
    for r in rows:
        out[r.i + 2, r.j + 2] = out[r.j + 2, r.i + 2] = r.s
    return out


def test_gram_and_training_systems(rows):
    df, x, y = rows
    assert np.allclose(as_matrix(certify.gram_table(df, "y").collect(), 5), gram_of(x, y))
    systems = certify.training_systems(certify.gram_table(df, "y", by=("fold",))).collect()
    folds = np.arange(300) % 3
    for k in range(3):
        part = as_matrix([r for r in systems if r.fold == k], 5)
        assert np.allclose(part, gram_of(x[folds != k], y[folds != k]))
        seen = df.where(F.col("fold") != k)
        fit = models.linear("y").fit(seen)
        solved = np.linalg.solve(part[1:, 1:], part[1:, 0])
        assert solved == pytest.approx([fit.intercept, *fit.coefficients], abs=1e-8)


def test_gram_of_a_fold_without_a_pair(spark):
    df = features.assemble(spark.createDataFrame([(1.0, 0.0, 2.0, 0), (0.0, 1.0, 3.0, 1)], "a double, b double, y double, fold int"), ["a", "b"])
    got = {(r.fold, r.i, r.j): r.s for r in certify.training_systems(certify.gram_table(df, "y", by=("fold",))).collect()}
    assert got[0, 0, 0] == 0 and got[1, 0, 0] == 1 and got[0, 1, 1] == 1 and got[1, -2, 0] == 2
    assert certify.gram_table(df.limit(0), "y").count() == 0


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_conditions_hold_at_the_optimum_only(rows, share):
    df, _, _ = rows
    gram = certify.gram_table(df, "y")
    fit = models.linear("y", regParam=0.3, elasticNetParam=share, tol=1e-12, maxIter=1000).fit(df)
    assert all(r.slack < 1e-6 for r in certify.subgradients(gram, fit, 0.3, share).collect())
    other = models.linear("y", regParam=0.6, elasticNetParam=share, tol=1e-12, maxIter=1000).fit(df)
    assert max(r.slack for r in certify.subgradients(gram, other, 0.3, share).collect()) > 0.01


def test_lasso_zeros_are_certified(rows):
    df, _, _ = rows
    fit = models.linear("y", regParam=0.5, elasticNetParam=1.0, tol=1e-12, maxIter=1000).fit(df)
    table = {r.slot: r for r in certify.subgradients(certify.gram_table(df, "y"), fit, 0.5).collect()}
    assert table[2].coefficient == 0 and abs(table[2].gradient) < table[2].bound and table[2].slack == 0
    assert all(abs(abs(table[k].gradient) - table[k].bound) < 1e-6 for k in (0, 1))


def test_slot_gradients(rows):
    df, x, _ = rows
    fit = models.logistic(regParam=0.1, tol=1e-10, maxIter=500).fit(df)
    scored = fit.transform(df)
    error = vector_to_array("probability")[1] - F.col("label")
    got = {r.slot: r for r in certify.slot_gradients(scored, error).collect()}
    assert got[-1].n_rows == 300 and abs(got[-1].gradient) < 1e-7 and got[-1].std is None
    for k in range(3):
        assert got[k].std == pytest.approx(x[:, k].std(ddof=1))
        assert abs(got[k].gradient + 0.1 * got[k].std ** 2 * fit.coefficients[k]) < 1e-6
    wrong = {r.slot: r.gradient for r in certify.slot_gradients(scored, error + 0.1).collect()}
    assert wrong[-1] == pytest.approx(0.1, abs=1e-6)


def test_fold_table_and_spread(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    found = tune.SearchResult([{}, {}, {}], [2.0, 3.0, 2.0], RegressionEvaluator(), fold_metrics=[[1.0, 3.0], [2.5, 3.5], [1.0, 3.0]])
    folds = tune.fold_table(spark, found)
    assert sorted((r.fold, r.point, r.metric) for r in folds.collect()) == [(0, 0, 1.0), (0, 1, 2.5), (0, 2, 1.0), (1, 0, 3.0), (1, 1, 3.5), (1, 2, 3.0)]
    got = {r.point: (r["mean"], round(r.spread, 6), r.gap) for r in tune.fold_spread(folds, False).collect()}
    assert got == {0: (2.0, 1.414214, None), 1: (3.0, 0.707107, pytest.approx(2.0)), 2: (2.0, 1.414214, None)}


def test_sums_of_products_pass_over_the_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def target(k):
        seen.add(1)
        return float(k % 7)

    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.range(200).selectExpr("id", "cast(id % 5 as double) a", "cast(id % 11 as double) b"))
    df = df.withColumn("y", F.udf(target, "double")("id"))
    fit = models.linear("y", regParam=0.1, elasticNetParam=1.0).fit(df)
    before = seen.value
    assert certify.subgradients(certify.gram_table(df, "y"), fit, 0.1).count() == 2
    assert seen.value - before == 200
