import threading

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression

from sparkwright.operators import models, tune
from sparkwright.plans import common
from conftest import SF_SMALL


def test_grid_sizes(spark):
    reg = models.linear()
    assert len(tune.linear_grid(reg)) == 12
    assert len(tune.text_grid(HashingTF(), LogisticRegression())) == 72
    assert len(tune.forest_grid(models.random_forest())) == 12
    assert tune.empty_grid() == [{}]
    table = tune.grid_table(spark, tune.linear_grid(reg))
    assert table.select("point").distinct().count() == 12 and table.count() == 24
    assert 72 * 5 == 360  # fits in the text search (plus one refit of the winner)


def test_search_table_one_best_by_direction(spark):
    train, _ = common.split(spark, SF_SMALL)
    df = common.with_folds(train, 3).select("org", "km", "duration", "fold")
    reg = models.linear()
    pipe = tune.regression_stages("org", (), ("km",), regression=reg)
    cv = tune.cross_validate(pipe, tune.linear_grid(reg), RegressionEvaluator(labelCol="duration"),
                             df, 3, "fold", 2)
    rows = tune.search_table(spark, cv).collect()
    assert len(rows) == 12 and sum(r.is_best for r in rows) == 1
    best = [r for r in rows if r.is_best][0]
    assert best.metric == min(r.metric for r in rows)
    assert best.params.startswith("regParam=")
    stages = Pipeline(stages=pipe.getStages()[:-1])
    again = tune.staged_search(stages, [{}], reg, tune.linear_grid(reg), RegressionEvaluator(labelCol="duration"),
                               df, 3, ["features", "duration"])
    assert [round(m, 9) for m in again.metrics] == [round(m, 9) for m in cv.avgMetrics]
    assert again.best_model.stages[-1].coefficients == cv.bestModel.stages[-1].coefficients


def test_folds_partition_rows(spark):
    train, _ = common.split(spark, SF_SMALL)
    f = common.with_folds(train, 5)
    counts = {r.fold: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(counts) == set(range(5)) and sum(counts.values()) == train.count()


def test_best_index_direction():
    assert tune.best_index([3.0, 1.0, 2.0], larger_is_better=False) == 1
    assert tune.best_index([0.6, 0.7, 0.7], larger_is_better=True) == 1


def test_text_stages_wiring():
    stages = tune.text_stages().getStages()
    assert "coalesce(`text`, '') AS `text_filled`" in stages[0].getStatement()
    assert [s.getInputCol() for s in stages[1:5]] == ["text_filled", stages[1].getOutputCol(), stages[2].getOutputCol(),
                                                      stages[3].getOutputCol()]
    assert isinstance(stages[-1], LogisticRegression)


class _Meeting(LinearRegression):
    """Fits that wait for each other: two of different folds must be under way."""

    barrier, sizes = None, []

    def fit(self, dataset, params=None):
        if self.barrier is not None and not self.barrier.broken:
            self.sizes.append(dataset.count())
            self.barrier.wait(60)
        return super().fit(dataset, params)


def test_fits_of_all_folds_run_side_by_side(spark):
    df = spark.range(90).selectExpr("cast(id as double) km", "cast(2 * id + id % 3 as double) y",
                                    "cast(if(id < 30, 0, 1) as int) fold")
    stages = Pipeline(stages=[VectorAssembler(inputCols=["km"], outputCol="features")])
    model = _Meeting(labelCol="y")
    _Meeting.barrier = threading.Barrier(2, action=lambda: setattr(_Meeting, "barrier", None))
    found = tune.staged_search(stages, [{}], model, [{model.regParam: 0.0}], RegressionEvaluator(labelCol="y"), df, 2,
                               ["features", "y"], parallelism=2)
    assert sorted(_Meeting.sizes) == [30, 60] and len(found.fold_metrics[0]) == 2
    assert len(found.best_model.stages) == 2


def test_leading_transformers_run_once_per_setting(spark):
    seen = spark.sparkContext.accumulator(0)

    def words(k):
        seen.add(1)
        return ["a"] * (k % 3) + ["b"] * (k % 5)

    spark.udf.register("counted_words", words, "array<string>")
    df = spark.range(60).selectExpr("id", "cast(id % 3 + id % 5 as double) y", "cast(id % 3 as int) fold")
    plain = SQLTransformer(statement="SELECT *, counted_words(id) AS terms FROM __THIS__")
    hasher = HashingTF(inputCol="terms", outputCol="hash", numFeatures=16)
    stages = Pipeline(stages=[plain, hasher, IDF(inputCol="hash", outputCol="features")])
    reg = LinearRegression(labelCol="y", regParam=0.1)
    found = tune.staged_search(stages, [{hasher.binary: True}, {hasher.binary: False}], reg, [{}],
                               RegressionEvaluator(labelCol="y"), df, 3, ["features", "y"], parallelism=2)
    # once per setting, and for the refit (IDF, then the kept rows)
    assert seen.value == 60 * 4 and found.best == 1
    assert found.best_model.transform(df).count() == 60
