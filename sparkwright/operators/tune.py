"""Pipelines, parameter grids and cross-validated search.

``staged_search`` fits the feature stages once per fold (and per setting of
theirs; stateless ones before them run once per setting), keeps the result, and
fits only the model for each of its points, the fits of all folds in one queue;
``cross_validate`` refits the whole pipeline each time.

Leak rule: every *fitted* stage (indexer, encoder, IDF, model) sits inside the
pipeline that the search refits per fold; only stateless preparation
(cleaning, tokens, stop words) may run once before the search.  Folds come
from a key hash (``fold_column``), so a search is reproducible whatever the
partitioning, and the per-fold training and validation sets are cached by the
validator for the duration of that fold only.
"""

from __future__ import annotations

from contextlib import ExitStack
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import (IDF, HashingTF, OneHotEncoder, SQLTransformer,
                                StopWordsRemover, StringIndexer, Tokenizer, VectorAssembler)
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.partitioning import persisted
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, StringType,
                               StructField, StructType)


def regression_stages(categorical: str = "org", raw_int_cols: tuple[str, ...] = (),
                      numeric: tuple[str, ...] = ("km",), label_col: str = "duration",
                      regression: LinearRegression | None = None,
                      handle_invalid: str = "error") -> Pipeline:
    """T1 / T7. Index a category, one-hot it (and any raw int columns), assemble
    with the numeric columns, regress."""
    idx = f"{categorical}_idx"
    indexer = StringIndexer(inputCol=categorical, outputCol=idx, handleInvalid=handle_invalid)
    onehot = OneHotEncoder(inputCols=[idx, *raw_int_cols],
                           outputCols=[f"{categorical}_dummy", *(f"{c}_dummy" for c in raw_int_cols)],
                           handleInvalid=handle_invalid)
    assembler = VectorAssembler(inputCols=[*numeric, f"{categorical}_dummy",
                                           *(f"{c}_dummy" for c in raw_int_cols)],
                                outputCol="features")
    regression = regression or LinearRegression(labelCol=label_col)
    return Pipeline(stages=[indexer, onehot, assembler, regression])


def text_stages(text_col: str = "text", classifier: LogisticRegression | None = None,
                num_features: int | None = None) -> Pipeline:
    """T2. Tokens -> terms -> hashed counts -> IDF -> logistic; each stage wired
    to the previous one's output column.  A first stage turns a null text into
    an empty one (column ``<text_col>_filled``)."""
    filled = SQLTransformer(statement=f"SELECT *, coalesce(`{text_col}`, '') AS `{text_col}_filled` FROM __THIS__")
    tokenizer = Tokenizer(inputCol=f"{text_col}_filled", outputCol="words")
    remover = StopWordsRemover(inputCol=tokenizer.getOutputCol(), outputCol="terms")
    hasher = HashingTF(inputCol=remover.getOutputCol(), outputCol="hash")
    if num_features:
        hasher.setNumFeatures(num_features)
    idf = IDF(inputCol=hasher.getOutputCol(), outputCol="features")
    return Pipeline(stages=[filled, tokenizer, remover, hasher, idf, classifier or LogisticRegression()])


def stage(pipeline: Pipeline, cls: type):
    return next(s for s in pipeline.getStages() if isinstance(s, cls))


# The grids of the exercises.
def linear_grid(regression: LinearRegression) -> list[dict]:
    """T8. 4 x 3 = 12 points."""
    return (ParamGridBuilder()
            .addGrid(regression.regParam, [0.01, 0.1, 1.0, 10.0])
            .addGrid(regression.elasticNetParam, [0.0, 0.5, 1.0])
            .build())


def hashing_grid(hasher: HashingTF) -> list[dict]:
    """3 x 2 = 6 settings of the text features."""
    return (ParamGridBuilder()
            .addGrid(hasher.numFeatures, [1024, 4096, 16384])
            .addGrid(hasher.binary, [True, False])
            .build())


def logistic_grid(logistic: LogisticRegression) -> list[dict]:
    """4 x 3 = 12 points of the classifier."""
    return (ParamGridBuilder()
            .addGrid(logistic.regParam, [0.01, 0.1, 1.0, 10.0])
            .addGrid(logistic.elasticNetParam, [0.0, 0.5, 1.0])
            .build())


def text_grid(hasher: HashingTF, logistic: LogisticRegression) -> list[dict]:
    """T9. 6 x 12 = 72 points."""
    return [{**a, **b} for a in hashing_grid(hasher) for b in logistic_grid(logistic)]


def forest_grid(forest: RandomForestClassifier) -> list[dict]:
    """T10. 4 x 3 = 12 points."""
    return (ParamGridBuilder()
            .addGrid(forest.featureSubsetStrategy, ["all", "onethird", "sqrt", "log2"])
            .addGrid(forest.maxDepth, [2, 5, 10])
            .build())


def empty_grid() -> list[dict]:
    """T4. One empty parameter map: plain cross-validation."""
    return ParamGridBuilder().build()


def describe_point(point: dict) -> str:
    parts = []
    for param, value in point.items():
        conv = getattr(param, "typeConverter", None)
        v = conv(value) if conv else value
        parts.append(f"{param.name}={v!r}" if not isinstance(v, str) else f"{param.name}={v}")
    return ", ".join(parts)


GRID_SCHEMA = StructType([StructField("point", IntegerType(), False),
                          StructField("param", StringType(), False),
                          StructField("value", StringType(), False)])


def grid_table(spark: SparkSession, grid: list[dict]) -> DataFrame:
    """T5. The grid as rows ``(point, param, value)``; its point count is the
    number of distinct ``point`` values."""
    rows = []
    for i, point in enumerate(grid):
        for param, value in point.items():
            conv = getattr(param, "typeConverter", None)
            rows.append((i, param.name, repr(conv(value) if conv else value)))
    return spark.createDataFrame(rows, GRID_SCHEMA)


def cross_validate(estimator: Estimator, grid: list[dict], evaluator: Evaluator,
                   df: DataFrame, num_folds: int, fold_col: str = "fold",
                   parallelism: int = 4) -> CrossValidatorModel:
    """T6-T10. K-fold search over ``grid`` using the precomputed ``fold_col``;
    ``parallelism`` fits run at once (each is itself a distributed job).
    Total fits = points x folds + 1 refit of the winner on all rows."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                        numFolds=num_folds, foldCol=fold_col, parallelism=parallelism)
    with persisted(df) as rows:
        return cv.fit(rows)


SEARCH_SCHEMA = StructType([StructField("point", IntegerType(), False),
                            StructField("params", StringType(), False),
                            StructField("metric", DoubleType(), False),
                            StructField("is_best", BooleanType(), False)])


def best_index(metrics: list[float], larger_is_better: bool) -> int:
    best = max(metrics) if larger_is_better else min(metrics)
    return metrics.index(best)


@dataclass
class SearchResult:
    points: list[dict]
    metrics: list[float]
    evaluator: Evaluator
    best_model: PipelineModel | None = None
    #: per point, the metric of every fold
    fold_metrics: list[list[float]] = field(default_factory=list)

    @property
    def best(self) -> int:
        return best_index(self.metrics, self.evaluator.isLargerBetter())


#: Rows of a task at least, where many small fits run side by side.
ROWS_PER_TASK = 50_000


def _few_parts(df: DataFrame, rows: int) -> DataFrame:
    """Small inputs of many fits in few partitions: a fit is then one stage per
    iteration, and the cores work on different fits instead."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def _leading_transformers(stages: Pipeline, setting: dict) -> tuple[list, list]:
    """The stages under ``setting``: those before the first fitted one, and the rest."""
    every = stages.copy(setting).getStages()
    k = next((i for i, s in enumerate(every) if isinstance(s, Estimator)), len(every))
    return every[:k], every[k:]


def _read_by(stages: list, keep: list[str], columns: list[str]) -> list[str]:
    """``keep`` and the input columns of ``stages``; all columns where a stage
    does not name its inputs."""
    needed = set(keep)
    for s in stages:
        named = [s.getOrDefault(p) for p in ("inputCol", "inputCols") if s.hasParam(p) and s.isDefined(s.getParam(p))]
        if not named:
            return columns
        needed.update(*([n] if isinstance(n, str) else n for n in named))
    return [c for c in columns if c in needed]


def staged_search(stages: Pipeline, stage_grid: list[dict], model: Estimator, grid: list[dict],
                  evaluator: Evaluator, df: DataFrame, num_folds: int, keep: list[str],
                  fold_col: str = "fold", parallelism: int | None = None) -> SearchResult:
    """T8-T9. K-fold search over ``stage_grid`` x ``grid``, the stages fitted
    once per fold and setting on that fold's training rows only; transformers
    before the first fitted stage run once per setting.  ``keep`` are the
    columns that model and evaluator read.  The fits of all folds of a setting
    share one queue, as many at once as the cluster has cores
    (``parallelism``).  The winner is refitted on all rows."""
    spark = df.sparkSession
    points = [{**a, **b} for a in stage_grid for b in grid]
    by_fold: list[list[float]] = [[] for _ in points]
    with persisted(df) as rows, ThreadPool(parallelism or spark.sparkContext.defaultParallelism) as pool:
        n_rows = rows.count()

        def in_parallel(work, items):
            return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)

        for s, setting in enumerate(stage_grid):
            plain, rest = _leading_transformers(stages, setting)
            with ExitStack() as held:
                base = rows
                if plain:
                    done = PipelineModel(plain).transform(rows)
                    base = held.enter_context(persisted(done.select(*_read_by(rest, [*keep, fold_col], done.columns))))

                def prepare(fold):
                    train = base.where(base[fold_col] != fold)
                    fitted = Pipeline(stages=rest).fit(train)
                    return [fitted.transform(part).select(*keep) for part in (train, base.where(base[fold_col] == fold))]

                folds = [[held.enter_context(persisted(_few_parts(part, n_rows))) for part in parts]
                         for parts in in_parallel(prepare, range(num_folds))]

                def score(job):
                    point, (seen, unseen) = job
                    return evaluator.evaluate(model.fit(seen, point).transform(unseen))

                found = in_parallel(score, [(point, parts) for point in grid for parts in folds])
            for k in range(len(grid)):
                by_fold[s * len(grid) + k] = [float(m) for m in found[k * num_folds:(k + 1) * num_folds]]
        result = SearchResult(points, [sum(m) / num_folds for m in by_fold], evaluator, fold_metrics=by_fold)
        setting, point = stage_grid[result.best // len(grid)], grid[result.best % len(grid)]
        fitted = stages.fit(rows, setting)
        with persisted(_few_parts(fitted.transform(rows).select(*keep), n_rows)) as every:
            best = model.fit(every, point)
    result.best_model = PipelineModel([*fitted.stages, best])
    return result


def search_table(spark: SparkSession, found: CrossValidatorModel | SearchResult) -> DataFrame:
    """T12. One row per grid point with its params and mean metric; exactly one
    ``is_best``, chosen by the evaluator's direction (min RMSE, max AUC)."""
    if not isinstance(found, SearchResult):
        found = SearchResult(found.getEstimatorParamMaps(), [float(m) for m in found.avgMetrics], found.getEvaluator())
    rows = [(i, describe_point(p), float(m), i == found.best) for i, (p, m) in enumerate(zip(found.points, found.metrics))]
    return spark.createDataFrame(rows, SEARCH_SCHEMA)


FOLD_SCHEMA = StructType([StructField("fold", IntegerType(), False),
                          StructField("point", IntegerType(), False),
                          StructField("params", StringType(), False),
                          StructField("metric", DoubleType(), False)])


def fold_table(spark: SparkSession, found: SearchResult) -> DataFrame:
    """T6-T8. One row per fold and grid point with that fold's metric."""
    rows = [(fold, i, describe_point(p), m) for i, (p, metrics) in enumerate(zip(found.points, found.fold_metrics))
            for fold, m in enumerate(metrics)]
    return spark.createDataFrame(rows, FOLD_SCHEMA)


def fold_spread(folds: DataFrame, larger_is_better: bool) -> DataFrame:
    """T12. Per grid point the mean metric, its standard deviation over the
    folds, and ``gap``: by how many standard errors of the paired differences
    it is worse than the best point (null for the best, and without spread)."""
    points = folds.groupBy("point", "params").agg(F.avg("metric").alias("mean"), F.stddev_samp("metric").alias("spread"))
    order = F.col("mean").desc() if larger_is_better else F.col("mean").asc()
    best = points.orderBy(order, "point").limit(1).select(F.col("point").alias("best"))
    winner = folds.join(F.broadcast(best), folds["point"] == best["best"]).select("fold", F.col("metric").alias("winner"))
    worse = (F.col("winner") - F.col("metric")) * (1 if larger_is_better else -1)
    paired = folds.join(winner, "fold").groupBy("point").agg(
        F.avg(worse).alias("d"), F.stddev_samp(worse).alias("s"), F.count(F.lit(1)).alias("k"))
    gap = F.try_divide(F.col("d"), F.col("s") / F.sqrt("k"))
    return points.join(paired, "point").select("point", "params", "mean", "spread", gap.alias("gap"))
