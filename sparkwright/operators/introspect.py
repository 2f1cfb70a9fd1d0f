"""What a fitted model learned, as small DataFrames.

Model state is already on the driver after ``fit``; these functions only lay
it out as rows (one per coefficient, tree, feature or parameter), so their size
is bounded by the model, never by the data.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                               StructType)

from ..functions.vectors import feature_names

COEFFICIENT_SCHEMA = StructType([
    StructField("position", IntegerType(), False),
    StructField("term", StringType(), False),
    StructField("coefficient", DoubleType(), False),
])


def coefficient_table(spark: SparkSession, model, names: list[str]) -> DataFrame:
    """I1. ``(position, term, coefficient)``; the intercept is position -1."""
    rows = [(-1, "intercept", float(model.intercept))]
    rows += [(i, names[i] if i < len(names) else f"slot_{i}", float(b))
             for i, b in enumerate(model.coefficients.toArray())]
    return spark.createDataFrame(rows, COEFFICIENT_SCHEMA)


def names_for(df: DataFrame, features_col: str = "features") -> list[str]:
    return feature_names(df, features_col)


def speed_table(coefficients: DataFrame, term: str = "km") -> DataFrame:
    """I2. Minutes per km and km per hour from the distance slope."""
    slope = F.col("coefficient")
    return coefficients.filter(F.col("term") == term).select(
        slope.alias("minutes_per_km"), F.try_divide(F.lit(60.0), slope).alias("km_per_hour"))


def _effect(by_name: dict[str, float], prefix: str, labels: list[str], level: str) -> float:
    """Dummy coefficient of a level; 0 for the dropped one (the last label)."""
    if level not in labels:
        raise KeyError(f"no level {level!r}")
    return 0.0 if level == labels[-1] else by_name[f"{prefix}{level}"]


def level_effects(spark: SparkSession, model, names: list[str], prefix: str, labels: list[str],
                  levels: list[str] | None = None) -> DataFrame:
    """I3. Intercept plus the dummy coefficient of each of ``levels`` (all by
    default), looked up by name.  ``labels`` are all levels in index order, the
    dropped one last; a name that is none of them raises."""
    by_name = dict(zip(names, (float(b) for b in model.coefficients.toArray())))
    base = float(model.intercept)
    schema = StructType([StructField("level", StringType(), False),
                         StructField("effect", DoubleType(), False)])
    return spark.createDataFrame(
        [(lvl, base + _effect(by_name, prefix, labels, lvl)) for lvl in levels or labels], schema)


def level_effects_2(spark: SparkSession, model, names: list[str], first: tuple[str, str, list[str]],
                    second: tuple[str, str, list[str]], pairs: list[tuple[str, str]]) -> DataFrame:
    """I3 for two one-hot factors: intercept + dummy of each factor's level for
    the wanted ``pairs``.  ``first`` / ``second`` are ``(output column, dummy
    name prefix, labels)`` as in ``level_effects``."""
    by_name = dict(zip(names, (float(b) for b in model.coefficients.toArray())))
    base = float(model.intercept)
    (col_a, prefix_a, labels_a), (col_b, prefix_b, labels_b) = first, second
    rows = [(a, b, base + _effect(by_name, prefix_a, labels_a, a) + _effect(by_name, prefix_b, labels_b, b))
            for a, b in pairs]
    schema = StructType([StructField(col_a, StringType(), False), StructField(col_b, StringType(), False),
                         StructField("effect", DoubleType(), False)])
    return spark.createDataFrame(rows, schema)


def zero_count(spark: SparkSession, model) -> DataFrame:
    """I4. Number of coefficients that are exactly zero."""
    coefs = [float(b) for b in model.coefficients.toArray()]
    schema = StructType([StructField("n_coefficients", IntegerType(), False),
                         StructField("n_zero", IntegerType(), False)])
    return spark.createDataFrame([(len(coefs), sum(1 for b in coefs if b == 0.0))], schema)


def tree_summary(spark: SparkSession, model) -> DataFrame:
    """I5. Tree count and nodes of a tree ensemble (or a single tree)."""
    trees = getattr(model, "trees", None) or [model]
    schema = StructType([StructField("num_trees", IntegerType(), False),
                         StructField("total_nodes", IntegerType(), False),
                         StructField("max_depth", IntegerType(), False)])
    return spark.createDataFrame(
        [(len(trees), sum(t.numNodes for t in trees), max(t.depth for t in trees))], schema)


def feature_importance(spark: SparkSession, model, names: list[str]) -> DataFrame:
    """I6. ``(feature, importance)``; importances sum to 1."""
    imp = model.featureImportances.toArray()
    schema = StructType([StructField("feature", StringType(), False),
                         StructField("importance", DoubleType(), False)])
    return spark.createDataFrame([(names[i] if i < len(names) else f"slot_{i}", float(v))
                                  for i, v in enumerate(imp)], schema)


def _render(value) -> str:
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(_render(v) for v in value) + "]"
    return str(value)


def stage_params(spark: SparkSession, model, only_set: bool = True) -> DataFrame:
    """I7. ``(stage, stage_class, param, value)`` for each stage of a fitted
    pipeline (or one model); ``only_set`` keeps explicitly set parameters."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    rows = []
    for i, stage in enumerate(stages):
        for param, value in stage.extractParamMap().items():
            if only_set and not stage.isSet(param):
                continue
            rows.append((i, type(stage).__name__, param.name, _render(value)))
    schema = StructType([StructField("stage", IntegerType(), False),
                         StructField("stage_class", StringType(), False),
                         StructField("param", StringType(), False),
                         StructField("value", StringType(), False)])
    return spark.createDataFrame(rows, schema)
