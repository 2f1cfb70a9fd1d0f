"""Model families (M1-M11) with the defaults the exercises rely on.

All fitting is Spark ML's distributed training: linear models solve the normal
equations from one tree-aggregated pass (``solver='auto'`` below 4096 features)
or iterate L-BFGS / OWL-QN with one aggregate per step; tree learners bin the
features once and grow each level with one aggregate pass.  GBT checkpoints
its running margins every ``checkpointInterval`` rounds into the shared
checkpoint folder, which cuts lineage and survives executor loss.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame

from ..functions.partitioning import persisted


def decision_tree(**params) -> DecisionTreeClassifier:
    """M1. Defaults: depth 5, 32 bins, Gini."""
    return DecisionTreeClassifier(**params)


def logistic(**params) -> LogisticRegression:
    """M2 (no penalty) and M3 (``regParam=0.2``)."""
    return LogisticRegression(**params)


def linear(label_col: str = "duration", **params) -> LinearRegression:
    """M4-M9. ``regParam`` with ``elasticNetParam`` 0 (ridge), 1 (lasso) or between."""
    return LinearRegression(labelCol=label_col, **params)


def boosted_trees(**params) -> GBTClassifier:
    """M10. Defaults: 20 rounds of depth-5 regression trees on the log-loss."""
    return GBTClassifier(**params)


def random_forest(**params) -> RandomForestClassifier:
    """M11. Defaults: 20 bootstrapped trees of depth 5."""
    return RandomForestClassifier(**params)


def fit_and_score(estimator: Estimator, train: DataFrame, test: DataFrame) -> tuple[Model, DataFrame]:
    """Fit on ``train`` only (persisted for the fit's passes, released after),
    then score ``test`` (a projection: no shuffle)."""
    with persisted(train) as rows:
        model = estimator.fit(rows)
    return model, model.transform(test)
