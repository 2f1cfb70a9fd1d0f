"""Confusion counts and metrics (A1-A5, E1-E4), each returned as a small DataFrame.

``confusion_cells`` computes TN, TP, FN, FP, accuracy, precision and recall in
one aggregate pass (partial counts per task, one final merge) instead of four
filtered counts.  AUC, weighted precision and RMSE use Spark's distributed
evaluators; AUC defaults to the exact area (``numBins=0``).
"""

from __future__ import annotations

from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..session import shared_root


def confusion_matrix(pred: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction") -> DataFrame:
    """A1. ``(label, prediction, count)``."""
    return pred.groupBy(label_col, prediction_col).agg(F.count(F.lit(1)).alias("count"))


def confusion_cells(pred: DataFrame, label_col: str = "label",
                    prediction_col: str = "prediction") -> DataFrame:
    """A2-A5 in one pass. Precision / recall are null for an empty class."""
    label = F.col(label_col).cast("double")
    prediction = F.col(prediction_col).cast("double")
    cells = pred.agg(
        F.count_if((prediction == 0) & (label == prediction)).alias("tn"),
        F.count_if((prediction == 1) & (label == prediction)).alias("tp"),
        F.count_if((prediction == 0) & (label != prediction)).alias("fn"),
        F.count_if((prediction == 1) & (label != prediction)).alias("fp"),
    )
    tn, tp, fn, fp = (F.col(c) for c in ("tn", "tp", "fn", "fp"))
    return cells.select(
        "tn", "tp", "fn", "fp",
        F.try_divide((tn + tp).cast("double"), tn + tp + fn + fp).alias("accuracy"),
        F.try_divide(tp.cast("double"), tp + fp).alias("precision"),
        F.try_divide(tp.cast("double"), tp + fn).alias("recall"),
    )


def weighted_precision(pred: DataFrame, label_col: str = "label",
                       prediction_col: str = "prediction") -> float:
    """E1. Class-frequency weighted precision."""
    ev = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol=prediction_col,
                                           metricName="weightedPrecision")
    return ev.evaluate(pred)


def area_under_roc(pred: DataFrame, label_col: str = "label",
                   raw_col: str = "rawPrediction", num_bins: int = 0) -> float:
    """E2. ``num_bins=0`` gives the exact area (the default 1000 bins approximates)."""
    ev = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol=raw_col,
                                       metricName="areaUnderROC", numBins=num_bins)
    return ev.evaluate(pred)


def rmse(pred: DataFrame, label_col: str = "duration", prediction_col: str = "prediction") -> float:
    """E3."""
    return RegressionEvaluator(labelCol=label_col, predictionCol=prediction_col,
                               metricName="rmse").evaluate(pred)


# ---- exact ranks, areas and their paired comparison --------------------------------


def counts_below(scored: DataFrame, score_col: str, label_col: str = "label", by: tuple[str, ...] = ()) -> DataFrame:
    """Per distinct score (within ``by``): its positives and negatives, and how
    many of either lie below, ``(by.., score, pos, neg, pos_below, neg_below)``.

    Prefix sums over range partitions: scores are counted, dealt out in ranges,
    summed up within each range, and each range gets the totals of those
    before it (one row per range and ``by``).  No range is a single task's
    work, however many scores there are."""
    label = F.col(label_col).cast("double")
    counted = scored.groupBy(*by, F.col(score_col).alias("score")).agg(
        F.count_if(label == 1).alias("pos"), F.count_if(label != 1).alias("neg"))
    shared_root(scored.sparkSession)
    ranged = counted.repartitionByRange(*by, "score").withColumn("part", F.spark_partition_id()).checkpoint()
    totals = ranged.groupBy(*by, "part").agg(F.sum("pos").alias("part_pos"), F.sum("neg").alias("part_neg"))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "part", *(F.coalesce(F.sum(f"part_{c}").over(before), F.lit(0)).alias(f"{c}_start")
                                          for c in ("pos", "neg")))
    inside = Window.partitionBy(*by, "part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_inside") for c in ("pos", "neg")))
    joined = summed.join(starts, [*by, "part"])
    return joined.select(*by, "score", "pos", "neg", *(
        (F.col(f"{c}_start") + F.col(f"{c}_inside")).alias(f"{c}_below") for c in ("pos", "neg")))


def auc_by(scored: DataFrame, score_col: str, label_col: str = "label", by: tuple[str, ...] = ()) -> DataFrame:
    """Exact area per ``by`` (ties count one half); null without both classes."""
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return counts_below(scored, score_col, label_col, by).groupBy(*by).agg(F.try_divide(wins, pairs).alias("auc"))


def compare_auc(scored: DataFrame, first: str, second: str, label_col: str = "label") -> DataFrame:
    """E4. Two scores of the same rows: both areas, their difference, and its
    standard error from the covariance of placement values (the share of the
    other class that a row's score beats, ties one half), with z.  The error is
    null with fewer than two rows of a class."""
    rows = scored.select(F.col(label_col).cast("double").alias("label"), F.col(first).alias("a"), F.col(second).alias("b"))
    totals = rows.agg(F.count_if(F.col("label") == 1).alias("m"), F.count_if(F.col("label") != 1).alias("n")).first()
    m, n = totals["m"], totals["n"]
    # equal pairs of scores are one row, so ties never meet as rows
    pairs = rows.groupBy("a", "b", "label").agg(F.count(F.lit(1)).alias("w"))
    for name in ("a", "b"):
        below = counts_below(rows, name)
        won = F.try_divide(F.col("neg_below") + F.col("neg") / 2, F.lit(n))
        lost = F.try_divide(m - F.col("pos_below") - F.col("pos") / 2, F.lit(m))
        places = below.select(F.col("score").alias(name), won.alias(f"won_{name}"), lost.alias(f"lost_{name}"))
        pairs = pairs.join(places, name)
    is_pos = F.col("label") == 1
    va = F.when(is_pos, F.col("won_a")).otherwise(F.col("lost_a"))
    vb = F.when(is_pos, F.col("won_b")).otherwise(F.col("lost_b"))
    gap = va - vb
    side = pairs.groupBy("label").agg(
        F.sum("w").alias("k"), (F.sum(F.col("w") * va) / F.sum("w")).alias("mean_a"), (F.sum(F.col("w") * vb) / F.sum("w")).alias("mean_b"),
        F.sum(F.col("w") * gap).alias("s"), F.sum(F.col("w") * gap * gap).alias("ss"))
    spread = F.try_divide(F.col("ss") - F.col("s") * F.col("s") / F.col("k"), F.col("k") - 1) / F.col("k")
    out = side.agg(F.max(F.when(F.col("label") == 1, F.col("mean_a"))).alias("auc_first"),
                   F.max(F.when(F.col("label") == 1, F.col("mean_b"))).alias("auc_second"),
                   F.when(F.count(spread) == 2, F.sqrt(F.greatest(F.sum(spread), F.lit(0.0)))).alias("std_error"))
    difference = F.col("auc_first") - F.col("auc_second")
    return out.select("auc_first", "auc_second", difference.alias("difference"), "std_error",
                      F.try_divide(difference, F.col("std_error")).alias("z"))


METRIC_SCHEMA = StructType([StructField("model", StringType(), False),
                            StructField("metric", StringType(), False),
                            StructField("value", DoubleType(), True)])


def metric_table(spark: SparkSession, rows: list[tuple[str, str, float]]) -> DataFrame:
    """E4. ``(model, metric, value)`` rows, e.g. AUC of two models on one test set."""
    return spark.createDataFrame([(m, k, float(v)) for m, k, v in rows], METRIC_SCHEMA)
