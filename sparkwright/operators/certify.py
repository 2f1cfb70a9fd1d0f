"""Sums that show whether a fitted linear model is at its optimum.

Nothing is solved here.  One aggregate over the stored slots of the feature
vectors gives the gradient of the fit's objective (``slot_gradients``), or all
sums of products of pairs of slots (``gram_table``), from which the conditions
of a penalised fit follow per slot (``subgradients``).  Rows are never
collected: the results have a row per slot or pair of slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import sparse_slots
from ..session import shared_root

INTERCEPT = -1


def slot_gradients(scored: DataFrame, error: Column, features_col: str = "features") -> DataFrame:
    """Per slot that any row stores, and for the intercept (slot -1):
    ``(slot, n_rows, gradient, std)``: rows that store it, the mean of
    ``error * x`` over all rows, and the sample standard deviation of the column
    (null for the intercept).  One pass; slots are combined before the shuffle."""
    rows = scored.select(error.alias("e"), sparse_slots(features_col).alias("slots"))
    ones = F.array(F.struct(F.lit(INTERCEPT).alias("slot"), F.lit(1.0).alias("value")))
    sums = rows.select("e", F.inline(F.concat(ones, F.col("slots")))).groupBy("slot").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("e") * F.col("value")).alias("ex"),
        F.sum("value").alias("x"), F.sum(F.col("value") * F.col("value")).alias("xx"))
    total = sums.where(F.col("slot") == INTERCEPT).select(F.col("n_rows").alias("n"))
    variance = (F.col("xx") - F.col("x") * F.col("x") / F.col("n")) / (F.col("n") - 1)
    return sums.join(F.broadcast(total), how="cross").select(  # one row
        "slot", "n_rows", (F.col("ex") / F.col("n")).alias("gradient"),
        F.when(F.col("slot") != INTERCEPT, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("std"))


def gram_table(df: DataFrame, target: str, features_col: str = "features", by: tuple[str, ...] = ()) -> DataFrame:
    """Sums of products of all pairs of columns, ``(by.., i, j, s)`` with
    ``i <= j``: slots of the vector, -1 the constant 1, -2 the target.  Pairs
    that no row stores are absent.  One aggregate, combined before its shuffle:
    a row makes as many pairs as it has stored slots, squared and halved.  The
    table is written once to the shared checkpoint folder: its readers take it
    several times, and would pass over the rows again each time."""
    own = F.array(F.struct(F.lit(-2).alias("slot"), F.col(target).cast("double").alias("value")),
                  F.struct(F.lit(-1).alias("slot"), F.lit(1.0).alias("value")))
    # Stored slots ascend, so the pairs of a slot are those from its place on.
    # explode_outer + filter: a plain explode makes Catalyst test the array's size
    # below, computing the vector twice per row.
    rows = df.select(*by, F.concat(own, sparse_slots(features_col)).alias("v"))
    firsts = rows.select(*by, "v", F.posexplode_outer("v").alias("k", "a")).where(F.col("a").isNotNull())
    pairs = firsts.select(*by, "a", F.explode_outer(F.slice("v", F.col("k") + 1, F.size("v"))).alias("b"))
    table = pairs.groupBy(*by, F.col("a.slot").alias("i"), F.col("b.slot").alias("j")).agg(
        F.sum(F.col("a.value") * F.col("b.value")).alias("s"))
    shared_root(df.sparkSession)
    return table.checkpoint()


def training_systems(by_fold: DataFrame, fold_col: str = "fold") -> DataFrame:
    """For each fold the sums over all other folds, total minus fold: what a
    cross-validated least-squares fit of that fold is solved from."""
    total = by_fold.groupBy("i", "j").agg(F.sum("s").alias("total"))
    folds = by_fold.select(fold_col).distinct()
    every = total.join(F.broadcast(folds), how="cross")  # folds are few
    own = by_fold.select(fold_col, "i", "j", "s")
    return every.join(own, [fold_col, "i", "j"], "left").select(
        fold_col, "i", "j", (F.col("total") - F.coalesce("s", F.lit(0.0))).alias("s"))


def _symmetric(gram: DataFrame) -> DataFrame:
    turned = gram.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "s")
    return gram.select("i", "j", "s").unionByName(turned)


def subgradients(gram: DataFrame, model, reg_param: float, l1_share: float = 1.0) -> DataFrame:
    """The conditions of a penalised least-squares fit in standardised units,
    one row per slot that varies: ``(slot, coefficient, gradient, bound, slack)``.

    ``gradient`` is the correlation of the column with the residual (in units of
    the target's deviation), less the ridge part.  At the optimum it equals
    ``bound`` with the coefficient's sign, or lies within the bound for a zero
    coefficient; ``slack`` is the distance from that, 0 if it holds."""
    spark = gram.sparkSession
    weights = [(-1, float(model.intercept)), *((k, float(b)) for k, b in enumerate(model.coefficients.toArray()))]
    beta = spark.createDataFrame(weights, "j int, b double")
    full = _symmetric(gram)
    fitted = full.join(F.broadcast(beta), "j").groupBy("i").agg(F.sum(F.col("s") * F.col("b")).alias("xf"))
    firsts = full.where("j = -1").select("i", F.col("s").alias("x"))
    squares = full.where("i = j").select("i", F.col("s").alias("xx"))
    targets = full.where("j = -2").select("i", F.col("s").alias("xy"))
    label = full.where("i < 0").agg(  # one row: rows, mean and deviation of the target
        F.max(F.when((F.col("i") == -1) & (F.col("j") == -1), F.col("s"))).alias("n"),
        F.max(F.when((F.col("i") == -1) & (F.col("j") == -2), F.col("s"))).alias("y"),
        F.max(F.when((F.col("i") == -2) & (F.col("j") == -2), F.col("s"))).alias("yy"))
    label = label.select("n", (F.col("y") / F.col("n")).alias("my"),
                         F.sqrt(F.col("yy") / F.col("n") - (F.col("y") / F.col("n")) ** 2).alias("sy"))
    rows = squares.where("i >= 0").join(firsts, "i").join(targets, "i").join(fitted, "i")
    rows = rows.join(F.broadcast(label), how="cross").join(F.broadcast(beta.withColumnRenamed("j", "i")), "i")
    s = F.sqrt(F.col("xx") / F.col("n") - (F.col("x") / F.col("n")) ** 2)
    rows = rows.withColumn("sx", s).where("sx > 0")
    standard = F.col("b") * F.col("sx") / F.col("sy")
    lam = F.lit(float(reg_param)) / F.col("sy")
    # the intercept makes the residuals sum to 0, so the mean of x drops out
    residual = (F.col("xy") - F.col("xf")) / F.col("n") / (F.col("sx") * F.col("sy"))
    gradient = residual - lam * (1 - l1_share) * standard
    bound = lam * l1_share
    slack = F.when(F.col("b") == 0, F.greatest(F.abs("gradient") - F.col("bound"), F.lit(0.0))).otherwise(
        F.abs(F.col("gradient") - F.signum("b") * F.col("bound")))
    return rows.select(F.col("i").alias("slot"), "b", gradient.alias("gradient"), bound.alias("bound")).withColumn("slack", slack).select(
        "slot", F.col("b").alias("coefficient"), "gradient", "bound", "slack")
