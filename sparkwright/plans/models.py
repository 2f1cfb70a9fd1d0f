"""Queries for models, inspection, confusion counts and metrics (M, I, A1-A5, P4, E).

Oracle design (see SURVEY 7.4): models with a closed form are checked exactly;
iterative or randomised ones (default trees, forests, boosting, lasso on many
features) are checked by row count here and by invariants in tests.

* least squares on km + origin: within-origin (Frisch-Waugh-Lovell) slope and
  per-origin means;
* many-dummy least squares: residuals orthogonal to every feature column;
* km + two crossed factors (level effects): the same least squares fitted in
  SQL by cyclic block updates (``oracle.two_factor_fit``);
* one-predictor lasso / ridge / elastic net: soft-threshold formula in
  standardized units with the penalty scaled by the label's population std;
  the 29-column lasso by coordinate descent on the correlation matrix;
* single-split tree, boosted stump, one-tree forest without bootstrap on the
  departure bucket: best Gini cut and leaf class counts;
* logistic on origin dummies only: saturated, probability = origin's mean label;
* default logistic on three numeric columns: the likelihood maximised in SQL
  by coordinate Newton steps (predicted classes compared).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.partitioning import persisted
from ..operators import certify, evaluate, features, introspect, models, prep, tune
from . import oracle as o
from .common import KEY, one_row, p1, plain_bucket, r, split

# ---- shared fits ---------------------------------------------------------------

CLASS_FEATURES = ["mon", "depart", "duration"]


def _stump_scored(spark, sf_dir, estimator):
    train, test = split(spark, sf_dir)
    train = features.assemble(plain_bucket(train), ["depart_bucket"])
    test = features.assemble(plain_bucket(test), ["depart_bucket"])
    return models.fit_and_score(estimator, train, test)


def _stump_tree():
    return models.decision_tree(maxDepth=1)


def _stump_gbt():
    return models.boosted_trees(maxIter=1, maxDepth=1)


def _stump_forest():
    return models.random_forest(numTrees=1, bootstrap=False, maxDepth=1)


def _class_scored(spark, sf_dir, estimator):
    train, test = split(spark, sf_dir)
    return models.fit_and_score(estimator, features.assemble(train, CLASS_FEATURES).select("features", "label"),
                                features.assemble(test, CLASS_FEATURES))


def _by_origin_logistic(spark, sf_dir):
    train, test = split(spark, sf_dir)
    stages = Pipeline(stages=[
        StringIndexer(inputCol="org", outputCol="org_idx"),
        OneHotEncoder(inputCols=["org_idx"], outputCols=["org_dummy"]),
        VectorAssembler(inputCols=["org_dummy"], outputCol="features"),
        models.logistic(tol=1e-10),
    ])
    return models.fit_and_score(stages, train, test)


def _km_model(spark, sf_dir, **params):
    train, test = split(spark, sf_dir)
    train = features.assemble(train, ["km"])
    test = features.assemble(test, ["km"])
    model, pred = models.fit_and_score(models.linear("duration", **params), train, test)
    return model, pred, train


def _km_org_model(spark, sf_dir):
    train, test = split(spark, sf_dir)
    pipe = tune.regression_stages("org", (), ("km",), "duration")
    with persisted(train) as rows:
        fitted = pipe.fit(rows)
    return fitted, fitted.transform(test), train


def _dummies_model(spark, sf_dir, extra_raw: tuple[str, ...], **params):
    """km + origin + departure-bucket dummies (+ raw int columns one-hot)."""
    train, test = split(spark, sf_dir)
    train = features.bucketize(train, "depart", "depart_bucket")
    test = features.bucketize(test, "depart", "depart_bucket")
    raw = ("depart_bucket", *extra_raw)
    pipe = tune.regression_stages("org", raw, ("km",), "duration",
                                  regression=models.linear("duration", **params))
    with persisted(train) as rows:
        fitted = pipe.fit(rows)
    return fitted, train, test


def _scores(pred: DataFrame, *cols) -> DataFrame:
    return pred.select(KEY, "label", "prediction", *cols)


# ---- M: models ------------------------------------------------------------------

def m1_tree_stump(spark, sf_dir):
    _, pred = _stump_scored(spark, sf_dir, _stump_tree())
    return _scores(pred, r(p1()).alias("p1"))


def m1_tree_default(spark, sf_dir):
    _, pred = _class_scored(spark, sf_dir, models.decision_tree())
    return _scores(pred)


def _default_logistic(spark, sf_dir):
    """The default logistic model, its solver run to the optimum."""
    _, pred = _class_scored(spark, sf_dir, models.logistic(tol=1e-10, maxIter=1000))
    return pred


def m2_logistic_default(spark, sf_dir):
    return _scores(_default_logistic(spark, sf_dir), r(p1(), 4).alias("p1"))


def a2_confusion_logistic(spark, sf_dir):
    return evaluate.confusion_cells(_default_logistic(spark, sf_dir))


def e2_auc_logistic(spark, sf_dir):
    pred = _default_logistic(spark, sf_dir)
    return one_row(spark, auc=evaluate.area_under_roc(pred)).select(r("auc").alias("auc"))


def m2_logistic_by_origin(spark, sf_dir):
    _, pred = _by_origin_logistic(spark, sf_dir)
    return _scores(pred, r(p1()).alias("p1"))


def m4_linear_km(spark, sf_dir):
    model, _, _ = _km_model(spark, sf_dir)
    return introspect.coefficient_table(spark, model, ["km"]).withColumn("coefficient", r("coefficient"))


def m5_linear_km_org(spark, sf_dir):
    _, pred, _ = _km_org_model(spark, sf_dir)
    return pred.select(KEY, r("prediction", 4).alias("prediction"))


def _residual_cosines(fitted, train: DataFrame) -> DataFrame:
    """For each feature slot (and the intercept as slot -1): rows with the slot
    non-zero, and |cos| between that column and the training residuals.  Least
    squares makes every cosine zero.  One aggregate with three sums per slot
    (the model's width is known), laid out as rows afterwards."""
    width = len(introspect.names_for(fitted.transform(train.limit(0))))
    resid = F.col("duration") - F.col("prediction")
    rows = fitted.transform(train).select(resid.alias("resid"), vector_to_array(F.col("features")).alias("x"))
    columns = [F.lit(1.0), *(F.col("x")[i] for i in range(width))]
    slots = [F.struct(F.lit(i - 1).alias("slot"), F.count_if(x != 0).alias("n_nonzero"),
                      F.sum(x * F.col("resid")).alias("xr"), F.sum(x * x).alias("xx")) for i, x in enumerate(columns)]
    agg = rows.agg(F.array(*slots).alias("slots"), F.sum(F.col("resid") * F.col("resid")).alias("rr"))
    long = agg.select("rr", F.inline("slots"))
    cos = F.abs(F.col("xr")) / F.sqrt(F.col("xx") * F.col("rr"))
    return long.select("slot", "n_nonzero", r(cos).alias("cos_residual"))


def m6_linear_depart(spark, sf_dir):
    fitted, train, _ = _dummies_model(spark, sf_dir, ())
    return _residual_cosines(fitted, train)


def m6_linear_depart_scored(spark, sf_dir):
    """Test predictions of the model on km, origin and departure bucket."""
    fitted, _, test = _dummies_model(spark, sf_dir, ())
    return fitted.transform(test).select(KEY, r("prediction", 4).alias("prediction"))


def m7_linear_all(spark, sf_dir):
    fitted, train, _ = _dummies_model(spark, sf_dir, ("dow", "mon"))
    return _residual_cosines(fitted, train)


def m7_linear_all_scored(spark, sf_dir):
    """Test predictions of the model on km and all dummies."""
    fitted, _, test = _dummies_model(spark, sf_dir, ("dow", "mon"))
    return fitted.transform(test).select(KEY, r("prediction", 4).alias("prediction"))


def e3_rmse_all(spark, sf_dir):
    """Test RMSE on km and all dummies: least squares, and the lasso (run to
    its optimum)."""
    rows = []
    for name, params in (("linear_all", {}), ("lasso_all", {"regParam": LASSO_REG_PARAM, "elasticNetParam": 1.0,
                                                            "tol": 1e-12, "maxIter": 1000})):
        fitted, _, test = _dummies_model(spark, sf_dir, ("dow", "mon"), **params)
        rows.append((name, "rmse", evaluate.rmse(fitted.transform(test))))
    return evaluate.metric_table(spark, rows).withColumn("value", r("value", 5))


def m8_lasso_km(spark, sf_dir):
    model, _, _ = _km_model(spark, sf_dir, regParam=LASSO_REG_PARAM, elasticNetParam=1.0)
    return introspect.coefficient_table(spark, model, ["km"]).withColumn("coefficient", r("coefficient"))


REG_PARAMS = [0.01, 0.1, 1.0, 10.0]     # fixed values: the regularisation grid of the exercises
LASSO_REG_PARAM = 1.0                   # fixed value: the exercises' lasso strength
MIX_PARAMS = [0.0, 0.5, 1.0]


def m9_elastic_net_km(spark, sf_dir):
    """Ridge, elastic net and lasso on km over the exercises' 4 x 3 grid: one
    pass per fit (normal equations, then a local solve on the driver)."""
    train, _ = split(spark, sf_dir)
    rows = []
    with persisted(features.assemble(train, ["km"]).select("features", "duration")) as fit_rows:
        for lam in REG_PARAMS:
            for mix in MIX_PARAMS:
                m = models.linear("duration", regParam=lam, elasticNetParam=mix).fit(fit_rows)
                rows.append((lam, mix, float(m.intercept), float(m.coefficients[0])))
    schema = StructType([StructField(c, DoubleType(), False)
                         for c in ("reg_param", "elastic_net", "intercept", "slope")])
    out = spark.createDataFrame(rows, schema)
    return out.select("reg_param", "elastic_net", r("intercept").alias("intercept"), r("slope").alias("slope"))


def m10_gbt_stump(spark, sf_dir):
    _, pred = _stump_scored(spark, sf_dir, _stump_gbt())
    return _scores(pred, r(p1()).alias("p1"))


def m10_gbt_default(spark, sf_dir):
    _, pred = _class_scored(spark, sf_dir, models.boosted_trees())
    return _scores(pred)


def m11_forest_stump(spark, sf_dir):
    _, pred = _stump_scored(spark, sf_dir, _stump_forest())
    return _scores(pred, r(p1()).alias("p1"))


def m11_forest_default(spark, sf_dir):
    _, pred = _class_scored(spark, sf_dir, models.random_forest())
    return _scores(pred)


# ---- I: inspection ----------------------------------------------------------------

def i1_coefficients(spark, sf_dir):
    fitted, _, train = _km_org_model(spark, sf_dir)
    names = introspect.names_for(fitted.transform(train.limit(0)))
    table = introspect.coefficient_table(spark, fitted.stages[-1], names)
    return table.withColumn("coefficient", r("coefficient"))


def i2_speed(spark, sf_dir):
    km_model, _, _ = _km_model(spark, sf_dir)
    fitted, _, _ = _km_org_model(spark, sf_dir)
    out = None
    for name, model in (("km_only", km_model), ("km_org", fitted.stages[-1])):
        table = introspect.speed_table(introspect.coefficient_table(spark, model, ["km"]))
        row = table.select(F.lit(name).alias("model"), r("minutes_per_km").alias("minutes_per_km"),
                           r("km_per_hour", 4).alias("km_per_hour"))
        out = row if out is None else out.unionByName(row)
    return out


def i3_level_effects(spark, sf_dir):
    fitted, _, train = _km_org_model(spark, sf_dir)
    names = introspect.names_for(fitted.transform(train.limit(0)))
    labels = fitted.stages[0].labelsArray[0]
    out = introspect.level_effects(spark, fitted.stages[-1], names, "org_dummy_", list(labels))
    return out.withColumn("effect", r("effect"))


def i3_level_effects_depart(spark, sf_dir):
    """Ground minutes of the (origin, departure bucket) pairs that the training
    rows have, from the km + origin + departure model (intercept + both
    dummies, looked up by name)."""
    fitted, train, _ = _dummies_model(spark, sf_dir, ())
    names = introspect.names_for(fitted.transform(train.limit(0)))
    orgs = list(fitted.stages[0].labelsArray[0])
    buckets = list(train.schema["depart_bucket"].metadata["ml_attr"]["vals"])
    seen = train.select("org", F.col("depart_bucket").cast("int").alias("b")).distinct().collect()
    out = introspect.level_effects_2(spark, fitted.stages[-1], names,
                                     ("org", "org_dummy_", orgs),
                                     ("depart", "depart_bucket_dummy_", buckets),
                                     sorted((x.org, buckets[x.b]) for x in seen))
    return out.withColumn("effect", r("effect"))


def i4_zero_coefficients(spark, sf_dir):
    fitted, _, _ = _dummies_model(spark, sf_dir, ("dow", "mon"), regParam=LASSO_REG_PARAM,
                                  elasticNetParam=1.0)
    return introspect.zero_count(spark, fitted.stages[-1])


def m8_kkt(spark, sf_dir):
    """The lasso on km and all dummies, run to its optimum, with the conditions
    of that optimum per column, from the sums of products of its columns."""
    fitted, train, _ = _dummies_model(spark, sf_dir, ("dow", "mon"), regParam=LASSO_REG_PARAM, elasticNetParam=1.0,
                                      tol=1e-12, maxIter=1000)
    gram = certify.gram_table(fitted.transform(train), "duration")
    table = certify.subgradients(gram, fitted.stages[-1], LASSO_REG_PARAM)
    return table.select("slot", *(r(c, 5).alias(c) for c in ("coefficient", "gradient", "bound", "slack")))


def i5_tree_count(spark, sf_dir):
    model, _ = _class_scored(spark, sf_dir, models.boosted_trees())
    return introspect.tree_summary(spark, model)


def i6_feature_importance(spark, sf_dir):
    model, _ = _class_scored(spark, sf_dir, models.boosted_trees())
    return introspect.feature_importance(spark, model, CLASS_FEATURES).withColumn(
        "importance", r("importance"))


def i7_stage_params(spark, sf_dir):
    fitted, _, _ = _km_org_model(spark, sf_dir)
    return introspect.stage_params(spark, fitted)


# ---- A1-A5, P4: confusion on the single-split tree -----------------------------------

def a1_confusion_matrix(spark, sf_dir):
    _, pred = _stump_scored(spark, sf_dir, _stump_tree())
    return evaluate.confusion_matrix(pred)


def a2_confusion_cells(spark, sf_dir):
    _, pred = _stump_scored(spark, sf_dir, _stump_tree())
    return evaluate.confusion_cells(pred)


def p4_compound_filter(spark, sf_dir):
    _, pred = _stump_scored(spark, sf_dir, _stump_tree())
    return prep.where(pred, "prediction = 0 AND label <> prediction").select(KEY, "label", "prediction")


# ---- E: evaluators ----------------------------------------------------------------------

def e1_weighted_precision(spark, sf_dir):
    _, pred = _stump_scored(spark, sf_dir, _stump_tree())
    return one_row(spark, weighted_precision=evaluate.weighted_precision(pred)).select(
        r("weighted_precision").alias("weighted_precision"))


def e2_auc(spark, sf_dir):
    _, pred = _by_origin_logistic(spark, sf_dir)
    return one_row(spark, auc=evaluate.area_under_roc(pred)).select(r("auc").alias("auc"))


def e3_rmse(spark, sf_dir):
    _, km_pred, _ = _km_model(spark, sf_dir)
    _, org_pred, _ = _km_org_model(spark, sf_dir)
    return evaluate.metric_table(spark, [("km_only", "rmse", evaluate.rmse(km_pred)),
                                         ("km_org", "rmse", evaluate.rmse(org_pred))]).withColumn(
        "value", r("value"))


def e4_compare_auc(spark, sf_dir):
    rows = []
    for name, est in (("tree", _stump_tree()), ("gbt", _stump_gbt()), ("forest", _stump_forest())):
        _, pred = _stump_scored(spark, sf_dir, est)
        rows.append((name, "auc", evaluate.area_under_roc(pred)))
    return evaluate.metric_table(spark, rows).withColumn("value", r("value"))


def e4_compare_auc_default(spark, sf_dir):
    """Default tree vs default boosted trees on (mon, depart, duration), scored
    on the same test rows by exact AUC of their raw predictions."""
    rows = []
    for name, est in (("tree", models.decision_tree()), ("gbt", models.boosted_trees())):
        _, pred = _class_scored(spark, sf_dir, est)
        rows.append((name, "auc", evaluate.area_under_roc(pred)))
    return evaluate.metric_table(spark, rows).withColumn("value", r("value"))


QUERIES = {
    "m1_tree_stump": m1_tree_stump,
    "m1_tree_default": m1_tree_default,
    "m2_logistic_default": m2_logistic_default,
    "m7_linear_all_scored": m7_linear_all_scored,
    "e3_rmse_all": e3_rmse_all,
    "a2_confusion_logistic": a2_confusion_logistic,
    "e2_auc_logistic": e2_auc_logistic,
    "m2_logistic_by_origin": m2_logistic_by_origin,
    "m4_linear_km": m4_linear_km,
    "m5_linear_km_org": m5_linear_km_org,
    "m6_linear_depart": m6_linear_depart,
    "m6_linear_depart_scored": m6_linear_depart_scored,
    "m7_linear_all": m7_linear_all,
    "m8_lasso_km": m8_lasso_km,
    "m9_elastic_net_km": m9_elastic_net_km,
    "m10_gbt_stump": m10_gbt_stump,
    "m10_gbt_default": m10_gbt_default,
    "m11_forest_stump": m11_forest_stump,
    "m11_forest_default": m11_forest_default,
    "i1_coefficients": i1_coefficients,
    "i2_speed": i2_speed,
    "i3_level_effects": i3_level_effects,
    "i3_level_effects_depart": i3_level_effects_depart,
    "i4_zero_coefficients": i4_zero_coefficients,
    "m8_kkt": m8_kkt,
    "i5_tree_count": i5_tree_count,
    "i6_feature_importance": i6_feature_importance,
    "i7_stage_params": i7_stage_params,
    "a1_confusion_matrix": a1_confusion_matrix,
    "a2_confusion_cells": a2_confusion_cells,
    "p4_compound_filter": p4_compound_filter,
    "e1_weighted_precision": e1_weighted_precision,
    "e2_auc": e2_auc,
    "e3_rmse": e3_rmse,
    "e4_compare_auc": e4_compare_auc,
    "e4_compare_auc_default": e4_compare_auc_default,
}

# ---- oracle ------------------------------------------------------------------------------

_STUMP = o.SPLIT + """,
tr AS (SELECT CAST(least(floor(depart / 3), 7) AS DOUBLE) AS b, label FROM train),
bs AS (SELECT b, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS pos FROM tr GROUP BY b),
cum AS (SELECT b, sum(n) OVER (ORDER BY b) AS nl, sum(pos) OVER (ORDER BY b) AS pl,
               sum(n) OVER () AS nt, sum(pos) OVER () AS pt FROM bs),
cand AS (SELECT b AS cut, nl, pl, nt - nl AS nr, pt - pl AS pr FROM cum WHERE nl < nt),
gini AS (SELECT *, (nl * (1 - (pl / nl) * (pl / nl) - ((nl - pl) / nl) * ((nl - pl) / nl))
                  + nr * (1 - (pr / nr) * (pr / nr) - ((nr - pr) / nr) * ((nr - pr) / nr))) / (nl + nr) AS wimp
         FROM cand),
best AS (SELECT * FROM gini ORDER BY wimp, cut LIMIT 1),
leaves AS (SELECT 0 AS side, nl AS n, pl AS pos, cut FROM best
           UNION ALL SELECT 1 AS side, nr AS n, pr AS pos, cut FROM best),
stump AS (
  SELECT t.event_id, t.label, l.n, l.pos, l.pos / l.n AS p,
         CASE WHEN l.pos > l.n - l.pos THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tree_prediction
  FROM test t JOIN leaves l
    ON (CASE WHEN least(floor(t.depart / 3), 7) <= l.cut THEN 0 ELSE 1 END) = l.side)"""


def _auc(source: str, score: str) -> str:
    """Exact ROC area by rank sums over distinct scores (ties count one half)."""
    return f"""(
  SELECT sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg))
  FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT {score} AS score, CAST(sum(label) AS DOUBLE) AS pos,
                     CAST(count(*) - sum(label) AS DOUBLE) AS neg
              FROM {source} GROUP BY 1)))"""


_FWL = o.SPLIT + """,
g AS (SELECT org, avg(km) AS mx, avg(duration) AS my, count(*) AS n FROM train GROUP BY org),
s AS (SELECT sum((t.km - g.mx) * (t.duration - g.my)) / sum((t.km - g.mx) * (t.km - g.mx)) AS slope
      FROM train t JOIN g ON t.org = g.org),
lvl AS (SELECT org, mx, my, n, my - (SELECT slope FROM s) * mx AS effect,
               row_number() OVER (ORDER BY n DESC, org) - 1 AS i, count(*) OVER () AS levels FROM g),
base AS (SELECT effect AS intercept FROM lvl WHERE i = levels - 1),
fwl_test AS (SELECT t.event_id, t.duration, l.effect + (SELECT slope FROM s) * t.km AS prediction
             FROM test t JOIN lvl l ON t.org = l.org)"""

_OLS_KM = o.SPLIT + """,
ols AS (SELECT regr_intercept(duration, km) AS a, regr_slope(duration, km) AS b FROM train)"""

_ST = o.SPLIT + """,
st AS (SELECT avg(km) AS mx, avg(duration) AS my, covar_pop(duration, km) AS c,
              stddev_pop(km) AS sx, stddev_pop(duration) AS sy FROM train)"""

_DUMMY_SLOTS = o.SPLIT + """,
idx AS (SELECT org, row_number() OVER (ORDER BY count(*) DESC, org) - 1 AS i,
               count(*) OVER () AS levels, count(*) AS n FROM train GROUP BY org),
lv AS (SELECT max(levels) AS levels FROM idx),
bk AS (SELECT CAST(least(floor(depart / 3), 7) AS INTEGER) AS b, count(*) AS n FROM train GROUP BY 1),
dw AS (SELECT dow, count(*) AS n, max(dow) OVER () AS top FROM train GROUP BY dow),
mo AS (SELECT mon, count(*) AS n, max(mon) OVER () AS top FROM train GROUP BY mon),
slots AS (
  SELECT -1 AS slot, count(*) AS n_nonzero FROM train
  UNION ALL SELECT 0, count(*) FILTER (WHERE km <> 0) FROM train
  UNION ALL SELECT CAST(1 + i AS INTEGER), n FROM idx WHERE i < levels - 1
  UNION ALL SELECT CAST((SELECT levels FROM lv) + b AS INTEGER), n FROM bk WHERE b < 7)"""

_DUMMY_SLOTS_ALL = _DUMMY_SLOTS[:-1] + """
  UNION ALL SELECT CAST((SELECT levels FROM lv) + 7 + dow AS INTEGER), n FROM dw WHERE dow < top
  UNION ALL SELECT CAST((SELECT levels FROM lv) + 7 + (SELECT max(top) FROM dw) + mon AS INTEGER), n
            FROM mo WHERE mon < top)"""

# Lasso on the 29 dummy-layout columns, solved in SQL the way it is defined:
# in standardized units it minimises 1/2 b'Rb - b'c + (regParam / sd(y)) |b|_1,
# R the population correlation matrix of the columns and c their correlation
# with the label.  Cyclic coordinate descent (soft-thresholding, 60 sweeps)
# reaches the unique optimum with exact zeros.
_LASSO_CD = o.SPLIT + """,
idx AS (SELECT org, row_number() OVER (ORDER BY count(*) DESC, org) - 1 AS i,
               count(*) OVER () AS levels FROM train GROUP BY org),
lv AS (SELECT max(levels) AS nl FROM idx),
tops AS (SELECT max(dow) AS dtop, max(mon) AS mtop FROM train),
rw AS (SELECT t.event_id, t.km, CAST(t.duration AS DOUBLE) AS y, x.i AS oi,
              CAST(least(floor(t.depart / 3), 7) AS INTEGER) AS b, t.dow, t.mon
       FROM train t JOIN idx x ON t.org = x.org),
ex AS (
  SELECT event_id, 0 AS slot, km AS x FROM rw
  UNION ALL SELECT event_id, CAST(1 + oi AS INTEGER), 1.0 FROM rw WHERE oi < (SELECT nl FROM lv) - 1
  UNION ALL SELECT event_id, CAST((SELECT nl FROM lv) + b AS INTEGER), 1.0 FROM rw WHERE b < 7
  UNION ALL SELECT event_id, CAST((SELECT nl FROM lv) + 7 + dow AS INTEGER), 1.0 FROM rw
            WHERE dow < (SELECT dtop FROM tops)
  UNION ALL SELECT event_id, CAST((SELECT nl FROM lv) + 7 + (SELECT dtop FROM tops) + mon AS INTEGER), 1.0 FROM rw
            WHERE mon < (SELECT mtop FROM tops)),
st AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(y) AS my, stddev_pop(y) AS sy FROM rw),
mom AS (SELECT slot, sum(x) / (SELECT n FROM st) AS m, sqrt(sum(x * x) / (SELECT n FROM st) - pow(sum(x) / (SELECT n FROM st), 2)) AS s
        FROM ex GROUP BY slot),
cxy AS (SELECT e.slot, (sum(e.x * r.y) / (SELECT n FROM st) - m.m * (SELECT my FROM st)) / (m.s * (SELECT sy FROM st)) AS c
        FROM ex e JOIN rw r ON e.event_id = r.event_id JOIN mom m ON e.slot = m.slot GROUP BY e.slot, m.m, m.s),
pxx AS (SELECT a.slot AS j, b.slot AS k, sum(a.x * b.x) / (SELECT n FROM st) AS mjk
        FROM ex a JOIN ex b ON a.event_id = b.event_id GROUP BY 1, 2),
cor AS (SELECT a.slot AS j, b.slot AS k, (coalesce(p.mjk, 0) - a.m * b.m) / (a.s * b.s) AS rjk
        FROM mom a CROSS JOIN mom b LEFT JOIN pxx p ON p.j = a.slot AND p.k = b.slot),
mats AS (SELECT (SELECT list(row ORDER BY j) FROM (SELECT j, list(rjk ORDER BY k) AS row FROM cor GROUP BY j)) AS rm,
                (SELECT list(c ORDER BY slot) FROM cxy) AS cv,
                (SELECT CAST(count(*) AS INTEGER) FROM mom) AS p,
                """ + repr(LASSO_REG_PARAM) + """ / (SELECT sy FROM st) AS lam),
cd(t, b) AS (
  SELECT 0, list_transform(range((SELECT p FROM mats)), lambda i: CAST(0 AS DOUBLE))
  UNION ALL
  SELECT t + 1, list_transform(range(p), lambda i: CASE WHEN i = t % p
                  THEN sign(z) * greatest(abs(z) - lam, 0) / rm[i + 1][i + 1] ELSE b[i + 1] END)
  FROM (SELECT t, b, p, lam, rm,
               cv[(t % p) + 1] - list_sum(list_transform(range(p), lambda k: CASE WHEN k = t % p THEN 0
                   ELSE rm[(t % p) + 1][k + 1] * b[k + 1] END)) AS z
        FROM cd, mats WHERE t < 60 * p))"""

# Unpenalised logistic regression on (mon, depart, duration): the maximum-
# likelihood fit by cyclic one-coordinate Newton steps on standardized
# columns (100 sweeps; converged well before).
_LOGISTIC_MLE = o.SPLIT + """,
sc AS (SELECT avg(mon) AS m1, stddev_pop(mon) AS s1, avg(depart) AS m2, stddev_pop(depart) AS s2,
              avg(duration) AS m3, stddev_pop(duration) AS s3 FROM train),
zt AS (SELECT [1.0, (mon - m1) / s1, (depart - m2) / s2, (duration - m3) / s3] AS z, CAST(label AS DOUBLE) AS y
       FROM train, sc),
nt(t, b) AS (
  SELECT 0, [CAST(0 AS DOUBLE), 0, 0, 0]
  UNION ALL
  SELECT t + 1, list_transform(range(4), lambda i: CASE WHEN i = t % 4 THEN b[i + 1] + step ELSE b[i + 1] END)
  FROM (SELECT t, b,
          (SELECT sum(z[(t % 4) + 1] * (y - 1 / (1 + exp(-list_dot_product(z, b)))))
                  / sum(z[(t % 4) + 1] * z[(t % 4) + 1] * (1 / (1 + exp(-list_dot_product(z, b))))
                        * (1 - 1 / (1 + exp(-list_dot_product(z, b)))))
           FROM zt) AS step
        FROM nt WHERE t < 400))"""

def _layout_scored(penalty: float, sweeps: int, name: str) -> str:
    """The descent of ``_LASSO_CD`` with another penalty (0: least squares),
    more sweeps, and its predictions ``name`` for the test rows."""
    fit = _LASSO_CD.replace(repr(LASSO_REG_PARAM) + " / (SELECT sy", repr(penalty) + " / (SELECT sy")
    fit = fit.replace("t < 60 * p", f"t < {sweeps} * p")
    slots = fit.split("\nex AS (")[1].split("),\nst AS (")[0]
    return fit + f""",
trw AS (SELECT t.event_id, t.km, CAST(t.duration AS DOUBLE) AS y, x.i AS oi,
               CAST(least(floor(t.depart / 3), 7) AS INTEGER) AS b, t.dow, t.mon
        FROM test t JOIN idx x ON t.org = x.org),
tex AS ({slots.replace("FROM rw", "FROM trw")}),
place AS (SELECT slot, m, s, row_number() OVER (ORDER BY slot) AS i FROM mom),
beta AS (SELECT slot, m, cd.b[i] * (SELECT sy FROM st) / s AS w FROM place, cd WHERE t = {sweeps} * (SELECT p FROM mats)),
{name} AS (SELECT r.event_id, r.y, (SELECT my FROM st) - (SELECT sum(w * m) FROM beta) + coalesce(sum(e.x * w), 0) AS prediction
  FROM trw r LEFT JOIN tex e ON e.event_id = r.event_id LEFT JOIN beta USING (slot) GROUP BY r.event_id, r.y)"""


_LOGISTIC_SCORED = _LOGISTIC_MLE + """,
margins AS (
  SELECT t.event_id, t.label, nt.b[1] + nt.b[2] * (t.mon - sc.m1) / sc.s1 + nt.b[3] * (t.depart - sc.m2) / sc.s2
    + nt.b[4] * (t.duration - sc.m3) / sc.s3 AS margin
  FROM test t, sc, nt WHERE nt.t = 400),
scored AS (SELECT *, CASE WHEN margin > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction FROM margins)"""

_ELASTIC = """(sy / sx) * sign(c / (sx * sy)) * greatest(abs(c / (sx * sy)) - lam * mix / sy, 0)
              / (1 + lam * (1 - mix) / sy)"""

_GRID = "(SELECT CAST(lam AS DOUBLE) AS lam, CAST(mix AS DOUBLE) AS mix FROM (VALUES " + ", ".join(
    f"({lam}, {mix})" for lam in REG_PARAMS for mix in MIX_PARAMS) + ") AS v(lam, mix))"

ORACLE = {
    "m1_tree_stump": o.with_sql(_STUMP, """
        SELECT event_id, label, tree_prediction AS prediction, round(p, 6) AS p1 FROM stump"""),
    "m2_logistic_by_origin": o.with_sql(o.SPLIT + """,
        m AS (SELECT org, avg(label) AS p FROM train GROUP BY org)""", """
        SELECT t.event_id, t.label, CASE WHEN m.p > 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction, round(m.p, 6) AS p1
        FROM test t JOIN m ON t.org = m.org"""),
    "m2_logistic_default": o.with_sql(_LOGISTIC_SCORED, """
        SELECT event_id, label, prediction, round(1 / (1 + exp(-margin)), 4) AS p1 FROM scored""", recursive=True),
    "a2_confusion_logistic": o.with_sql(_LOGISTIC_SCORED + """,
        cells AS (SELECT count(*) FILTER (WHERE prediction = 0 AND label = 0) AS tn,
                         count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
                         count(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn,
                         count(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp FROM scored)""", """
        SELECT tn, tp, fn, fp,
               CAST(tn + tp AS DOUBLE) / (tn + tp + fn + fp) AS accuracy,
               CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
               CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS recall
        FROM cells""", recursive=True),
    "e2_auc_logistic": o.with_sql(_LOGISTIC_SCORED + """,
        ranked AS (SELECT label, rank() OVER (ORDER BY margin) + (count(*) OVER (PARTITION BY margin) - 1) / 2.0 AS place
                   FROM scored)""", """
        SELECT round((sum(place) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0)
                     / (sum(label) * (count(*) - sum(label))), 6) AS auc FROM ranked""", recursive=True),
    "m4_linear_km": o.with_sql(_OLS_KM, """
        SELECT -1 AS position, 'intercept' AS term, round(a, 6) AS coefficient FROM ols
        UNION ALL SELECT 0, 'km', round(b, 6) FROM ols"""),
    "m5_linear_km_org": o.with_sql(_FWL, "SELECT event_id, round(prediction, 4) AS prediction FROM fwl_test"),
    "m6_linear_depart": o.with_sql(_DUMMY_SLOTS, "SELECT slot, n_nonzero, CAST(0 AS DOUBLE) AS cos_residual FROM slots"),
    "m7_linear_all": o.with_sql(_DUMMY_SLOTS_ALL, "SELECT slot, n_nonzero, CAST(0 AS DOUBLE) AS cos_residual FROM slots"),
    "m8_lasso_km": o.with_sql(_ST + """,
        lasso AS (SELECT mx, my, sign(c) * greatest(abs(c) - """ + repr(LASSO_REG_PARAM) + """ * sx, 0) / (sx * sx) AS b
                  FROM st)""", """
        SELECT -1 AS position, 'intercept' AS term, round(my - b * mx, 6) AS coefficient FROM lasso
        UNION ALL SELECT 0, 'km', round(b, 6) FROM lasso"""),
    "m9_elastic_net_km": o.with_sql(_ST + f""",
        fits AS (SELECT lam, mix, mx, my, {_ELASTIC} AS b FROM {_GRID} g, st)""", """
        SELECT lam AS reg_param, mix AS elastic_net, round(my - b * mx, 6) AS intercept, round(b, 6) AS slope
        FROM fits"""),
    "m10_gbt_stump": o.with_sql(_STUMP, """
        SELECT event_id, label, CASE WHEN 2 * p - 1 > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction,
               round(1 / (1 + exp(-2 * (2 * p - 1))), 6) AS p1 FROM stump"""),
    "m11_forest_stump": o.with_sql(_STUMP, """
        SELECT event_id, label, CASE WHEN p > 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction, round(p, 6) AS p1
        FROM stump"""),
    "i1_coefficients": o.with_sql(_FWL, """
        SELECT -1 AS position, 'intercept' AS term, round(intercept, 6) AS coefficient FROM base
        UNION ALL SELECT 0, 'km', round((SELECT slope FROM s), 6)
        UNION ALL SELECT CAST(1 + i AS INTEGER), 'org_dummy_' || org, round(effect - (SELECT intercept FROM base), 6)
                  FROM lvl WHERE i < levels - 1"""),
    "i2_speed": o.with_sql(_FWL + """,
        ols AS (SELECT regr_slope(duration, km) AS b FROM train)""", """
        SELECT 'km_only' AS model, round(b, 6) AS minutes_per_km, round(60 / b, 4) AS km_per_hour FROM ols
        UNION ALL SELECT 'km_org', round(slope, 6), round(60 / slope, 4) FROM s"""),
    "i3_level_effects": o.with_sql(_FWL, "SELECT org AS level, round(effect, 6) AS effect FROM lvl"),
    "i3_level_effects_depart": o.with_sql(
        o.SPLIT + "," + o.two_factor_fit("train", "org", "least(floor(depart / 3), 7) + 1", 8), """
        SELECT l.lvl AS org, printf('%.1f, %.1f', 3.0 * (k - 1), 3.0 * k) AS depart,
               round(fit.a + fit.f[l.fi] + fit.g[k], 6) AS effect
        FROM (SELECT DISTINCT org, CAST(least(floor(depart / 3), 7) + 1 AS INTEGER) AS k FROM train)
        JOIN flv l ON l.lvl = org, fit""", recursive=True),
    "m6_linear_depart_scored": o.with_sql(
        o.SPLIT + "," + o.two_factor_fit("train", "org", "least(floor(depart / 3), 7) + 1", 8), """
        SELECT t.event_id, round(fit.a + fit.b * t.km + fit.f[l.fi] + fit.g[CAST(least(floor(t.depart / 3), 7) + 1 AS INTEGER)], 4) AS prediction
        FROM test t JOIN flv l ON t.org = l.lvl, fit""", recursive=True),
    "a1_confusion_matrix": o.with_sql(_STUMP, """
        SELECT label, tree_prediction AS prediction, count(*) AS count FROM stump GROUP BY 1, 2"""),
    "a2_confusion_cells": o.with_sql(_STUMP + """,
        cells AS (SELECT count(*) FILTER (WHERE tree_prediction = 0 AND label = tree_prediction) AS tn,
                         count(*) FILTER (WHERE tree_prediction = 1 AND label = tree_prediction) AS tp,
                         count(*) FILTER (WHERE tree_prediction = 0 AND label <> tree_prediction) AS fn,
                         count(*) FILTER (WHERE tree_prediction = 1 AND label <> tree_prediction) AS fp
                  FROM stump)""", """
        SELECT tn, tp, fn, fp,
               CAST(tn + tp AS DOUBLE) / (tn + tp + fn + fp) AS accuracy,
               CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
               CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS recall
        FROM cells"""),
    "p4_compound_filter": o.with_sql(_STUMP, """
        SELECT event_id, label, tree_prediction AS prediction FROM stump
        WHERE tree_prediction = 0 AND label <> tree_prediction"""),
    "e1_weighted_precision": o.with_sql(_STUMP + """,
        per AS (SELECT c AS cls,
                       CAST(count(*) FILTER (WHERE label = c) AS DOUBLE) / (SELECT count(*) FROM stump) AS w,
                       coalesce(CAST(count(*) FILTER (WHERE label = c AND tree_prediction = c) AS DOUBLE)
                                / nullif(count(*) FILTER (WHERE tree_prediction = c), 0), 0) AS prec
                FROM stump, (SELECT DISTINCT label AS c FROM stump) cl GROUP BY c)""", """
        SELECT round(sum(w * prec), 6) AS weighted_precision FROM per"""),
    "e2_auc": o.with_sql(o.SPLIT + """,
        m AS (SELECT org, avg(label) AS p FROM train GROUP BY org),
        sc AS (SELECT t.label, m.p FROM test t JOIN m ON t.org = m.org)""",
        f"SELECT round({_auc('sc', 'p')}, 6) AS auc"),
    "e3_rmse": o.with_sql(_FWL + """,
        ols AS (SELECT regr_intercept(duration, km) AS a, regr_slope(duration, km) AS b FROM train)""", """
        SELECT 'km_only' AS model, 'rmse' AS metric,
               round(sqrt(avg(pow(t.duration - (o.a + o.b * t.km), 2))), 6) AS value FROM test t, ols o
        UNION ALL
        SELECT 'km_org', 'rmse', round(sqrt(avg(pow(duration - prediction, 2))), 6) FROM fwl_test"""),
    "m7_linear_all_scored": o.with_sql(_layout_scored(0.0, 200, "scored"), """
        SELECT event_id, round(prediction, 4) AS prediction FROM scored""", recursive=True),
    "e3_rmse_all": "SELECT 'linear_all' AS model, 'rmse' AS metric, value FROM (" + o.with_sql(
        _layout_scored(0.0, 200, "scored"), "SELECT round(sqrt(avg(pow(y - prediction, 2))), 5) AS value FROM scored",
        recursive=True) + ") UNION ALL SELECT 'lasso_all', 'rmse', value FROM (" + o.with_sql(
        _layout_scored(LASSO_REG_PARAM, 60, "scored"), "SELECT round(sqrt(avg(pow(y - prediction, 2))), 5) AS value FROM scored",
        recursive=True) + ")",
    "i4_zero_coefficients": o.with_sql(_LASSO_CD, """
        SELECT CAST(len(b) AS INTEGER) AS n_coefficients,
               CAST(len(list_filter(b, lambda v: v = 0)) AS INTEGER) AS n_zero
        FROM cd WHERE t = 60 * (SELECT p FROM mats)""", recursive=True),
    "m8_kkt": o.with_sql(_LASSO_CD + """,
        place AS (SELECT slot, s, row_number() OVER (ORDER BY slot) AS i FROM mom),
        done AS (SELECT b FROM cd WHERE t = 60 * (SELECT p FROM mats))""", """
        SELECT CAST(slot AS INTEGER) AS slot, round(b[i] * (SELECT sy FROM st) / s, 5) AS coefficient,
               round(cv[i] - list_dot_product(rm[i], b), 5) AS gradient, round(lam, 5) AS bound, CAST(0 AS DOUBLE) AS slack
        FROM place, done, mats""", recursive=True),
    "i7_stage_params": """
        SELECT CAST(stage AS INTEGER) AS stage, stage_class, param, value FROM (VALUES
          (0, 'StringIndexerModel', 'inputCol', 'org'),
          (0, 'StringIndexerModel', 'outputCol', 'org_idx'),
          (0, 'StringIndexerModel', 'handleInvalid', 'error'),
          (1, 'OneHotEncoderModel', 'inputCols', '[org_idx]'),
          (1, 'OneHotEncoderModel', 'outputCols', '[org_dummy]'),
          (1, 'OneHotEncoderModel', 'handleInvalid', 'error'),
          (2, 'VectorAssembler', 'inputCols', '[km, org_dummy]'),
          (2, 'VectorAssembler', 'outputCol', 'features'),
          (3, 'LinearRegressionModel', 'labelCol', 'duration')) AS t(stage, stage_class, param, value)""",
    "e4_compare_auc": o.with_sql(_STUMP, f"""
        SELECT 'tree' AS model, 'auc' AS metric, round({_auc('stump', 'pos')}, 6) AS value
        UNION ALL SELECT 'gbt', 'auc', round({_auc('stump', '2 * p - 1')}, 6)
        UNION ALL SELECT 'forest', 'auc', round({_auc('stump', 'p')}, 6)"""),
}
