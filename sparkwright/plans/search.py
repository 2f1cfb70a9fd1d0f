"""Queries for pipelines and cross-validated search.

Folds are a key hash of ``event_id`` (``fold`` column), so every search is
reproducible and has, where the model has a closed form, a SQL oracle:

* T1: residuals orthogonal to every column, and test predictions from the
  same least squares fitted in SQL by cyclic block updates;
* T4/T6: plain 5-fold CV of least squares on km, via per-fold sums;
* T7: 3-fold CV of the km + origin pipeline, via per-fold, per-origin sums
  (every fitted stage, the indexer included, is refitted inside each fold).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.partitioning import persisted
from ..operators import certify, evaluate, features, forests, models, tune
from ..sources import views
from . import oracle as o
from .common import KEY, r, split, with_folds
from .models import CLASS_FEATURES, MIX_PARAMS, REG_PARAMS, _residual_cosines

PARALLELISM = 4


def _t1_fitted(spark, sf_dir):
    train, test = split(spark, sf_dir)
    pipe = tune.regression_stages("org", ("dow",), ("km",), "duration")
    with persisted(train) as rows:
        fitted = pipe.fit(rows)
    return fitted, train, test


def t1_regression_stages(spark, sf_dir):
    """Index, one-hot (origin and raw day of week), assemble, regress: residual
    orthogonality on the training rows."""
    fitted, train, _ = _t1_fitted(spark, sf_dir)
    return _residual_cosines(fitted, train)


def t1_regression_scored(spark, sf_dir):
    fitted, _, test = _t1_fitted(spark, sf_dir)
    return fitted.transform(test).select(KEY, r("prediction", 4).alias("prediction"))


def t6_cv_linear_km(spark, sf_dir):
    """T4 + T6: empty grid (one point), 5 folds, least squares on km."""
    train, _ = split(spark, sf_dir)
    train = with_folds(features.assemble(train, ["km"]), 5).select("features", "duration", "fold")
    cv = tune.cross_validate(models.linear("duration"), tune.empty_grid(),
                             RegressionEvaluator(labelCol="duration"), train, 5, "fold", PARALLELISM)
    return tune.search_table(spark, cv).withColumn("metric", r("metric"))


def t7_cv_regression_stages(spark, sf_dir):
    """Whole pipeline cross-validated (3 folds, the validator's default)."""
    train, _ = split(spark, sf_dir)
    train = with_folds(train, 3).select("org", "km", "duration", "fold")
    cv = tune.cross_validate(tune.regression_stages("org", (), ("km",), "duration"), tune.empty_grid(),
                             RegressionEvaluator(labelCol="duration"), train, 3, "fold", PARALLELISM)
    return tune.search_table(spark, cv).withColumn("metric", r("metric"))


def _linear_search(spark, sf_dir, **params):
    """The 12-point search: index, one-hot and assemble once per fold."""
    train, test = split(spark, sf_dir)
    regression = models.linear("duration", **params)
    stages = Pipeline(stages=tune.regression_stages("org", (), ("km",), "duration").getStages()[:-1])
    folds = with_folds(train, 5).select("org", "km", "duration", "fold")
    found = tune.staged_search(stages, [{}], regression, tune.linear_grid(regression),
                               RegressionEvaluator(labelCol="duration"), folds, 5, ["features", "duration"])
    return found, test


def t8_grid_linear(spark, sf_dir):
    """T5 + T8: 12-point grid (regParam x elasticNetParam) x 5 folds; the solver
    runs to its optimum."""
    found, _ = _linear_search(spark, sf_dir, tol=1e-12, maxIter=1000)
    return tune.search_table(spark, found).withColumn("metric", r("metric"))


def t10_grid_forest(spark, sf_dir):
    """Forest, featureSubsetStrategy x maxDepth (12 points) x 5 folds, exact
    AUC; points that differ in depth only share their trees.  Large tables are
    grouped first (``forests.grouped_search``)."""
    train, _ = split(spark, sf_dir)
    train = with_folds(train, 5)
    forest = models.random_forest()
    grid, evaluator = tune.forest_grid(forest), BinaryClassificationEvaluator(numBins=0)
    if forests.pays_to_group(views.table(spark, sf_dir, "events").count(), forest, len(CLASS_FEATURES)):
        found = forests.grouped_search(forest, grid, evaluator, train, CLASS_FEATURES, 5)
    else:
        train = features.assemble(train, CLASS_FEATURES).select("features", "label", "fold")
        found = forests.nested_search(forest, grid, evaluator, train, 5, "fold", PARALLELISM)
    return tune.search_table(spark, found).withColumn("metric", r("metric"))


def t11_best_model(spark, sf_dir):
    """The winner of the linear search (refitted on all training rows),
    its parameters, and its RMSE on the held-out test rows."""
    found, test = _linear_search(spark, sf_dir)
    best = found.best_model
    reg = best.stages[-1]
    rmse = evaluate.rmse(best.transform(test))
    schema = StructType([StructField("reg_param", DoubleType(), False),
                         StructField("elastic_net", DoubleType(), False),
                         StructField("test_rmse", DoubleType(), False)])
    return spark.createDataFrame([(float(reg.getRegParam()), float(reg.getElasticNetParam()), rmse)],
                                 schema).withColumn("test_rmse", r("test_rmse"))


def t12_best_metric(spark, sf_dir):
    """Per-point metrics reduced to the best one, by the evaluator's direction."""
    found, _ = _linear_search(spark, sf_dir)
    table = tune.search_table(spark, found)
    larger = found.evaluator.isLargerBetter()
    best = F.max("metric") if larger else F.min("metric")
    return table.agg(F.count(F.lit(1)).cast("int").alias("n_points"), r(best).alias("best_metric"),
                     F.lit(larger).alias("larger_is_better"))


def t8_fold_metrics(spark, sf_dir):
    """T8 laid open: the metric of every fold and grid point, 60 rows."""
    found, _ = _linear_search(spark, sf_dir, tol=1e-12, maxIter=1000)
    return tune.fold_table(spark, found).withColumn("metric", r("metric", 5))


def t12_fold_spread(spark, sf_dir):
    """T12 with its uncertainty: per point the mean and spread over the folds,
    and how many standard errors it is behind the best, fold by fold."""
    found, _ = _linear_search(spark, sf_dir, tol=1e-12, maxIter=1000)
    table = tune.fold_spread(tune.fold_table(spark, found), found.evaluator.isLargerBetter())
    return table.select("point", "params", r("mean").alias("mean"), r("spread", 5).alias("spread"), r("gap", 2).alias("gap"))


SYSTEM_COLUMNS = ["km", "depart", "mon"]


def t6_training_systems(spark, sf_dir):
    """Per fold the sums of products that its training rows give, total minus
    fold, for ``duration`` on km, departure and month."""
    train, _ = split(spark, sf_dir)
    folds = with_folds(features.assemble(train, SYSTEM_COLUMNS), 5)
    systems = certify.training_systems(certify.gram_table(folds, "duration", by=("fold",)))
    return systems.select("fold", "i", "j", r("s", 2).alias("s"))


QUERIES = {
    "t8_fold_metrics": t8_fold_metrics,
    "t12_fold_spread": t12_fold_spread,
    "t6_training_systems": t6_training_systems,
    "t1_regression_stages": t1_regression_stages,
    "t1_regression_scored": t1_regression_scored,
    "t6_cv_linear_km": t6_cv_linear_km,
    "t7_cv_regression_stages": t7_cv_regression_stages,
    "t8_grid_linear": t8_grid_linear,
    "t10_grid_forest": t10_grid_forest,
    "t11_best_model": t11_best_model,
    "t12_best_metric": t12_best_metric,
}

# ---- oracle ----------------------------------------------------------------------------

_T1_SLOTS = o.SPLIT + """,
idx AS (SELECT org, row_number() OVER (ORDER BY count(*) DESC, org) - 1 AS i,
               count(*) OVER () AS levels, count(*) AS n FROM train GROUP BY org),
lv AS (SELECT max(levels) AS levels FROM idx),
dw AS (SELECT dow, count(*) AS n, max(dow) OVER () AS top FROM train GROUP BY dow),
slots AS (
  SELECT -1 AS slot, count(*) AS n_nonzero FROM train
  UNION ALL SELECT 0, count(*) FILTER (WHERE km <> 0) FROM train
  UNION ALL SELECT CAST(1 + i AS INTEGER), n FROM idx WHERE i < levels - 1
  UNION ALL SELECT CAST((SELECT levels FROM lv) + dow AS INTEGER), n FROM dw WHERE dow < top)"""

_CV_KM = o.SPLIT + f""",
f AS (SELECT km, duration, CAST({o.md5_bucket('event_id', 'fold', 5)} AS INTEGER) AS fold FROM train),
fs AS (SELECT fold, count(*) AS n, sum(km) AS sx, sum(duration) AS sy, sum(km * km) AS sxx,
              sum(km * duration) AS sxy FROM f GROUP BY fold),
tot AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM fs),
oth AS (SELECT fold, (SELECT n FROM tot) - n AS n, (SELECT sx FROM tot) - sx AS sx, (SELECT sy FROM tot) - sy AS sy,
               (SELECT sxx FROM tot) - sxx AS sxx, (SELECT sxy FROM tot) - sxy AS sxy FROM fs),
fit AS (SELECT fold, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b, sy / n AS my, sx / n AS mx FROM oth),
rm AS (SELECT f.fold, sqrt(avg(pow(f.duration - (fit.my + fit.b * (f.km - fit.mx)), 2))) AS rmse
       FROM f JOIN fit ON f.fold = fit.fold GROUP BY f.fold)"""

_CV_ORG = o.SPLIT + f""",
f AS (SELECT org, km, duration, CAST({o.md5_bucket('event_id', 'fold', 3)} AS INTEGER) AS fold FROM train),
fo AS (SELECT fold, org, count(*) AS n, sum(km) AS sx, sum(duration) AS sy, sum(km * km) AS sxx,
              sum(km * duration) AS sxy FROM f GROUP BY fold, org),
ao AS (SELECT org, sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM fo GROUP BY org),
trn AS (SELECT x.fold, x.org, a.n - x.n AS n, a.sx - x.sx AS sx, a.sy - x.sy AS sy,
               a.sxx - x.sxx AS sxx, a.sxy - x.sxy AS sxy FROM fo x JOIN ao a ON x.org = a.org),
slope AS (SELECT fold, sum(sxy - sx * sy / n) / sum(sxx - sx * sx / n) AS b FROM trn GROUP BY fold),
eff AS (SELECT t.fold, t.org, t.sy / t.n - s.b * t.sx / t.n AS e, s.b FROM trn t JOIN slope s ON t.fold = s.fold),
rm AS (SELECT f.fold, sqrt(avg(pow(f.duration - (eff.e + eff.b * f.km), 2))) AS rmse
       FROM f JOIN eff ON f.fold = eff.fold AND f.org = eff.org GROUP BY f.fold)"""

_ONE_POINT = """
SELECT CAST(0 AS INTEGER) AS point, '' AS params, round(avg(rmse), 6) AS metric, true AS is_best FROM rm"""


# The 12-point linear search in SQL: for each fold (and fold -1 = all training
# rows, for the refit of the winner) the indexer's level order and every
# column moment come from per-origin sums; each grid point is then solved in
# standardized units by cyclic coordinate descent, (soft-threshold for the L1
# part, the L2 part on the diagonal, both scaled by 1 / sd(y)).  T8 runs Spark's
# L1 solver to a tight tolerance, as its default moves the 6th decimal of the
# heavily penalised points.
_LINEAR_GRID = ("(SELECT CAST(point AS INTEGER) AS point, CAST(lam AS DOUBLE) AS lam, CAST(mix AS DOUBLE) AS mix "
                "FROM (VALUES " + ", ".join(f"({i}, {lam}, {mix})" for i, (lam, mix) in enumerate(
                    (lam, mix) for lam in REG_PARAMS for mix in MIX_PARAMS)) + ") AS v(point, lam, mix))")
_SEARCH_CD = o.SPLIT + f""",
f AS (SELECT org, km, CAST(duration AS DOUBLE) AS y, CAST({o.md5_bucket('event_id', 'fold', 5)} AS INTEGER) AS fold FROM train),
ks AS (SELECT DISTINCT fold AS k FROM f UNION ALL SELECT -1),
part AS (SELECT ks.k, f.* FROM ks JOIN f ON f.fold <> ks.k),
g AS (SELECT k, org, count(*) AS n, sum(km) AS sx, sum(km * km) AS sxx, sum(y) AS sy, sum(y * y) AS syy, sum(km * y) AS sxy
      FROM part GROUP BY k, org),
rk AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, org) - 1 AS r, count(*) OVER (PARTITION BY k) AS nl FROM g),
tot AS (SELECT k, CAST(sum(n) AS DOUBLE) AS n, sum(sx) AS sx, sum(sxx) AS sxx, sum(sy) AS sy, sum(syy) AS syy, sum(sxy) AS sxy
        FROM g GROUP BY k),
-- moments of columns: slot 0 = km, slot 1 + r = dummy of the level ranked r (r < nl - 1)
cols AS (SELECT k, 0 AS j, CAST(NULL AS VARCHAR) AS org FROM tot
         UNION ALL SELECT k, CAST(1 + r AS INTEGER), org FROM rk WHERE r < nl - 1),
mom AS (SELECT c.k, c.j, c.org,
               CASE WHEN c.j = 0 THEN t.sx / t.n ELSE r.n / t.n END AS m,
               CASE WHEN c.j = 0 THEN t.sxx / t.n ELSE r.n / t.n END AS m2,
               CASE WHEN c.j = 0 THEN t.sxy / t.n ELSE r.sy / t.n END AS my_,
               t.sy / t.n AS ybar, sqrt(t.syy / t.n - pow(t.sy / t.n, 2)) AS ysd
        FROM cols c JOIN tot t ON c.k = t.k LEFT JOIN rk r ON r.k = c.k AND r.org = c.org),
sd AS (SELECT *, sqrt(m2 - m * m) AS s, (my_ - m * ybar) / (sqrt(m2 - m * m) * ysd) AS c FROM mom),
cross_ AS (SELECT a.k, a.j AS ja, b.j AS jb,
            CASE WHEN a.j = b.j THEN a.m2
                 WHEN a.j = 0 THEN (SELECT r.sx FROM rk r WHERE r.k = b.k AND r.org = b.org) / (SELECT n FROM tot t WHERE t.k = a.k)
                 WHEN b.j = 0 THEN (SELECT r.sx FROM rk r WHERE r.k = a.k AND r.org = a.org) / (SELECT n FROM tot t WHERE t.k = a.k)
                 ELSE 0 END AS e, a.m AS ma, b.m AS mb, a.s AS sa, b.s AS sb
           FROM sd a JOIN sd b ON a.k = b.k),
mats AS (SELECT k, list(row ORDER BY ja) AS rm FROM (
           SELECT k, ja, list((e - ma * mb) / (sa * sb) ORDER BY jb) AS row FROM cross_ GROUP BY k, ja) GROUP BY k),
vecs AS (SELECT k, list(c ORDER BY j) AS cv, list(s ORDER BY j) AS sv, list(m ORDER BY j) AS mv,
                max(ybar) AS ybar, max(ysd) AS ysd, CAST(count(*) AS INTEGER) AS p FROM sd GROUP BY k),
sys_ AS (SELECT m.k, m.rm, v.cv, v.sv, v.mv, v.ybar, v.ysd, v.p, gr.point, gr.lam, gr.mix
         FROM mats m JOIN vecs v ON m.k = v.k, {_LINEAR_GRID} gr),
cd(t, k, point, b) AS (
  SELECT 0, k, point, list_transform(range(p), lambda i: CAST(0 AS DOUBLE)) FROM sys_
  UNION ALL
  SELECT t + 1, k, point, list_transform(range(p), lambda i: CASE WHEN i = t % p
           THEN sign(z) * greatest(abs(z) - lam * mix / ysd, 0) / (rm[i + 1][i + 1] + lam * (1 - mix) / ysd)
           ELSE b[i + 1] END)
  FROM (SELECT cd.t, cd.k, cd.point, cd.b, s.p, s.lam, s.mix, s.ysd, s.rm,
               s.cv[(cd.t % s.p) + 1] - list_sum(list_transform(range(s.p), lambda q: CASE WHEN q = cd.t % s.p THEN 0
                   ELSE s.rm[(cd.t % s.p) + 1][q + 1] * cd.b[q + 1] END)) AS z
        FROM cd JOIN sys_ s ON cd.k = s.k AND cd.point = s.point WHERE cd.t < 2000)),
fit AS (SELECT s.k, s.point, s.lam, s.mix,
               list_transform(range(s.p), lambda i: cd.b[i + 1] * s.ysd / s.sv[i + 1]) AS beta, s.mv, s.ybar, s.p
        FROM cd JOIN sys_ s ON cd.k = s.k AND cd.point = s.point WHERE cd.t = 2000),
icpt AS (SELECT *, ybar - list_dot_product(beta, mv) AS a FROM fit),
slots AS (SELECT k, org, 1 + r AS j FROM rk WHERE r < nl - 1),
val AS (SELECT i.k, i.point, sqrt(avg(pow(f.y - (i.a + i.beta[1] * f.km + coalesce(i.beta[sl.j + 1], 0)), 2))) AS rmse
        FROM f JOIN icpt i ON f.fold = i.k LEFT JOIN slots sl ON sl.k = i.k AND sl.org = f.org
        GROUP BY i.k, i.point),
avgm AS (SELECT point, avg(rmse) AS metric FROM val GROUP BY point),
best AS (SELECT point FROM avgm ORDER BY metric, point LIMIT 1)"""
_T12_SQL = o.with_sql(_SEARCH_CD, """
SELECT CAST(count(*) AS INTEGER) AS n_points, round(min(metric), 6) AS best_metric, false AS larger_is_better FROM avgm""", recursive=True)
_T11_SQL = o.with_sql(_SEARCH_CD + """,
tst AS (SELECT t.org, t.km, CAST(t.duration AS DOUBLE) AS y FROM test t)""", """
SELECT i.lam AS reg_param, i.mix AS elastic_net,
       round(sqrt(avg(pow(t.y - (i.a + i.beta[1] * t.km + coalesce(i.beta[sl.j + 1], 0)), 2))), 6) AS test_rmse
FROM tst t, icpt i LEFT JOIN slots sl ON sl.k = -1 AND sl.org = t.org
WHERE i.k = -1 AND i.point = (SELECT point FROM best)
GROUP BY i.lam, i.mix""", recursive=True)

_T8_SQL = o.with_sql(_SEARCH_CD + """,
named AS (SELECT * FROM (VALUES """ + ", ".join(
    f"({i}, 'regParam={lam!r}, elasticNetParam={mix!r}')" for i, (lam, mix) in enumerate(
        (lam, mix) for lam in REG_PARAMS for mix in MIX_PARAMS)) + """) AS v(point, params))""", """
SELECT CAST(a.point AS INTEGER) AS point, params, round(metric, 6) AS metric, a.point = (SELECT point FROM best) AS is_best
FROM avgm a JOIN named n ON a.point = n.point""", recursive=True)

_NAMED = _T8_SQL.split("named AS (")[1].split("\nSELECT")[0].rsplit(")", 1)[0]
_FOLDS = _SEARCH_CD + ",\nnamed AS (" + _NAMED + """),
fm AS (SELECT val.k AS fold, point, params, rmse AS metric FROM val JOIN named USING (point))"""
_SYSTEM_VALUES = ", ".join(f"({k}, CAST({c} AS DOUBLE))" for k, c in [(-2, "duration"), (-1, "1"), *enumerate(SYSTEM_COLUMNS)])

ORACLE = {
    "t8_fold_metrics": o.with_sql(_FOLDS, """
        SELECT CAST(fold AS INTEGER) AS fold, CAST(point AS INTEGER) AS point, params, round(metric, 5) AS metric FROM fm""", recursive=True),
    "t12_fold_spread": o.with_sql(_FOLDS + """,
        paired AS (
          SELECT point, avg(fm.metric - w.metric) AS d, stddev_samp(fm.metric - w.metric) AS s, count(*) AS n
          FROM fm JOIN (SELECT fold, metric FROM fm WHERE point = (SELECT point FROM best)) w USING (fold) GROUP BY point)""", """
        SELECT CAST(point AS INTEGER) AS point, params, round(avg(metric), 6) AS mean, round(stddev_samp(metric), 5) AS spread,
               round(CASE WHEN any_value(s) > 0 THEN any_value(d) / (any_value(s) / sqrt(any_value(n))) END, 2) AS gap
        FROM fm JOIN paired USING (point) GROUP BY point, params""", recursive=True),
    "t6_training_systems": o.with_sql(o.SPLIT + f""",
        f AS (SELECT *, CAST({o.md5_bucket('event_id', 'fold', 5)} AS INTEGER) AS fold FROM train),
        held AS (SELECT DISTINCT fold AS held FROM f),
        v AS (SELECT event_id, fold, x.i, x.v FROM f, LATERAL (VALUES {_SYSTEM_VALUES}) x(i, v))""", """
        SELECT held AS fold, CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(sum(a.v * b.v), 2) AS s
        FROM v a JOIN v b ON a.event_id = b.event_id AND a.i <= b.i, held WHERE a.fold <> held GROUP BY held, a.i, b.i"""),
    "t8_grid_linear": _T8_SQL,
    "t11_best_model": _T11_SQL,
    "t12_best_metric": _T12_SQL,
    "t1_regression_stages": o.with_sql(_T1_SLOTS, """
        SELECT slot, n_nonzero, CAST(0 AS DOUBLE) AS cos_residual FROM slots"""),
    "t1_regression_scored": o.with_sql(o.SPLIT + "," + o.two_factor_fit("train", "org", "dow + 1", 7), """
        SELECT t.event_id, round(fit.a + fit.b * t.km + fit.f[l.fi] + fit.g[t.dow + 1], 4) AS prediction
        FROM test t JOIN flv l ON t.org = l.lvl, fit""", recursive=True),
    "t6_cv_linear_km": o.with_sql(_CV_KM, _ONE_POINT),
    "t7_cv_regression_stages": o.with_sql(_CV_ORG, _ONE_POINT),
}
