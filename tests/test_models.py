import math

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkwright.functions import partitioning
from sparkwright.operators import features, introspect, models
from sparkwright.plans import common
from sparkwright.plans.models import CLASS_FEATURES
from conftest import SF_SMALL


def _km_train(spark):
    train, _ = common.split(spark, SF_SMALL)
    return features.assemble(train, ["km"])


def _xy(df):
    rows = df.select("km", "duration").collect()
    return np.array([r.km for r in rows]), np.array([float(r.duration) for r in rows])


def test_least_squares_matches_numpy(spark):
    train = _km_train(spark)
    model = models.linear().fit(train)
    x, y = _xy(train)
    b, a = np.polyfit(x, y, 1)
    assert math.isclose(model.coefficients[0], b, rel_tol=1e-9)
    assert math.isclose(model.intercept, a, rel_tol=1e-9)


def test_elastic_net_closed_form(spark):
    train = _km_train(spark)
    x, y = _xy(train)
    sx, sy = x.std(), y.std()
    c = np.mean((x - x.mean()) * (y - y.mean()))
    rho = c / (sx * sy)
    for lam, mix in [(1.0, 1.0), (10.0, 0.0), (0.1, 0.5), (10.0, 0.5)]:
        m = models.linear(regParam=lam, elasticNetParam=mix).fit(train)
        b = (sy / sx) * np.sign(rho) * max(abs(rho) - lam * mix / sy, 0) / (1 + lam * (1 - mix) / sy)
        assert math.isclose(m.coefficients[0], b, rel_tol=1e-7), (lam, mix)


def _stump_data(spark):
    train, test = common.split(spark, SF_SMALL)
    tr = features.assemble(common.plain_bucket(train), ["depart_bucket"])
    te = features.assemble(common.plain_bucket(test), ["depart_bucket"])
    return tr, te


def _best_cut(rows):
    by = {}
    for b, lab in rows:
        n, p = by.get(b, (0, 0))
        by[b] = (n + 1, p + lab)
    keys = sorted(by)
    total_n, total_p = sum(v[0] for v in by.values()), sum(v[1] for v in by.values())
    best = None
    nl = pl = 0
    for k in keys[:-1]:
        nl += by[k][0]
        pl += by[k][1]
        nr, pr = total_n - nl, total_p - pl
        gini = lambda n, p: 1 - (p / n) ** 2 - ((n - p) / n) ** 2
        w = (nl * gini(nl, pl) + nr * gini(nr, pr)) / total_n
        if best is None or w < best[0]:
            best = (w, k, pl / nl, pr / nr)
    return best


def test_single_split_tree_matches_brute_force(spark):
    tr, te = _stump_data(spark)
    _, cut, p_left, p_right = _best_cut([(r.depart_bucket, r.label) for r in tr.collect()])
    _, pred = models.fit_and_score(models.decision_tree(maxDepth=1), tr, te)
    for r in pred.select("depart_bucket", vector_to_array("probability")[1].alias("p")).collect():
        assert math.isclose(r.p, p_left if r.depart_bucket <= cut else p_right, rel_tol=1e-12)
    _, gbt = models.fit_and_score(models.boosted_trees(maxIter=1, maxDepth=1), tr, te)
    for r in gbt.select("depart_bucket", vector_to_array("probability")[1].alias("p")).collect():
        m = 2 * (p_left if r.depart_bucket <= cut else p_right) - 1
        assert math.isclose(r.p, 1 / (1 + math.exp(-2 * m)), rel_tol=1e-9)


def test_default_classifiers_beat_majority_on_planted_signal(spark):
    train, test = common.split(spark, "/root/testdata/sf0.01")
    tr, te = features.assemble(train, CLASS_FEATURES), features.assemble(test, CLASS_FEATURES)
    majority = max(te.filter("label = 1").count(), te.filter("label = 0").count()) / te.count()
    for est in (models.decision_tree(), models.random_forest(), models.boosted_trees()):
        _, pred = models.fit_and_score(est, tr, te)
        acc = pred.filter("label = prediction").count() / pred.count()
        assert acc > majority + 0.05, type(est).__name__


def test_inspection_tables(spark):
    train, _ = common.split(spark, SF_SMALL)
    tr = features.assemble(train, CLASS_FEATURES)
    gbt = models.boosted_trees(maxIter=3).fit(tr)
    summary = introspect.tree_summary(spark, gbt).first()
    assert summary.num_trees == 3 and summary.max_depth <= 5
    imp = introspect.feature_importance(spark, gbt, CLASS_FEATURES).collect()
    assert [r.feature for r in imp] == CLASS_FEATURES
    assert math.isclose(sum(r.importance for r in imp), 1.0, rel_tol=1e-9)
    lasso = models.linear(regParam=1000.0, elasticNetParam=1.0).fit(features.assemble(train, ["km"]))
    z = introspect.zero_count(spark, lasso).first()
    assert (z.n_coefficients, z.n_zero) == (1, 1)
    table = introspect.coefficient_table(spark, lasso, ["km"]).collect()
    assert [r.term for r in table] == ["intercept", "km"]
    params = introspect.stage_params(spark, lasso).collect()
    assert {(r.param, r.value) for r in params} >= {("regParam", "1000.0"), ("elasticNetParam", "1.0")}


def test_two_factor_effects_reconstruct_predictions(spark):
    """intercept + origin dummy + bucket dummy + slope * km == the model's prediction."""

    from sparkwright.plans import models as pm
    fitted, train, _ = pm._dummies_model(spark, SF_SMALL, ())
    effects = {(r.org, r.depart): r.effect for r in pm.i3_level_effects_depart(spark, SF_SMALL).collect()}
    vals = train.schema["depart_bucket"].metadata["ml_attr"]["vals"]
    slope = fitted.stages[-1].coefficients[0]
    scored = fitted.transform(train).select("org", "depart_bucket", "km", "prediction").limit(50).collect()
    for row in scored:
        expect = effects[(row.org, vals[int(row.depart_bucket)])] + slope * row.km
        assert abs(expect - row.prediction) < 1e-4
    assert len(effects) == len(fitted.stages[0].labelsArray[0]) * len(vals)


def test_tree_merges_leaves_of_equal_class(spark):
    """A single tree prunes a split whose two leaves predict the same class."""
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.dense([float(x)]), 0.0) for x in range(20)] + [(Vectors.dense([30.0]), 1.0)] * 2
    df = spark.createDataFrame(rows, ["features", "label"])
    m = models.decision_tree(maxDepth=3).fit(df)
    assert m.depth <= 1


def test_unknown_levels_raise(spark):
    import pytest

    from sparkwright.plans import models as pm
    fitted, _, train = pm._km_org_model(spark, SF_SMALL)
    names = introspect.names_for(fitted.transform(train.limit(0)))
    labels = list(fitted.stages[0].labelsArray[0])
    model = fitted.stages[-1]
    dropped = introspect.level_effects(spark, model, names, "org_dummy_", labels, labels[-1:]).first()
    assert dropped.effect == model.intercept
    with pytest.raises(KeyError):
        introspect.level_effects(spark, model, names, "org_dummy_", labels, ["misspelt"])
    with pytest.raises(KeyError):
        introspect.level_effects_2(spark, model, names, ("a", "org_dummy_", labels), ("b", "org_dummy_", labels),
                                   [(labels[0], "misspelt")])


def test_split_deals_out_a_single_row_group(spark, monkeypatch):
    before = [sorted(map(tuple, part.collect())) for part in common.split(spark, SF_SMALL)]
    monkeypatch.setattr(partitioning, "SPREAD_ROWS", 100)
    after = common.split(spark, SF_SMALL)
    assert [sorted(map(tuple, part.collect())) for part in after] == before
    held = [n for n, in after[0].groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(held) >= 8 and max(held) < 2 * sum(held) / len(held)
