"""Invariants for the registered queries that have no SQL oracle (randomised
or iterative fits), run on the small tables."""

import math

import pytest

import __spark_entry__ as entry
from sparkwright.plans import common
from sparkwright.plans.text import _labelled, _sms_split
from conftest import SF_SMALL

Q = entry.queries()


@pytest.fixture(scope="module")
def sizes(spark):
    train, test = common.split(spark, SF_SMALL)
    sms_train, sms_test = _sms_split(_labelled(spark, SF_SMALL))
    return {"test": test.count(), "sms_test": sms_test.count()}


@pytest.mark.parametrize("name", ["m1_tree_default", "m2_logistic_default", "m10_gbt_default",
                                  "m11_forest_default"])
def test_flight_classifiers_score_every_test_row(spark, sizes, name):
    rows = Q[name](spark, SF_SMALL).collect()
    assert len(rows) == sizes["test"] and {r.prediction for r in rows} <= {0.0, 1.0}


@pytest.mark.parametrize("name", ["m3_logistic_tfidf", "t2_text_stages"])
def test_spam_models_score_every_test_row(spark, sizes, name):
    rows = Q[name](spark, SF_SMALL).collect()
    assert len(rows) == sizes["sms_test"] and {r.prediction for r in rows} <= {0.0, 1.0}


def test_boosted_tree_inspection(spark):
    s = Q["i5_tree_count"](spark, SF_SMALL).first()
    assert s.num_trees == 20 and 1 <= s.max_depth <= 5
    imp = Q["i6_feature_importance"](spark, SF_SMALL).collect()
    assert [r.feature for r in imp] == ["mon", "depart", "duration"]
    assert math.isclose(sum(r.importance for r in imp), 1.0, abs_tol=3e-6)


def test_lasso_zero_count(spark):
    z = Q["i4_zero_coefficients"](spark, SF_SMALL).first()
    assert 0 < z.n_zero < z.n_coefficients


def test_auc_comparison_rows(spark):
    rows = Q["e4_compare_auc_default"](spark, SF_SMALL).collect()
    assert [r.model for r in rows] == ["tree", "gbt"] and all(0.5 < r.value <= 1 for r in rows)


def test_linear_search_tables(spark):
    table = Q["t8_grid_linear"](spark, SF_SMALL).collect()
    assert len(table) == 12 and sum(r.is_best for r in table) == 1
    best = min(r.metric for r in table)
    assert [r for r in table if r.is_best][0].metric == best
    summary = Q["t12_best_metric"](spark, SF_SMALL).first()
    assert (summary.n_points, summary.larger_is_better) == (12, False) and abs(summary.best_metric - best) < 2e-6
    chosen = Q["t11_best_model"](spark, SF_SMALL).first()
    winner = [r for r in table if r.is_best][0].params
    assert winner.startswith(f"regParam={chosen.reg_param!r}") and chosen.test_rmse > 0


def test_forest_search_table(spark):
    table = Q["t10_grid_forest"](spark, SF_SMALL).collect()
    assert len(table) == 12 and sum(r.is_best for r in table) == 1
    assert all(0 <= r.metric <= 1 for r in table)
    assert [r for r in table if r.is_best][0].metric == max(r.metric for r in table)


def test_text_search_table(spark):
    table = Q["t9_grid_text"](spark, SF_SMALL).collect()
    assert len(table) == 72 and sum(r.is_best for r in table) == 1
    assert [r for r in table if r.is_best][0].metric == max(r.metric for r in table)
    assert {r.params.split(",")[0] for r in table} == {"numFeatures=1024", "numFeatures=4096",
                                                      "numFeatures=16384"}
