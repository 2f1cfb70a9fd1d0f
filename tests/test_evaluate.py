import math

from sparkwright.operators import evaluate


def _cells(spark, tn, fn, tp, fp):
    rows = [(0, 0.0)] * tn + [(1, 0.0)] * fn + [(1, 1.0)] * tp + [(0, 1.0)] * fp
    return spark.createDataFrame(rows, "label int, prediction double")


def test_accuracy_golden(spark):
    cells = evaluate.confusion_cells(_cells(spark, 289, 154, 328, 190)).first()
    assert (cells.tn, cells.fn, cells.tp, cells.fp) == (289, 154, 328, 190)
    assert cells.accuracy == 0.6420395421436004


def test_precision_recall_from_logistic_cells(spark):
    cells = evaluate.confusion_cells(_cells(spark, 288, 195, 277, 201)).first()
    assert f"{cells.precision:.2f}" == "0.58" and f"{cells.recall:.2f}" == "0.59"


def test_empty_class_gives_null_precision(spark):
    cells = evaluate.confusion_cells(_cells(spark, 5, 3, 0, 0)).first()
    assert cells.precision is None and cells.recall == 0.0


def test_confusion_matrix_counts(spark):
    m = {(r.label, r.prediction): r["count"] for r in evaluate.confusion_matrix(_cells(spark, 2, 1, 3, 4)).collect()}
    assert m == {(0, 0.0): 2, (1, 0.0): 1, (1, 1.0): 3, (0, 1.0): 4}


def test_weighted_precision_formula(spark):
    df = _cells(spark, 289, 154, 328, 190)
    n = 961
    expect = (479 / n) * (289 / 443) + (482 / n) * (328 / 518)
    assert math.isclose(evaluate.weighted_precision(df), expect, rel_tol=1e-12)


def test_exact_auc_against_pair_count(spark):
    from pyspark.ml.linalg import Vectors
    data = [(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.7), (0, 0.7), (0, 0.1), (1, 0.3), (0, 0.3)]
    df = spark.createDataFrame([(lab, Vectors.dense([-s, s])) for lab, s in data], ["label", "rawPrediction"])
    pos = [s for lab, s in data if lab == 1]
    neg = [s for lab, s in data if lab == 0]
    pairs = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    assert math.isclose(evaluate.area_under_roc(df), pairs / (len(pos) * len(neg)), rel_tol=1e-12)


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "duration double, prediction double")
    assert math.isclose(evaluate.rmse(df), math.sqrt((1 + 0 + 9) / 3), rel_tol=1e-12)
