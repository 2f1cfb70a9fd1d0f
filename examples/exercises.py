"""The four exercise scripts, step by step, with sparkwright operators.

    python examples/exercises.py [sf_dir]

Reads the flights and sms views from the test tables (sf_dir), goes through
loading, cleaning, encoding, text features, models, inspection, evaluation
and search in the exercises' order, and prints small result tables.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from sparkwright.operators import evaluate, features, introspect, models, prep, text, tune  # noqa: E402
from sparkwright.plans import common  # noqa: E402
from sparkwright.session import scratch_path  # noqa: E402
from sparkwright.sources import (preview, read_flights_csv, read_sms_csv, row_count,  # noqa: E402
                                 schema_table, views, write_flights_csv, write_sms_csv)


def show(title, df, n=10):
    print(f"\n== {title}")
    df.show(n, truncate=False)


def main(sf_dir: str) -> None:
    spark = (SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    # 1. Loading: CSV with NA nulls and inferred types; sms with ';' and a declared schema.
    flights_csv = write_flights_csv(views.flights(spark, sf_dir).drop("event_id"), scratch_path(spark, "ex-flights"))
    flights = read_flights_csv(spark, flights_csv, infer_schema=True)
    show("records", row_count(flights))
    show("first rows", preview(flights, 5, "mon", "dom", "depart"))
    show("types", schema_table(flights))
    sms = read_sms_csv(spark, write_sms_csv(views.sms(spark, sf_dir), scratch_path(spark, "ex-sms")))

    # 2. Cleaning, km, label, indexes, assembled features, split.
    flights = prep.drop_columns(flights, "flight")
    show("missing delay", row_count(prep.null_rows(flights, "delay")))
    flights = prep.drop_incomplete(prep.valid_rows(flights, "delay"))
    flights = prep.threshold_label(prep.miles_to_km(flights))
    show("km and label", flights.select("mile" if "mile" in flights.columns else "km", "delay", "label"), 5)
    flights = common.prepared(spark, sf_dir)   # the same cleaning on the keyed view, for the split
    _, indexed = features.index_categories(flights, ["carrier", "org"], ["carrier_idx", "org_idx"])
    assembled = features.assemble(indexed, ["mon", "dom", "dow", "carrier_idx", "org_idx", "km",
                                            "depart", "duration"])
    show("assembled", assembled.select("features", "delay"), 5)
    show("split", prep.split_ratio(flights, "event_id"))
    train, test = common.split(spark, sf_dir)

    # 3. Tree and logistic classifiers, confusion cells, precision, recall, AUC.
    cls_train = features.assemble(train, ["mon", "depart", "duration"])
    cls_test = features.assemble(test, ["mon", "depart", "duration"])
    _, tree_pred = models.fit_and_score(models.decision_tree(), cls_train, cls_test)
    show("tree confusion", evaluate.confusion_matrix(tree_pred))
    show("tree cells", evaluate.confusion_cells(tree_pred))
    _, log_pred = models.fit_and_score(models.logistic(), cls_train, cls_test)
    show("logistic cells", evaluate.confusion_cells(log_pred))
    print("weighted precision", evaluate.weighted_precision(log_pred), "AUC", evaluate.area_under_roc(log_pred))

    # 4. Text: clean, tokens, stop words, hashing, IDF, spam model.
    words = text.tokenize(text.clean_text(sms))
    terms = text.remove_stop_words(words)
    show("terms", terms.select("id", "terms"), 4)
    hashed = text.hash_terms(terms, num_features=1024)
    sms_train, sms_test = prep.train_test_split(hashed, "id", 0.8, 13)
    idf_model, _ = text.fit_idf(sms_train)
    _, spam_pred = models.fit_and_score(models.logistic(regParam=0.2), idf_model.transform(sms_train),
                                        idf_model.transform(sms_test))
    show("spam confusion", evaluate.confusion_matrix(spam_pred))

    # 5. Regression: km, + origin, + departure buckets, + weekday and month; lasso.
    km_model, km_pred = models.fit_and_score(models.linear(), features.assemble(train, ["km"]),
                                             features.assemble(test, ["km"]))
    show("km model", introspect.coefficient_table(spark, km_model, ["km"]))
    print("RMSE km", evaluate.rmse(km_pred))
    org_fit = tune.regression_stages("org").fit(train)
    names = introspect.names_for(org_fit.transform(train.limit(0)))
    show("km + origin", introspect.coefficient_table(spark, org_fit.stages[-1], names))
    show("ground minutes", introspect.level_effects(spark, org_fit.stages[-1], names, "org_dummy_",
                                                    list(org_fit.stages[0].labelsArray[0])))
    b_train = features.bucketize(train, "depart", "depart_bucket")
    b_test = features.bucketize(test, "depart", "depart_bucket")
    lasso = tune.regression_stages("org", ("depart_bucket", "dow", "mon"),
                                   regression=models.linear(regParam=1.0, elasticNetParam=1.0)).fit(b_train)
    print("lasso RMSE", evaluate.rmse(lasso.transform(b_test)))
    show("lasso zeros", introspect.zero_count(spark, lasso.stages[-1]))

    # 6. Pipelines and cross-validated search.
    folds = common.with_folds(train, 5)
    reg = models.linear()
    grid = tune.linear_grid(reg)
    cv = tune.cross_validate(tune.regression_stages("org", regression=reg), grid,
                             RegressionEvaluator(labelCol="duration"), folds, 5)
    show("linear search", tune.search_table(spark, cv))
    show("best stages", introspect.stage_params(spark, cv.bestModel))
    print("best test RMSE", evaluate.rmse(cv.bestModel.transform(test)))

    # 7. Boosted trees vs tree; forest search.
    gbt, gbt_pred = models.fit_and_score(models.boosted_trees(), cls_train, cls_test)
    show("auc", evaluate.metric_table(spark, [("tree", "auc", evaluate.area_under_roc(tree_pred)),
                                              ("gbt", "auc", evaluate.area_under_roc(gbt_pred))]))
    show("trees", introspect.tree_summary(spark, gbt))
    show("importance", introspect.feature_importance(spark, gbt, ["mon", "depart", "duration"]))
    forest = models.random_forest()
    fgrid = tune.forest_grid(forest)
    fcv = tune.cross_validate(forest, fgrid, BinaryClassificationEvaluator(numBins=0),
                              common.with_folds(cls_train, 5), 5)
    show("forest search", tune.search_table(spark, fcv))
    print("forest test AUC", evaluate.area_under_roc(fcv.transform(cls_test)))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
