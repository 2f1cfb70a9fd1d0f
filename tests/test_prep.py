from sparkwright.operators import prep
from sparkwright.sources import views
from conftest import SF_SMALL


def test_km_and_label_goldens(flights_fixture):
    df = prep.threshold_label(prep.miles_to_km(flights_fixture))
    rows = df.collect()
    assert [r.km for r in rows] == [3465.0, 509.0, 542.0, 1989.0, 415.0]
    assert [r.label for r in rows] == [None, 1, 0, 0, None]
    assert "mile" not in df.columns


def test_cleaning_steps(flights_fixture):
    f = prep.drop_columns(flights_fixture, "flight")
    assert "flight" not in f.columns
    assert prep.null_rows(f, "delay").count() == 2
    assert prep.drop_incomplete(prep.valid_rows(f, "delay")).count() == 3
    assert prep.where(f, "mon = 0 AND dow <> mon").count() == 1


def test_split_is_a_function_of_the_key(spark):
    f = views.flights(spark, SF_SMALL)
    a = prep.with_split(f.repartition(1), "event_id").select("event_id", "is_train")
    b = prep.with_split(f.repartition(7), "event_id").select("event_id", "is_train")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ratio = prep.split_ratio(f, "event_id").first()
    assert ratio.train_rows + ratio.test_rows == f.count()
    assert abs(ratio.train_share - 0.8) < 0.05
    assert abs(ratio.train_test_ratio - ratio.train_rows / ratio.test_rows) < 1e-12


def test_train_test_partition_rows(spark):
    f = views.flights(spark, SF_SMALL)
    train, test = prep.train_test_split(f, "event_id")
    assert train.count() + test.count() == f.count()
    assert train.join(test, "event_id").count() == 0


def test_distinct_sorted(flights_fixture):
    rows = prep.distinct_sorted(flights_fixture, ["carrier"], ["carrier"]).collect()
    assert [r.carrier for r in rows] == ["AA", "UA", "US"]


def test_fractions_close_to_the_ends_leave_both_sides(spark):
    rows = spark.range(100_000)
    for fraction in (0.9996, 0.0004):
        train, test = prep.train_test_split(rows, "id", fraction)
        assert train.count() > 0 and test.count() > 0
    train, test = prep.train_test_split(rows, "id", 1.0)
    assert (train.count(), test.count()) == (100_000, 0)


def test_building_a_query_over_a_join_runs_no_job(spark):
    from sparkwright.functions.partitioning import persisted
    from sparkwright.sources import views
    docs = spark.range(1000).selectExpr("id AS doc_id", "string(id) AS text")
    labels = spark.range(1000).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    spark.sparkContext.setJobGroup("build", "building")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        with persisted(views.sms_from_tables(docs, labels)):
            assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_salted_join_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F

    from sparkwright.functions.joins import salted_join
    n = 3000
    big = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                F.col("id").alias("v"))          # key 7 holds a third of all rows
    small = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    salts = 16
    salted = big.withColumn("__salt", F.abs(F.xxhash64(*big.columns)) % F.lit(salts))
    spread = salted.filter("k = 7").select("__salt").distinct().count()
    assert spread == salts                                          # the hot key lands on every salt
    joined = salted_join(big, small, on="k", salts=salts)
    plain = big.join(small, "k")
    assert joined.count() == plain.count() == n
    assert joined.exceptAll(plain.select(*joined.columns)).count() == 0


def test_join_without_adaptive_execution_is_salted(spark):
    from pyspark.sql import functions as F

    from sparkwright.functions.joins import skew_safe_join
    big = spark.range(200).select((F.col("id") % 5).alias("t"), F.col("id"))
    small = big.groupBy("t").count()
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        off = skew_safe_join(big, small, on="t", salts=4)
        assert "__salt" in off._jdf.queryExecution().logical().toString()
        rows = sorted(map(tuple, off.select("t", "id", "count").collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    on = skew_safe_join(big, small, on="t")
    assert sorted(map(tuple, on.select("t", "id", "count").collect())) == rows and len(rows) == 200
