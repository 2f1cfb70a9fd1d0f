from pyspark.ml.functions import vector_to_array

from sparkwright.functions.vectors import feature_names, one_hot_slot, vector_width
from sparkwright.operators import features


def test_bucket_goldens(flights_fixture):
    rows = features.bucketize(flights_fixture, "depart", "depart_bucket").collect()
    assert [r.depart_bucket for r in rows] == [3.0, 5.0, 2.0, 3.0, 2.0]


def test_index_by_frequency_then_alphabet(flights_fixture):
    model, df = features.index_categories(flights_fixture, ["org", "carrier"], ["org_idx", "carrier_idx"])
    assert list(model.labelsArray[0]) == ["ORD", "JFK", "SFO"]       # 3 x ORD, then ties A-Z
    assert list(model.labelsArray[1]) == ["AA", "UA", "US"]
    cm = features.category_map(model, ["org", "carrier"]).collect()
    assert ("org", "JFK", 1.0) in [tuple(r) for r in cm]


def test_one_hot_drops_last_level(flights_fixture):
    _, df = features.index_categories(flights_fixture, ["org"], ["org_idx"])
    model, df = features.one_hot(df, ["org_idx", "dow"], ["org_dummy", "dow_dummy"])
    assert list(model.categorySizes) == [3, 7]
    out = df.select("org", one_hot_slot("org_dummy").alias("s"), vector_width("org_dummy").alias("w"),
                    one_hot_slot("dow_dummy").alias("d")).collect()
    by_org = {r.org: r.s for r in out}
    assert by_org == {"ORD": 0, "JFK": 1, "SFO": None} and {r.w for r in out} == {2}
    assert [r.d for r in out] == [None, 2, 4, 1, 5]                   # dow 6 is the dropped level


def test_assemble_names_and_values(flights_fixture):
    _, df = features.index_categories(flights_fixture, ["org"], ["org_idx"])
    _, df = features.one_hot(df, ["org_idx"], ["org_dummy"])
    df = features.assemble(df, ["depart", "org_dummy"])
    assert feature_names(df) == ["depart", "org_dummy_ORD", "org_dummy_JFK"]
    first = df.select(vector_to_array("features").alias("a")).first().a
    assert first == [9.48, 0.0, 1.0]


def test_unseen_category_raises_by_default_and_keep_adds_a_level(spark):
    import pytest
    train = spark.createDataFrame([("ORD",), ("ORD",), ("SFO",)], "org string")
    test = spark.createDataFrame([("ORD",), ("XYZ",)], "org string")
    model, _ = features.index_categories(train, ["org"], ["org_idx"])
    with pytest.raises(Exception):
        model.transform(test).collect()
    keep, _ = features.index_categories(train, ["org"], ["org_idx"], handle_invalid="keep")
    assert [r.org_idx for r in keep.transform(test).orderBy("org").collect()] == [0.0, 2.0]


def test_bucket_range_and_nulls(spark):
    import pytest
    df = spark.createDataFrame([(0.0,), (23.99,), (24.0,), (None,)], "depart double")
    got = [r.depart_bucket for r in features.bucketize(df, "depart", "depart_bucket").collect()]
    assert got == [0.0, 7.0, 7.0, None]               # last bucket closed at both ends; null stays null
    for hi in ("error", "keep"):                       # outside the splits: always an error
        with pytest.raises(Exception):
            features.bucketize(spark.createDataFrame([(25.0,)], "depart double"), "depart", "b",
                               handle_invalid=hi).collect()
    nan = spark.createDataFrame([(float("nan"),)], "depart double")
    assert features.bucketize(nan, "depart", "b", handle_invalid="keep").first().b == 8.0


def test_null_into_assembler_raises_unless_skipped(spark):
    import pytest
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(Exception):
        features.assemble(df, ["a", "b"]).collect()
    assert features.assemble(df, ["a", "b"], handle_invalid="skip").count() == 1
