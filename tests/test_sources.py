import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from conftest import SF_SMALL
from sparkwright.sources import (FLIGHTS_SCHEMA, SMS_SCHEMA, column_types, preview, read_flights_csv, read_sms_csv,
                                 read_with_rejects, row_count, schema_table, views, write_sms_csv)
from sparkwright.session import scratch_path


def test_inferred_types_match_the_exercises_dtypes(flights_fixture):
    assert flights_fixture.dtypes == [(f.name, f.dataType.simpleString()) for f in FLIGHTS_SCHEMA.fields]
    assert [r.delay for r in flights_fixture.collect()] == [None, 30, -8, -5, None]


def test_declared_schema_reads_without_inference(spark, write_text):
    from conftest import FLIGHTS_CSV
    df = read_flights_csv(spark, write_text("f", FLIGHTS_CSV))
    assert df.schema == FLIGHTS_SCHEMA
    assert df.filter(F.col("delay").isNull()).count() == 2


def test_permissive_malformed_rows(spark, write_text):
    bad = "mon,dom,dow,carrier,flight,org,mile,depart,duration,delay\n1,2,3,AA,9\n1,x,3,AA,9,ORD,10,1.5,20,NA\n"
    rows = read_flights_csv(spark, write_text("bad", bad)).orderBy("dom").collect()
    short = [r for r in rows if r.flight == 9 and r.org is None][0]
    assert short.mile is None and short.delay is None          # short row: padded with nulls
    assert any(r.dom is None and r.org == "ORD" for r in rows)  # bad int: null


def test_sms_semicolon_no_header(sms_fixture):
    assert sms_fixture.schema == SMS_SCHEMA
    rows = sms_fixture.orderBy("id").collect()
    assert [r.label for r in rows] == [0, 0, 1, 1]
    assert rows[0].text == "Sorry, I'll call later in meeting"


def test_sms_round_trip_keeps_awkward_text(spark):
    texts = [(1, ' lead and trail ', 0), (2, 'semi;colon "quoted"\nnew line', 1), (3, '', 0), (4, None, 1)]
    df = spark.createDataFrame(texts, SMS_SCHEMA)
    back = read_sms_csv(spark, write_sms_csv(df, scratch_path(spark, "sms-test")), multiline=True)
    got = sorted(back.collect(), key=lambda r: r.id)
    assert [tuple(r) for r in got[:2]] == texts[:2]
    # Default CSV null token is the empty string: an empty text reads back as null.
    assert got[2].text is None and got[3].text is None
    path = write_sms_csv(df, scratch_path(spark, "sms-test"), "\\N")
    told = read_sms_csv(spark, path, multiline=True, null_token="\\N")
    assert sorted(map(tuple, told.collect())) == texts


@pytest.mark.parametrize("options", [{}, {"escaped_lines": True}])
def test_sms_table_round_trip_with_defaults(spark, options):
    """Texts with line feeds come back as one row each, equal."""
    rows = views.sms(spark, SF_SMALL)
    wanted = sorted(map(tuple, rows.collect()))
    assert sum("\n" in (t or "") for _, t, _ in wanted) > 50
    back = read_sms_csv(spark, write_sms_csv(rows, scratch_path(spark, "sms-all"), **options), **options)
    assert sorted(map(tuple, back.collect())) == [(i, t or None, x) for i, t, x in wanted]


def test_escaped_lines_keep_backslashes(spark):
    texts = ["a\nb", "a\\nb", "\\", "\\\\n", "\r\n\\\n", 'q"; \\"\n', "plain"]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)] + [(9, None, None)], SMS_SCHEMA)
    path = write_sms_csv(df, scratch_path(spark, "sms-esc"), "\\N", escaped_lines=True)
    back = read_sms_csv(spark, path, null_token="\\N", escaped_lines=True)
    assert {r.id: r.text for r in back.collect()} == {**dict(enumerate(texts)), 9: None}


def test_rejected_rows_have_reasons(spark, write_text):
    schema = StructType([StructField("a", IntegerType()), StructField("b", DoubleType()), StructField("c", StringType())])
    text = 'a,b,c\n1,2.5,x\nNA,NA,NA\n2,two,y\n3,1\n4,1,z,more\nfive,six,"q, r"\n99999999999,1,z\n,,\n'
    good, bad = read_with_rejects(spark, write_text("faulty", text), schema)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, 2.5, "x"), (None, None, None), (None, None, None)], key=str)
    found = {r.record: r.reasons for r in bad.collect()}
    assert found == {
        "2,two,y": ["b: not double"], "3,1": ["c: missing"], "4,1,z,more": ["more than 3 fields"],
        'five,six,"q, r"': ["a: not int", "b: not double"], "99999999999,1,z": ["a: not int"]}
    assert all(r.file.endswith("part-0.csv") for r in bad.collect())
    assert bad.count() == 5 and good.count() == 3 and good.select("a").count() == 3 and len(good.select("a").collect()) == 3


def test_column_types(spark):
    rows = [("1", "1", "1.5", "x", "NA"), ("-2", "3000000000", "2", "1", ""), ("NA", "", "1e3", "2", None)]
    got = {r.column_name: r.data_type for r in column_types(spark.createDataFrame(rows, "a string, b string, c string, d string, e string")).collect()}
    assert got == {"a": "int", "b": "bigint", "c": "double", "d": "string", "e": "string"}


def test_schema_count_preview(flights_fixture):
    st = schema_table(flights_fixture).orderBy("position").collect()
    assert [(r.column_name, r.data_type) for r in st][:3] == [("mon", "int"), ("dom", "int"), ("dow", "int")]
    assert row_count(flights_fixture).first().n == 5
    assert [r.mon for r in preview(flights_fixture, 2, "mon").collect()] == [0, 2]
