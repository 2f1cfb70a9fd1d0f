"""Queries for sources, cleaning, splits and encoders (S, P, A6-A9, F)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.vectors import one_hot_slot, vector_slots, vector_width
from ..operators import features, prep
from ..session import scratch_path
from ..sources import csv as csv_source
from ..sources import inspect as src_inspect
from ..sources import views
from . import oracle as o
from .common import KEY, SPLIT_SEED, TRAIN_FRACTION, prepared

FLIGHT_COLS = ["event_id", "mon", "dom", "dow", "carrier", "flight", "org", "mile",
               "depart", "duration", "delay"]
PREPARED_COLS = ["event_id", "mon", "dom", "dow", "carrier", "org", "depart", "duration",
                 "delay", "km", "label"]


# ---- S: sources -----------------------------------------------------------

def s1_csv_inferred(spark, sf_dir):
    """CSV with header, ``NA`` nulls, inferred types, read back from a file
    Spark wrote from the flights view.  The write is only there because the
    shared tables are parquet; a user points ``read_flights_csv`` at their
    files.  Inference costs one extra pass over the files."""
    path = csv_source.write_flights_csv(views.flights(spark, sf_dir), scratch_path(spark, "flights-csv"))
    df = csv_source.read_flights_csv(spark, path, infer_schema=True)
    return df.withColumns({c: F.col(c).cast("bigint") for c in ("event_id", "flight")})


#: Stand-in for a faulty file: every so many rows a field that is not of its type.
BAD_FIELDS = {"mile": (97, "far"), "duration": (89, "12x"), "depart": (83, "noon"), "mon": (79, "99999999999")}


def _faulty_csv(spark, sf_dir) -> str:
    """The flights as a CSV of strings in which some fields are no numbers."""
    rows = views.flights(spark, sf_dir)
    texts = {c: F.col(c).cast("string") for c in rows.columns}
    for c, (every, token) in BAD_FIELDS.items():
        texts[c] = F.when(F.col("event_id") % every == 0, token).otherwise(texts[c])
    return csv_source.write_flights_csv(rows.select(*(v.alias(c) for c, v in texts.items())), scratch_path(spark, "faulty-csv"))


def _faulty_read(spark, sf_dir):
    schema = StructType([StructField("event_id", LongType()), *csv_source.FLIGHTS_SCHEMA.fields])
    return csv_source.read_with_rejects(spark, _faulty_csv(spark, sf_dir), schema)


def s1_rejected_rows(spark, sf_dir):
    """Rows of a faulty CSV that do not fit the schema, with what is wrong."""
    _, rejected = _faulty_read(spark, sf_dir)
    event_id = F.split_part("record", F.lit(","), F.lit(1)).cast("bigint")
    return rejected.select(event_id.alias("event_id"), F.array_join("reasons", "; ").alias("reasons"),
                           F.col("file").endswith(".csv").alias("has_file"))


def s1_accepted_rows(spark, sf_dir):
    """The other rows of that file, typed."""
    accepted, _ = _faulty_read(spark, sf_dir)
    return accepted.select("event_id", "mon", "depart", "mile", "duration", "delay")


def s1_column_types(spark, sf_dir):
    """The narrowest type of each column of the faulty file, from one pass."""
    strings = spark.read.options(sep=",", header="true").csv(_faulty_csv(spark, sf_dir))
    return csv_source.column_types(strings)


def s2_csv_declared(spark, sf_dir):
    """Semicolon CSV, no header, declared (id bigint, text string, label int);
    the texts hold line feeds, and null is told from empty."""
    path = csv_source.write_sms_csv(views.sms(spark, sf_dir), scratch_path(spark, "sms-csv"), "\\N")
    return csv_source.read_sms_csv(spark, path, "id bigint, text string, label int", True, "\\N")


def s4_schema_table(spark, sf_dir):
    """``dtypes`` of the flights view as rows."""
    return src_inspect.schema_table(views.flights(spark, sf_dir))


def s5_row_counts(spark, sf_dir):
    """Counts of the cleaning steps: all rows, null delay, complete rows."""
    f = prep.drop_columns(views.flights(spark, sf_dir), "flight")
    complete = F.lit(True)
    for c in f.columns:
        complete = complete & F.col(c).isNotNull()
    return f.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("delay").isNull()).alias("n_null_delay"),
                 F.count_if(complete).alias("n_complete"))


def s6_preview(spark, sf_dir):
    return src_inspect.preview(views.flights(spark, sf_dir), 5, KEY)


# ---- P: projections and filters --------------------------------------------

def p1_drop_column(spark, sf_dir):
    return prep.drop_columns(views.flights(spark, sf_dir), "flight")


def p2_null_delay(spark, sf_dir):
    return prep.null_rows(prep.drop_columns(views.flights(spark, sf_dir), "flight"), "delay")


def p2_valid_delay(spark, sf_dir):
    return prep.valid_rows(prep.drop_columns(views.flights(spark, sf_dir), "flight"), "delay")


def p3_dropna(spark, sf_dir):
    f = prep.valid_rows(prep.drop_columns(views.flights(spark, sf_dir), "flight"), "delay")
    return prep.drop_incomplete(f)


def p5_km(spark, sf_dir):
    return prepared(spark, sf_dir).select(KEY, "km")


def p6_label(spark, sf_dir):
    return prepared(spark, sf_dir).select(KEY, "delay", "label")


def p7_select(spark, sf_dir):
    return prep.select(prepared(spark, sf_dir), KEY, "mon", "depart", "duration", "label")


# ---- A6-A9: distinct, sort, split -------------------------------------------

def a6_category_map(spark, sf_dir):
    """Distinct (org, org_idx, org_dummy) sorted by index, dummy as slot/width."""
    _, df = features.index_categories(prepared(spark, sf_dir), ["org"], ["org_idx"])
    _, df = features.one_hot(df, ["org_idx"], ["org_dummy"])
    m = prep.distinct_sorted(df, ["org", "org_idx", "org_dummy"], ["org_idx"])
    return m.select("org", "org_idx", one_hot_slot("org_dummy").alias("dummy_slot"),
                    vector_width("org_dummy").alias("dummy_width"))


def a8_split(spark, sf_dir):
    return prep.with_split(prepared(spark, sf_dir), KEY, TRAIN_FRACTION, SPLIT_SEED).select(KEY, "is_train")


def a9_split_ratio(spark, sf_dir):
    return prep.split_ratio(prepared(spark, sf_dir), KEY, TRAIN_FRACTION, SPLIT_SEED)


# ---- F: encoders --------------------------------------------------------------

def f1_string_index(spark, sf_dir):
    _, df = features.index_categories(prepared(spark, sf_dir), ["carrier", "org"],
                                      ["carrier_idx", "org_idx"])
    return df.select(KEY, "carrier", "carrier_idx", "org", "org_idx")


def f2_one_hot(spark, sf_dir):
    _, df = features.index_categories(prepared(spark, sf_dir), ["org"], ["org_idx"])
    _, df = features.one_hot(df, ["org_idx"], ["org_dummy"])
    return df.select(KEY, "org_idx", one_hot_slot("org_dummy").alias("org_slot"),
                     vector_width("org_dummy").alias("org_width"))


def f3_one_hot_multi(spark, sf_dir):
    _, df = features.index_categories(prepared(spark, sf_dir), ["org"], ["org_idx"])
    _, df = features.one_hot(df, ["org_idx", "dow"], ["org_dummy", "dow_dummy"])
    return df.select(KEY, one_hot_slot("org_dummy").alias("org_slot"),
                     vector_width("org_dummy").alias("org_width"),
                     one_hot_slot("dow_dummy").alias("dow_slot"),
                     vector_width("dow_dummy").alias("dow_width"))


def f4_one_hot_bucket(spark, sf_dir):
    df = features.bucketize(prepared(spark, sf_dir), "depart", "depart_bucket")
    _, df = features.one_hot(df, ["depart_bucket"], ["depart_dummy"])
    return df.select(KEY, "depart_bucket", one_hot_slot("depart_dummy").alias("depart_slot"),
                     vector_width("depart_dummy").alias("depart_width"))


def f5_bucketize(spark, sf_dir):
    return features.bucketize(prepared(spark, sf_dir), "depart", "depart_bucket").select(
        KEY, "depart", "depart_bucket")


ASSEMBLED = ["mon", "dom", "dow", "carrier_idx", "org_idx", "km", "depart", "duration"]


def f6_assemble(spark, sf_dir):
    _, df = features.index_categories(prepared(spark, sf_dir), ["carrier", "org"],
                                      ["carrier_idx", "org_idx"])
    df = features.assemble(df, ASSEMBLED, "features")
    return df.select(KEY, *vector_slots("features", len(ASSEMBLED)))


QUERIES = {
    "s1_csv_inferred": s1_csv_inferred,
    "s1_rejected_rows": s1_rejected_rows,
    "s1_accepted_rows": s1_accepted_rows,
    "s1_column_types": s1_column_types,
    "s2_csv_declared": s2_csv_declared,
    "s4_schema_table": s4_schema_table,
    "s5_row_counts": s5_row_counts,
    "s6_preview": s6_preview,
    "p1_drop_column": p1_drop_column,
    "p2_null_delay": p2_null_delay,
    "p2_valid_delay": p2_valid_delay,
    "p3_dropna": p3_dropna,
    "p5_km": p5_km,
    "p6_label": p6_label,
    "p7_select": p7_select,
    "a6_category_map": a6_category_map,
    "a8_split": a8_split,
    "a9_split_ratio": a9_split_ratio,
    "f1_string_index": f1_string_index,
    "f2_one_hot": f2_one_hot,
    "f3_one_hot_multi": f3_one_hot_multi,
    "f4_one_hot_bucket": f4_one_hot_bucket,
    "f5_bucketize": f5_bucketize,
    "f6_assemble": f6_assemble,
}

# ---- oracle ------------------------------------------------------------------------

_FLIGHT_SELECT = ", ".join(FLIGHT_COLS)
_NO_FLIGHT = ", ".join(c for c in FLIGHT_COLS if c != "flight")
_INDEX = """
idx AS (
  SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS {c}_idx,
         CAST(count(*) OVER () AS INTEGER) AS {c}_levels
  FROM prepared GROUP BY {c})"""

_SCHEMA_ROWS = ", ".join(
    f"({i}, '{c}', '{t}', true)" for i, (c, t) in enumerate(zip(
        FLIGHT_COLS, ["bigint", "int", "int", "int", "string", "bigint", "string", "int", "double",
                      "int", "int"])))

_KINDS = {"mile": "int", "duration": "int", "depart": "double", "mon": "int"}
_REASONS = " , ".join(f"CASE WHEN event_id % {BAD_FIELDS[c][0]} = 0 THEN '{c}: not {_KINDS[c]}' END" for c in ("mon", "mile", "depart", "duration"))
_BAD = " OR ".join(f"event_id % {every} = 0" for every, _ in BAD_FIELDS.values())
_TEXTS = ", ".join(
    f"CASE WHEN event_id % {BAD_FIELDS[c][0]} = 0 THEN '{BAD_FIELDS[c][1]}' ELSE CAST({c} AS VARCHAR) END AS {c}" if c in BAD_FIELDS
    else f"CAST({c} AS VARCHAR) AS {c}" for c in FLIGHT_COLS)

ORACLE = {
    "s1_rejected_rows": o.with_sql(o.FLIGHTS, f"""
        SELECT event_id, concat_ws('; ', {_REASONS}) AS reasons, true AS has_file FROM flights WHERE {_BAD}"""),
    "s1_accepted_rows": o.with_sql(o.FLIGHTS, f"""
        SELECT event_id, mon, depart, CAST(mile AS INTEGER) AS mile, duration, delay FROM flights WHERE NOT ({_BAD})"""),
    "s1_column_types": o.with_sql(o.FLIGHTS + f""",
        texts AS (SELECT {_TEXTS} FROM flights),
        long AS (UNPIVOT texts ON COLUMNS(*) INTO NAME column_name VALUE v),
        counts AS (
          SELECT column_name, count(*) AS n_values,
            count(*) FILTER (NOT regexp_full_match(v, '[+-]?[0-9]{{1,18}}') OR TRY_CAST(v AS INTEGER) IS NULL) AS not_int,
            count(*) FILTER (NOT regexp_full_match(v, '[+-]?[0-9]{{1,18}}')) AS not_bigint,
            count(*) FILTER (TRY_CAST(v AS DOUBLE) IS NULL) AS not_double
          FROM long GROUP BY column_name)""", """
        SELECT column_name, CASE WHEN not_int = 0 THEN 'int' WHEN not_bigint = 0 THEN 'bigint' WHEN not_double = 0 THEN 'double'
               ELSE 'string' END AS data_type, n_values, not_int, not_bigint, not_double FROM counts"""),
    "s1_csv_inferred": o.with_sql(o.FLIGHTS, f"SELECT {_FLIGHT_SELECT} FROM flights"),
    "s2_csv_declared": o.with_sql(o.SMS, "SELECT id, text, label FROM sms"),
    "s4_schema_table": ("SELECT CAST(position AS INTEGER) AS position, column_name, data_type, nullable "
                        f"FROM (VALUES {_SCHEMA_ROWS}) AS t(position, column_name, data_type, nullable)"),
    "s5_row_counts": o.with_sql(o.FLIGHTS, f"""
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE delay IS NULL) AS n_null_delay,
               count(*) FILTER (WHERE {' AND '.join(c + ' IS NOT NULL' for c in FLIGHT_COLS if c != 'flight')}) AS n_complete
        FROM flights"""),
    "s6_preview": o.with_sql(o.FLIGHTS, f"SELECT {_FLIGHT_SELECT} FROM flights ORDER BY event_id LIMIT 5"),
    "p1_drop_column": o.with_sql(o.FLIGHTS, f"SELECT {_NO_FLIGHT} FROM flights"),
    "p2_null_delay": o.with_sql(o.FLIGHTS, f"SELECT {_NO_FLIGHT} FROM flights WHERE delay IS NULL"),
    "p2_valid_delay": o.with_sql(o.FLIGHTS, f"SELECT {_NO_FLIGHT} FROM flights WHERE delay IS NOT NULL"),
    "p3_dropna": o.with_sql(o.FLIGHTS, f"""
        SELECT {_NO_FLIGHT} FROM flights
        WHERE {' AND '.join(c + ' IS NOT NULL' for c in FLIGHT_COLS if c != 'flight')}"""),
    "p5_km": o.with_sql(o.PREPARED, "SELECT event_id, km FROM prepared"),
    "p6_label": o.with_sql(o.PREPARED, "SELECT event_id, delay, label FROM prepared"),
    "p7_select": o.with_sql(o.PREPARED, "SELECT event_id, mon, depart, duration, label FROM prepared"),
    "a6_category_map": o.with_sql(o.PREPARED + "," + _INDEX.format(c="org"), """
        SELECT org, org_idx,
               CASE WHEN org_idx < org_levels - 1 THEN CAST(org_idx AS INTEGER) END AS dummy_slot,
               org_levels - 1 AS dummy_width
        FROM idx ORDER BY org_idx"""),
    "a8_split": o.with_sql(o.SPLIT, "SELECT event_id, is_train FROM split"),
    "a9_split_ratio": o.with_sql(o.SPLIT, """
        SELECT count(*) FILTER (WHERE is_train) AS train_rows,
               count(*) FILTER (WHERE NOT is_train) AS test_rows,
               CAST(count(*) FILTER (WHERE is_train) AS DOUBLE) / count(*) FILTER (WHERE NOT is_train) AS train_test_ratio,
               CAST(count(*) FILTER (WHERE is_train) AS DOUBLE) / count(*) AS train_share
        FROM split"""),
    "f1_string_index": o.with_sql(
        o.PREPARED + "," + _INDEX.format(c="carrier").replace("idx AS", "cidx AS")
        + "," + _INDEX.format(c="org").replace("idx AS", "oidx AS"), """
        SELECT p.event_id, p.carrier, c.carrier_idx, p.org, x.org_idx
        FROM prepared p JOIN cidx c ON p.carrier = c.carrier JOIN oidx x ON p.org = x.org"""),
    "f2_one_hot": o.with_sql(o.PREPARED + "," + _INDEX.format(c="org"), """
        SELECT p.event_id, i.org_idx,
               CASE WHEN i.org_idx < i.org_levels - 1 THEN CAST(i.org_idx AS INTEGER) END AS org_slot,
               i.org_levels - 1 AS org_width
        FROM prepared p JOIN idx i ON p.org = i.org"""),
    "f3_one_hot_multi": o.with_sql(o.PREPARED + "," + _INDEX.format(c="org"), """
        SELECT event_id, org_slot, org_width,
               CASE WHEN dow < max_dow THEN dow END AS dow_slot, max_dow AS dow_width
        FROM (
          SELECT p.event_id, p.dow, max(p.dow) OVER () AS max_dow,
                 CASE WHEN i.org_idx < i.org_levels - 1 THEN CAST(i.org_idx AS INTEGER) END AS org_slot,
                 i.org_levels - 1 AS org_width
          FROM prepared p JOIN idx i ON p.org = i.org)"""),
    "f4_one_hot_bucket": o.with_sql(o.PREPARED, """
        SELECT event_id, depart_bucket,
               CASE WHEN depart_bucket < 7 THEN CAST(depart_bucket AS INTEGER) END AS depart_slot,
               7 AS depart_width
        FROM (SELECT event_id, CAST(least(floor(depart / 3), 7) AS DOUBLE) AS depart_bucket FROM prepared)"""),
    "f5_bucketize": o.with_sql(o.PREPARED, """
        SELECT event_id, depart, CAST(least(floor(depart / 3), 7) AS DOUBLE) AS depart_bucket FROM prepared"""),
    "f6_assemble": o.with_sql(
        o.PREPARED + "," + _INDEX.format(c="carrier").replace("idx AS", "cidx AS")
        + "," + _INDEX.format(c="org").replace("idx AS", "oidx AS"), """
        SELECT p.event_id, CAST(p.mon AS DOUBLE) AS features_0, CAST(p.dom AS DOUBLE) AS features_1,
               CAST(p.dow AS DOUBLE) AS features_2, c.carrier_idx AS features_3, x.org_idx AS features_4,
               p.km AS features_5, p.depart AS features_6, CAST(p.duration AS DOUBLE) AS features_7
        FROM prepared p JOIN cidx c ON p.carrier = c.carrier JOIN oidx x ON p.org = x.org"""),
}
