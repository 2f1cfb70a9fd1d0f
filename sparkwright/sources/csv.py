"""Delimited-file scans (S1, S2) and the writers used to make CSV from the test tables.

Two reading styles, as in the exercises:

* ``flights``: comma separated, header row, ``NA`` as the null token, types
  either inferred (one extra pass over the files) or declared (no extra pass;
  the default here, since inference rereads every byte at scale).
* ``sms``: semicolon separated, no header, declared schema.

Malformed input follows Spark's PERMISSIVE mode: a short row pads with nulls
and a value that does not parse as the declared type becomes null;
``read_with_rejects`` keeps such rows apart, with reasons.  The sms
reader keeps Spark's default null token (the empty string), as the exercises
do, so an empty text reads back as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                               StructType)

# Types the exercises' flights file is inferred to have (column order as in the file).
FLIGHTS_SCHEMA = StructType([
    StructField("mon", IntegerType()),
    StructField("dom", IntegerType()),
    StructField("dow", IntegerType()),
    StructField("carrier", StringType()),
    StructField("flight", IntegerType()),
    StructField("org", StringType()),
    StructField("mile", IntegerType()),
    StructField("depart", DoubleType()),
    StructField("duration", IntegerType()),
    StructField("delay", IntegerType()),
])

SMS_SCHEMA = StructType([
    StructField("id", IntegerType()),
    StructField("text", StringType()),
    StructField("label", IntegerType()),
])

# Quoting chosen so any text survives a round trip: RFC-4180 doubled quotes,
# whitespace kept as is, quoted newlines allowed.
_TEXT_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
                 "ignoreTrailingWhiteSpace": "false"}


def read_flights_csv(spark: SparkSession, path: str, infer_schema: bool = False,
                     schema: StructType | None = None) -> DataFrame:
    """Comma file with a header and ``NA`` nulls.  Inference reads all files
    once more before the query."""
    reader = spark.read.options(sep=",", header="true", nullValue="NA")
    if infer_schema:
        reader = reader.option("inferSchema", "true")
    else:
        reader = reader.schema(schema or FLIGHTS_SCHEMA)
    return reader.csv(path)


def read_sms_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                 multiline: bool = True, null_token: str | None = None,
                 escaped_lines: bool = False) -> DataFrame:
    """Semicolon file, no header, declared schema.

    ``multiline`` lets quoted fields hold line feeds, so that a text is never
    torn into rows; such files are read one task per file, so write them as
    many part files (as ``write_sms_csv`` does).  ``escaped_lines`` reads what
    ``write_sms_csv`` wrote with it: a record per line, so files are split over
    tasks however large they are.  ``null_token`` tells null from an empty text
    (Spark's default reads both as null)."""
    multiline = multiline and not escaped_lines
    reader = (spark.read.schema(schema or SMS_SCHEMA)
              .options(sep=";", header="false", multiLine=str(multiline).lower(), **_TEXT_OPTIONS))
    if null_token is not None:
        reader = reader.options(nullValue=null_token, emptyValue="")
    df = reader.csv(path)
    return _each_text(df, _with_lines) if escaped_lines else df


def write_flights_csv(df: DataFrame, path: str) -> str:
    (df.write.mode("errorifexists").options(sep=",", header="true", nullValue="NA")
     .csv(path))
    return path


def _each_text(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name) if f.dataType == StringType() else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _without_lines(text: Column) -> Column:
    """Line feeds and carriage returns as backslash sequences."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _with_lines(text: Column) -> Column:
    """Undoes ``_without_lines``: escaped backslashes part the text, so what
    follows a backslash inside a part is an escape."""
    parts = F.split(text, r"\\\\", -1)
    plain = F.transform(parts, lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


def write_sms_csv(df: DataFrame, path: str, null_token: str | None = None, escaped_lines: bool = False) -> str:
    """``escaped_lines`` writes line feeds inside texts as ``\\n`` (and a
    backslash as two), one record per line."""
    if escaped_lines:
        df = _each_text(df, _without_lines)
    writer = df.write.mode("errorifexists").options(sep=";", header="false", **_TEXT_OPTIONS)
    if null_token is not None:
        writer = writer.options(nullValue=null_token, emptyValue='""')
    writer.csv(path)
    return path


# ---- rows that do not fit the schema -------------------------------------------------


def _field_reasons(fields: Column, schema: StructType, null_token: str) -> Column:
    """What is wrong with each field of a record, read as strings."""
    def one(f: StructField) -> Column:
        value = fields[f.name]
        bad = (value != null_token) & (value != "") & value.try_cast(f.dataType).isNull()
        return F.when(value.isNull(), F.lit(f"{f.name}: missing")).when(bad, F.lit(f"{f.name}: not {f.dataType.simpleString()}"))

    more = F.when(fields["__more"].isNotNull(), F.lit(f"more than {len(schema)} fields"))
    return F.array_compact(F.array(*map(one, schema.fields), more))


def read_with_rejects(spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = True,
                      null_token: str = "NA") -> tuple[DataFrame, DataFrame]:
    """S1 / S2 with a quarantine: the rows that fit the schema, and the others
    as ``(file, record, reasons)`` instead of rows with silent nulls.

    A record is rejected if a field does not parse as its type, or if it has
    too few or too many fields; ``reasons`` names each such field.  Both results
    come from one scan each, without a shuffle."""
    corrupt = "__corrupt"
    options = {"sep": sep, "header": str(header).lower(), **_TEXT_OPTIONS}
    raw = (spark.read.schema(StructType([*schema.fields, StructField(corrupt, StringType())]))
           .options(mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt, nullValue=null_token, **options).csv(path))
    strings = ", ".join(f"`{f.name}` string" for f in schema.fields) + ", __more string"
    fields = F.from_csv(F.col(corrupt), strings, {"sep": sep, "nullValue": "\0", **_TEXT_OPTIONS})
    # a record is judged by the columns that the scan reads, so both results read all of them
    whole = F.length(F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in schema.fields])) >= 0
    rejected = raw.where(F.col(corrupt).isNotNull() & whole).select(
        F.col("_metadata.file_path").alias("file"), F.col(corrupt).alias("record"), fields.alias("fields"))
    reasons = _field_reasons(F.col("fields"), schema, null_token)
    return (raw.where(F.col(corrupt).isNull() & whole).drop(corrupt),
            rejected.select("file", "record", reasons.alias("reasons")))


def column_types(strings: DataFrame, null_token: str = "NA") -> DataFrame:
    """The narrowest type of int, bigint, double and string that holds every
    value of a column, ``(column_name, data_type, n_values, not_int, not_bigint,
    not_double)``, for all columns in one aggregate over rows read as strings."""
    def tests(c: str) -> Column:
        v = F.when((F.col(f"`{c}`") != null_token) & (F.col(f"`{c}`") != ""), F.col(f"`{c}`"))
        whole = v.rlike(r"^[+-]?[0-9]{1,18}$")
        number = F.when(whole, v).try_cast("bigint")
        small = whole & number.between(-(1 << 31), (1 << 31) - 1)
        return F.struct(F.lit(c).alias("column_name"), F.count(v).alias("n_values"), F.count_if(~small).alias("not_int"),
                        F.count_if(~whole).alias("not_bigint"), F.count_if(v.isNotNull() & v.try_cast("double").isNull()).alias("not_double"))

    counts = strings.agg(F.array(*map(tests, strings.columns)).alias("c")).select(F.inline("c"))
    kind = (F.when(F.col("n_values") == 0, "string").when(F.col("not_int") == 0, "int").when(F.col("not_bigint") == 0, "bigint")
            .when(F.col("not_double") == 0, "double").otherwise("string"))
    return counts.select("column_name", kind.alias("data_type"), "n_values", "not_int", "not_bigint", "not_double")
