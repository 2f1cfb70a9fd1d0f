"""Views from the shared test tables to the two inputs the operators expect.

The raw test tables carry almost no learnable signal, so ``flights`` plants
nulls and effects (distance, origin, afternoon delays) on top of ``events``.
The same view is written in SQL for the DuckDB oracle in ``plans/oracle.py``;
both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed values of the test adapter (ground minutes per origin, delay rule,
# planted null rate).  Written as SQL expressions so the literals are decimals
# in Spark exactly as in the DuckDB oracle (plans/oracle.py), which repeats them.
_K = "try_cast(regexp_extract(props, '([0-9]+)', 1) as int)"
_FLIGHT_COLUMNS = [
    "event_id",
    "cast(user_id % 12 as int) as mon",
    "cast(day(ts) as int) as dom",
    "cast(weekday(ts) as int) as dow",
    "concat('C', cast(user_id % 9 as string)) as carrier",
    "user_id as flight",
    "event_type as org",
    "100 + 25 * k as mile",
    "round(hour(ts) + minute(ts) / cast(60 as double), 2) as depart",
    "cast(round(44 + 0.0757 * (100 + 25 * k) * 1.60934"
    " + case event_type when 'click' then 30 when 'view' then 20 when 'error' then -5 else 0 end"
    " + (value - 50) / 10) as int) as duration",
    "case when event_id % 16 = 0 then null"
    " else cast(floor(value / 4) as int) + case when hour(ts) >= 15 then 25 else 0 end - 10 end as delay",
]


def flights_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> flights schema (mon, dom, dow, carrier, flight, org, mile,
    depart, duration, delay) keyed by ``event_id``; one projection, no shuffle."""
    return events.withColumn("k", F.expr(_K)).selectExpr(*_FLIGHT_COLUMNS)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_events(table(spark, sf_dir, "events"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that has a text, as (id, text)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("id"), "text").where(F.col("text").isNotNull())


def sms_from_tables(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` joined with ``labels`` -> (id, text, label); Spark picks
    the join by the measured size of ``labels``."""
    docs = documents.select("doc_id", "text")
    labs = labels.select("doc_id", F.col("quality").alias("label"))
    joined = docs.join(labs, on="doc_id")
    return joined.select(F.col("doc_id").alias("id"), "text", F.col("label").cast("int").alias("label"))


def sms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sms_from_tables(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
