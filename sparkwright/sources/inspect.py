"""Schema as data (S4), row count (S5) and an ordered preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, IntegerType, StringType, StructField,
                               StructType)

SCHEMA_TABLE = StructType([
    StructField("position", IntegerType(), False),
    StructField("column_name", StringType(), False),
    StructField("data_type", StringType(), False),
    StructField("nullable", BooleanType(), False),
])


def schema_table(df: DataFrame) -> DataFrame:
    """``df.dtypes`` as rows; one row per column, so bounded by the schema width."""
    rows = [(i, f.name, f.dataType.simpleString(), bool(f.nullable))
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, SCHEMA_TABLE)


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """``count()`` kept as a one-row DataFrame (partial counts per task, one final add)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def preview(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """First ``n`` rows by a key: a distributed top-k, so the order is stable."""
    keys = order_by or tuple(df.columns[:1])
    return df.orderBy(*keys).limit(n)
