"""Projections, filters, derived columns, labels and key-hash splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import train_flag

KM_PER_MILE = 1.60934  # fixed value: miles to kilometres, rounded as in the exercises


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """P1. Column pruning reaches the scan, so dropped columns are never read."""
    return df.drop(*cols)


def null_rows(df: DataFrame, col: str) -> DataFrame:
    """P2. Rows where ``col`` is missing."""
    return df.filter(F.col(col).isNull())


def valid_rows(df: DataFrame, col: str) -> DataFrame:
    """P2. Rows where ``col`` is present."""
    return df.filter(F.col(col).isNotNull())


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """P3. Drop a row if any (of ``subset``) column is null."""
    return df.na.drop(how="any", subset=subset)


def where(df: DataFrame, predicate) -> DataFrame:
    """P4. A compound predicate (Column or SQL text such as
    ``prediction = 0 AND label <> prediction``)."""
    return df.filter(predicate)


def miles_to_km(df: DataFrame, mile_col: str = "mile", km_col: str = "km") -> DataFrame:
    """P5. ``km = round(mile * 1.60934, 0)`` replacing the mile column."""
    return df.withColumn(km_col, F.round(F.col(mile_col) * F.lit(KM_PER_MILE), 0)).drop(mile_col)


def threshold_label(df: DataFrame, col: str = "delay", threshold: float = 15,
                    label_col: str = "label") -> DataFrame:
    """P6. ``label = int(col >= threshold)``; a null ``col`` gives a null label,
    so clean first (``valid_rows``)."""
    return df.withColumn(label_col, (F.col(col) >= F.lit(threshold)).cast("int"))


def select(df: DataFrame, *cols) -> DataFrame:
    """P7."""
    return df.select(*cols)


def distinct_sorted(df: DataFrame, cols: list[str], order_by: list[str]) -> DataFrame:
    """A6 + A7. Distinct rows of ``cols`` sorted by ``order_by`` (hash aggregate, then a range sort)."""
    return df.select(*cols).distinct().orderBy(*order_by)


def with_split(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 17,
               flag_col: str = "is_train") -> DataFrame:
    """A8. Adds the deterministic train flag (a per-row function of the key)."""
    return df.withColumn(flag_col, train_flag(key, train_fraction, seed))


def train_test_split(df: DataFrame, key: str, train_fraction: float = 0.8,
                     seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """A8. ``(train, test)`` by key hash; same rows whatever the partitioning."""
    flag = train_flag(key, train_fraction, seed)
    return df.filter(flag), df.filter(~flag)


def split_ratio(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 17) -> DataFrame:
    """A9. One aggregate pass: train rows, test rows, train/test ratio and train share."""
    flag = train_flag(key, train_fraction, seed)
    counts = df.agg(F.count_if(flag).alias("train_rows"), F.count_if(~flag).alias("test_rows"))
    total = F.col("train_rows") + F.col("test_rows")
    return counts.select(
        "train_rows", "test_rows",
        F.try_divide(F.col("train_rows").cast("double"), F.col("test_rows")).alias("train_test_ratio"),
        F.try_divide(F.col("train_rows").cast("double"), total).alias("train_share"),
    )
