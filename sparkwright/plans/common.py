"""Shared preparation for the registered queries.

``prepared`` is the cleaned flights frame of the exercises: flight dropped,
rows with a missing delay removed, remaining incomplete rows dropped, miles to
km, label = delay >= 15.  ``split`` cuts it 80:20 by a hash of ``event_id``.
Everything here is narrow (projections and filters over one parquet scan), but
for ``split``: large tables are dealt out evenly for the passes of the fits.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import fold_column
from ..functions.partitioning import spread
from ..operators import features, prep
from ..sources import views

KEY = "event_id"
SPLIT_SEED = 17        # fixed value: flights split seed of the exercises
SMS_SPLIT_SEED = 13    # fixed value: sms split seed of the exercises
TRAIN_FRACTION = 0.8


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.flights(spark, sf_dir)
    df = prep.drop_columns(df, "flight")
    df = prep.valid_rows(df, "delay")
    df = prep.drop_incomplete(df)
    df = prep.miles_to_km(df)
    return prep.threshold_label(df, "delay", 15, "label")


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n_rows = views.table(spark, sf_dir, "events").count()  # from the file footers
    return prep.train_test_split(spread(prepared(spark, sf_dir), n_rows), KEY, TRAIN_FRACTION, SPLIT_SEED)


def with_folds(df: DataFrame, num_folds: int, key: str = KEY) -> DataFrame:
    return df.withColumn("fold", fold_column(key, num_folds))


def plain_bucket(df: DataFrame) -> DataFrame:
    """Departure bucket as a plain number (Bucketizer marks it nominal; trees
    would then treat it as a category).  Used by the single-split oracle models."""
    out = features.bucketize(df, "depart", "depart_bucket")
    return out.withColumn("depart_bucket", F.col("depart_bucket").alias("depart_bucket", metadata={}))


def p1(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def r(col: Column | str, digits: int = 6) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, digits)


def one_row(spark: SparkSession, **values: float) -> DataFrame:
    from pyspark.sql.types import DoubleType, StructField, StructType
    schema = StructType([StructField(k, DoubleType(), True) for k in values])
    return spark.createDataFrame([tuple(float(v) if v is not None else None for v in values.values())], schema)
