"""Feature encoding (F1-F6) with Spark ML's encoders.

The fitted state of each encoder is small by construction (a label list, a
category size, split points): fitting is one distributed aggregate, and scoring
is a projection with that state inside, so it adds no shuffle.
"""

from __future__ import annotations

from pyspark.ml.feature import (Bucketizer, OneHotEncoder, OneHotEncoderModel,
                                StringIndexer, StringIndexerModel, VectorAssembler)
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# Three-hour departure buckets over the day, as in the exercises.
DEPART_SPLITS = [0.0, 3.0, 6.0, 9.0, 12.0, 15.0, 18.0, 21.0, 24.0]


def index_categories(df: DataFrame, input_cols: list[str], output_cols: list[str],
                     handle_invalid: str = "error") -> tuple[StringIndexerModel, DataFrame]:
    """F1. Category -> index by falling frequency, ties alphabetical.

    ``handle_invalid='keep'`` maps categories unseen at fit time to an extra index.
    """
    model = StringIndexer(inputCols=input_cols, outputCols=output_cols,
                          stringOrderType="frequencyDesc", handleInvalid=handle_invalid).fit(df)
    return model, model.transform(df)


def category_map(model: StringIndexerModel, input_cols: list[str]) -> DataFrame:
    """The learned mapping as rows ``(column, category, idx)``; one row per level."""
    schema = StructType([StructField("column_name", StringType(), False),
                         StructField("category", StringType(), False),
                         StructField("idx", DoubleType(), False)])
    rows = [(c, label, float(i)) for c, labels in zip(input_cols, model.labelsArray)
            for i, label in enumerate(labels)]
    return _active().createDataFrame(rows, schema)


def one_hot(df: DataFrame, input_cols: list[str], output_cols: list[str],
            drop_last: bool = True, handle_invalid: str = "error") -> tuple[OneHotEncoderModel, DataFrame]:
    """F2-F4. One-hot of index or raw non-negative int columns; the last level
    becomes the all-zero vector when ``drop_last``."""
    model = OneHotEncoder(inputCols=input_cols, outputCols=output_cols, dropLast=drop_last,
                          handleInvalid=handle_invalid).fit(df)
    return model, model.transform(df)


def bucketize(df: DataFrame, input_col: str, output_col: str, splits: list[float] | None = None,
              handle_invalid: str = "error") -> DataFrame:
    """F5. Left-closed buckets, the last closed at both ends.  Values outside
    the splits always raise; NaN raises, or goes to an extra bucket with
    ``handle_invalid='keep'``; null stays null."""
    return Bucketizer(splits=splits or DEPART_SPLITS, inputCol=input_col, outputCol=output_col,
                      handleInvalid=handle_invalid).transform(df)


def assemble(df: DataFrame, input_cols: list[str], output_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """F6. Columns -> one vector; dense or sparse is chosen per row."""
    return VectorAssembler(inputCols=input_cols, outputCol=output_col,
                           handleInvalid=handle_invalid).transform(df)


def _active():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()
