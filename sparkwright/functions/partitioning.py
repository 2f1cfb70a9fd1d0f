"""Persistence policy for inputs that are scanned many times.

Model fits (and cross-validation folds) make several passes over their input.
It is persisted MEMORY_AND_DISK: it spills instead of failing, and lost blocks
are recomputed from the scan-and-project lineage when an executor goes away.
The partition count is the reader's (or AQE's); where that is too coarse for many
passes (a Parquet row group is one task, however many rows it has) ``spread``
deals the rows out first.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

#: Rows of a partition at most, after ``spread``.
SPREAD_ROWS = 250_000


def spread(df: DataFrame, n_rows: int) -> DataFrame:
    """``df``, of about ``n_rows`` rows, dealt out evenly over all cores and in
    parts of ``SPREAD_ROWS`` at most.  Fewer rows than that stay as they are."""
    if n_rows <= SPREAD_ROWS:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // SPREAD_ROWS)))


@contextmanager
def persisted(df: DataFrame):
    """``with persisted(train) as t: model = est.fit(t)``; released afterwards."""
    frame = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frame
    finally:
        frame.unpersist()
