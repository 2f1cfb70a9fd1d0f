"""Apply a fitted model to a stream of new rows (micro-batches, append output)."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame


def score_stream(model: Transformer, stream: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``model.transform`` on a streaming DataFrame; every fitted stage used here
    (indexer, encoder, assembler, IDF, linear and tree models) is a per-row
    projection, so the result is an append-mode stream with no state."""
    if not stream.isStreaming:
        raise ValueError("score_stream expects a streaming DataFrame (spark.readStream...)")
    scored = model.transform(stream)
    return scored.select(*keep) if keep else scored
