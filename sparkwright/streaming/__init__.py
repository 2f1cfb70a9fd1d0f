"""Scoring of streaming DataFrames with a fitted model.

The exercises are batch-only; the one streaming use of the same operators is
scoring: a fitted ``PipelineModel`` is a chain of projections, so it applies
unchanged to a ``readStream`` source.  No stateful operator is needed.
"""

from .scoring import score_stream

__all__ = ["score_stream"]
