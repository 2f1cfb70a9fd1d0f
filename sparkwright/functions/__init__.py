"""Column-level helpers shared by the operators (all built from Spark SQL functions)."""

from .hashing import fold_column, key_bucket, train_flag
from .joins import skew_safe_join
from .vectors import feature_names, vector_slots

__all__ = ["fold_column", "key_bucket", "train_flag", "skew_safe_join",
           "feature_names", "vector_slots"]
