"""Deterministic key-hash splits and folds.

``DataFrame.randomSplit`` depends on partitioning (the same rows split
differently when read into a different number of partitions), so splits and
cross-validation folds here are a pure function of a row key: the first 32 bits
of ``md5(key || '|' || salt)``.  This is codegen'd JVM-side, needs no shuffle,
and is reproducible in plain SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(key: str | Column, salt: str | int) -> Column:
    """Unsigned 32-bit integer from md5 of the key and a salt (as bigint)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f"|{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def key_bucket(key: str | Column, salt: str | int, modulus: int) -> Column:
    return key_hash(key, salt) % F.lit(modulus)


def split_point(fraction: float) -> int:
    """First hash value that is not in the training share."""
    if not 0 <= fraction <= 1:
        raise ValueError("a fraction from 0 to 1 is expected")
    return round(fraction * (1 << 32))


def train_flag(key: str | Column, train_fraction: float = 0.8, seed: int = 17) -> Column:
    """True for the training share: the 32-bit hash below that share of 2^32."""
    return key_hash(key, seed) < F.lit(split_point(train_fraction)).cast("bigint")


def fold_column(key: str | Column, num_folds: int, seed: str | int = "fold") -> Column:
    """Fold id 0..k-1 as an int, for ``CrossValidator(foldCol=...)``."""
    return key_bucket(key, seed, num_folds).cast("int")
