"""Equi-joins that hold up under a hot key.

With adaptive execution on, a plain join is planned: Spark measures each
side's shuffled bytes and only then broadcasts (below
``spark.sql.adaptive.autoBroadcastJoinThreshold``), and splits the skewed
partitions of a sort-merge join, so a hot key does not land on one task.  With
adaptive execution off, the join is salted when asked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def adaptive_on(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return (conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
            and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true")


def skew_safe_join(big: DataFrame, small: DataFrame, on: str, how: str = "inner", salts: int = 32) -> DataFrame:
    """Join by measured size, skew split at run time; salted over ``salts``
    tasks per key where Spark cannot do that."""
    if adaptive_on(big) or how not in ("inner", "left", "left_outer"):
        return big.join(small, on=on, how=how)
    return salted_join(big, small, on=on, salts=salts, how=how)


def salted_join(big: DataFrame, small: DataFrame, on: str, salts: int = 32,
                how: str = "inner") -> DataFrame:
    """Equi-join that splits every key of ``big`` over ``salts`` tasks.

    ``small`` is replicated once per salt; ``big`` rows pick a salt from a hash
    of all their columns, so a key holding a third of the rows is spread over
    ``salts`` reducers instead of one.  Exact: every pair is produced once.
    """
    salt = F.col("__salt")
    big_s = big.withColumn("__salt", F.abs(F.xxhash64(*big.columns)) % F.lit(salts))
    small_s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big_s.join(small_s, on=[on, "__salt"], how=how).drop(salt)
