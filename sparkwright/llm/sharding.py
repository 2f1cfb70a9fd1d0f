"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized
table (an offset and a step taken from the md5 of its name).  The shards take
turns; on its turn a shard claims the first slot of its order that is still
free.  A row's key is hashed to a slot and the slot gives the shard, so
placement is one look-up, the shards' shares differ by at most one slot, and
adding or removing a shard moves few slots besides those it must.

The table has ``table_size`` rows whatever the data's size (bounded by
``MAX_TABLE``), so it is broadcast; the rows themselves are not shuffled.

Defined results: a null key is hashed as its own value (apart from the empty
text); repeated rows and equal keys get the same shard; an empty table gives
an empty result; all columns of the input stay, except that ``shard`` and
``slot`` replace columns of these names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bound on the broadcast table (at most a few MB).
MAX_TABLE = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _number(name: str, what: str) -> int:
    return int(hashlib.md5(f"{name}|{what}".encode()).hexdigest()[:15], 16)


def preference(name: str, table_size: int) -> tuple[int, int]:
    """Offset and step of a shard's walk over all slots."""
    return _number(name, "offset") % table_size, _number(name, "step") % (table_size - 1) + 1


def lookup_table(shards: Sequence[str], table_size: int) -> list[int]:
    """For each slot the index of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not _is_prime(table_size) or not len(shards) <= table_size <= MAX_TABLE:
        raise ValueError(f"table_size must be a prime from the number of shards to {MAX_TABLE}")
    walks = [preference(s, table_size) for s in shards]
    at = [offset for offset, _ in walks]
    owner = [-1] * table_size
    for turn in range(table_size):
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + walks[i][1]) % table_size
        owner[at[i]] = i
    return owner


def slot_of(key: Column, table_size: int) -> Column:
    """Slot of a key: the first 32 bits of its text's md5, modulo the size."""
    text = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % table_size


def table_frame(spark: SparkSession, shards: Sequence[str], table_size: int) -> DataFrame:
    """The table as rows ``_slot, _shard`` (shard names)."""
    owners = ",".join(map(str, lookup_table(shards, table_size)))
    names = F.array(*[F.lit(s) for s in shards])
    slots = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("_slot", "_owner"))
    return slots.select(F.col("_slot").cast("long").alias("_slot"), F.get(names, F.col("_owner").cast("int")).alias("_shard"))


def assign_shards(df: DataFrame, key: str, shards: Sequence[str], table_size: int = 5003) -> DataFrame:
    """``df`` with ``slot`` and ``shard``, placed by column ``key``."""
    table = table_frame(df.sparkSession, shards, table_size)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    keyed = df.select(row.alias("_row"), slot_of(F.col(key), table_size).alias("_at"))
    placed = keyed.join(F.broadcast(table), F.col("_at") == F.col("_slot"))
    own = [F.col("_row").getField(c).alias(c) for c in df.columns if c not in ("slot", "shard")]
    return placed.select(*own, F.col("_slot").alias("slot"), F.col("_shard").alias("shard"))


def write_shards(df: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """Write assigned rows to one folder per shard, each shard dealt over
    ``files_per_shard`` tasks by its rows' content, so that a heavy shard is
    not one task's work."""
    deal = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(files_per_shard))
    dealt = df.withColumn("_deal", deal).repartition("shard", "_deal").drop("_deal")
    dealt.write.mode("overwrite").partitionBy("shard").parquet(path)
