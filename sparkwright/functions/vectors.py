"""ML vectors as plain columns.

Vector columns cannot be compared outside Spark, so results expose them as
slots (``vector_to_array`` is a JVM function) and name slots from the ML
attribute metadata that the assembler writes.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_slots(col: str, width: int, prefix: str | None = None) -> list[Column]:
    arr = vector_to_array(F.col(col))
    name = prefix or col
    return [arr[i].alias(f"{name}_{i}") for i in range(width)]


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Slot names from ``ml_attr`` metadata, in slot order (``slot_i`` when absent)."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    width = meta.get("num_attrs", 0)
    names = [f"slot_{i}" for i in range(width)]
    for group in meta.get("attrs", {}).values():
        for attr in group:
            names[attr["idx"]] = attr.get("name", names[attr["idx"]])
    return names


def sparse_slots(col: str, slot: str = "slot", value: str = "value") -> Column:
    """The stored slots of a vector as ``array<struct<slot, value>>``, without
    widening a sparse vector."""
    v = F.unwrap_udt(F.col(col))
    at = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    return F.transform(at, lambda i, k: F.struct(i.alias(slot), F.get(v["values"], k).alias(value)))


def one_hot_slot(col: str) -> Column:
    """Index of the single set slot of a one-hot vector; null for the dropped level."""
    return F.get(F.filter(sparse_slots(col), lambda s: s["value"] > 0), F.lit(0))["slot"]


def vector_width(col: str) -> Column:
    v = F.unwrap_udt(F.col(col))
    return F.coalesce(v["size"], F.size(v["values"])).cast("int")
