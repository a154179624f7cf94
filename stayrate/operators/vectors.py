"""Sparse feature vectors out of (slot, value) entries, without a UDF."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WRAPPED = T.StructType([T.StructField("vector", VectorUDT())])


def vector_of(entries: Column, size: int, most: int | None = None) -> Column:
    """The vector of ``size`` slots with the given entries, in the smaller of its two forms.

    ``entries`` is an array of (slot int, value double) by rising slot without zeros, at most ``most`` of them;
    without ``most`` the vector is always sparse.
    The vector type's own fields are filled in and read back as a vector, so no slot that is not
    set is ever stored, however many there are.
    """
    filled = F.size(entries)
    sparse = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), entries["slot"].alias("indices"), entries["value"].alias("values")
    )
    form = F.to_json(F.struct(sparse.alias("vector")))
    if most is not None and size <= 1.5 * (most + 1):  # the rule by which pyspark.ml compresses vectors
        by_slot = F.map_from_entries(entries)
        values = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(by_slot, i), F.lit(0.0)))
        dense = F.struct(F.lit(1).cast("tinyint").alias("type"), values.alias("values"))
        form = F.when(1.5 * (filled + 1.0) < size, form).otherwise(F.to_json(F.struct(dense.alias("vector"))))
    return F.from_json(form, _WRAPPED)["vector"]


def entries_of(pairs: list[tuple[Column, Column]]) -> Column:
    """An array of (slot, value) without those whose slot is NULL or whose value is 0."""
    every = F.array(*(F.struct(slot.cast("int").alias("slot"), value.cast("double").alias("value")) for slot, value in pairs))
    return F.filter(every, lambda e: e["slot"].isNotNull() & (e["value"] != 0))
