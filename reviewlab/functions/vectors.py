"""Vector columns as ordinary rows, one per coordinate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DENSE = 1  # value of a vector's "type" field


def nonzeros(vector: str | Column) -> Column:
    """Number of stored coordinates that are not zero."""
    return F.size(F.filter(F.unwrap_udt(vector)["values"], lambda v: v != 0.0))


def dimensions(vector: str | Column) -> Column:
    """Length of the vector, dense or sparse."""
    raw = F.unwrap_udt(vector)
    return F.when(raw["type"] == DENSE, F.size(raw["values"])).otherwise(raw["size"])


def to_rows(
    df: DataFrame,
    keys: Sequence[str],
    vector: str,
    *,
    index: str = "dim",
    value: str = "value",
) -> DataFrame:
    """One row per stored coordinate; a sparse vector is never filled up with zeros."""
    raw = F.unwrap_udt(vector)
    last = F.size(raw["values"]) - 1
    places = F.when(raw["type"] != DENSE, raw["indices"]).otherwise(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    )
    zipped = F.arrays_zip(places.alias("place"), raw["values"].alias("stored"))
    exploded = df.select(*keys, F.explode(zipped).alias("cell"))
    return exploded.select(
        *keys,
        F.col("cell.place").cast("bigint").alias(index),
        F.col("cell.stored").alias(value),
    )
