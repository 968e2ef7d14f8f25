"""Layers kept up to date by signed row differences.

A difference is a table with a column ``weight``: n for a row that came n times, -n for one
that went. Filters and projections take differences as they take tables. A join of two
changed tables changes by ``new left x what came right`` and ``what came left x old right``;
weights multiply. Sums and counts add weights up. Smallest and largest values can go, so the
layer keeps each value with its number: when the smallest goes, the next one is there.

A layer is plain Parquet in ``parts`` folders by a hash of the key, and a run rewrites only
the folders of keys that changed. Equal rows count as often as they occur, nulls are equal
to nulls as keys and left out of sums and extremes. A difference that takes away more than
is there leaves a negative weight, which ``negative`` finds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.scratch import stage

WEIGHT = "weight"


def weighted(df: DataFrame, weight: int = 1) -> DataFrame:
    return df.withColumn(WEIGHT, F.lit(weight).cast("long"))


def compacted(signed: DataFrame) -> DataFrame:
    """Equal rows as one; those that came as often as they went fall away."""
    columns = [c for c in signed.columns if c != WEIGHT]
    return signed.groupBy(*columns).agg(F.sum(WEIGHT).alias(WEIGHT)).where(f"{WEIGHT} <> 0").select(*columns, WEIGHT)


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """What has to be added to ``before``, signed, to get ``after``."""
    return compacted(weighted(after).unionByName(weighted(before, -1)))


def joined(left: DataFrame, left_change: DataFrame, right: DataFrame, right_change: DataFrame, on: Sequence[str]) -> DataFrame:
    """The change of an inner join on ``on``; ``left`` and ``right`` are the signed tables before."""

    def product(a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.withColumnRenamed(WEIGHT, "_a").join(b.withColumnRenamed(WEIGHT, "_b"), list(on))
        return both.withColumn(WEIGHT, F.col("_a") * F.col("_b")).drop("_a", "_b")

    return product(left.unionByName(left_change), right_change).unionByName(product(left_change, right))


def update_layer(
    spark: SparkSession, path: str, change: DataFrame, keys: Sequence[str], value: str, *, parts: int = 64
) -> list[int]:
    """Add a signed ``change`` to the layer of counted values at ``path``; the parts rewritten.

    The layer has ``keys``, ``value`` and ``weight``, partitioned by ``part``. The new rows
    are staged first, so a run that dies leaves each part as it was or as it is to be.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias("part")
    change = stage(compacted(change.select(*keys, value, WEIGHT, part)), "change")
    touched = sorted(r["part"] for r in change.select("part").distinct().collect())
    if not touched:
        return touched
    before = layer(spark, path)
    whole = change if before is None else change.unionByName(before.where(F.col("part").isin(touched)).select(change.columns))
    fresh = stage(compacted(whole), "layer")
    # A part whose last row went has to be written, too: a row of weight 0 stands for it.
    empty = change.select("part").distinct().join(fresh.select("part"), "part", "left_anti")
    filler = empty.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("part", WEIGHT) else (
            F.col("part") if f.name == "part" else F.lit(0).cast("long").alias(WEIGHT)) for f in fresh.schema]
    )
    fresh.unionByName(filler).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    return touched


def layer(spark: SparkSession, path: str) -> DataFrame | None:
    """The counted values at ``path``; None if nothing was stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def summary(counted: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``row_count, total, least, largest`` per key, from counted values."""
    return (
        counted.where(f"{WEIGHT} <> 0")
        .groupBy(*keys)
        .agg(
            F.sum(WEIGHT).alias("row_count"),
            F.sum(F.col(value) * F.col(WEIGHT)).alias("total"),
            F.min(value).alias("least"),
            F.max(value).alias("largest"),
        )
    )


def negative(counted: DataFrame) -> DataFrame:
    """Rows of which more went than came."""
    return counted.where(f"{WEIGHT} < 0")
