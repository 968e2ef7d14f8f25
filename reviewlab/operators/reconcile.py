"""Two reports of one flow, matched line by line.

Both have ``id``, keys, a ``day`` and an ``amount``. Lines match if their keys are equal,
their days at most ``days`` apart and their amounts at most ``share`` of the larger one.
Each line gets one partner at most: the pair with the smallest residual first, then the
next among lines still free, ties to smaller ids. Rounds of mutual best choices give
exactly that, all keys at once: a pair that is the best for both its lines can't be
outdone by another one.

The band join is an equi-join on keys and a bucket of days, some times as wide as the band; a
line of one side looks into the buckets that its band touches, mostly one. Lines without a key, day or amount
are matched with nothing. Ids are unique in each report.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.scratch import discard, stage

# Bands in a bucket: with more, fewer lines look into two, and more pairs are tried.
BANDS = 4


def candidates(left: DataFrame, right: DataFrame, keys: Sequence[str], *, days: int, share: float) -> DataFrame:
    """``left_id, right_id, day_gap, amount_gap, residual`` of all pairs within the tolerance."""

    def side(df: DataFrame, name: str) -> DataFrame:
        number = F.datediff("day", F.lit("1970-01-01").cast("date"))
        return df.select(
            *keys, F.col("id").alias(f"{name}_id"), number.alias(f"{name}_day"), F.col("amount").alias(f"{name}_amount")
        )

    width = days + 1
    first, last = (F.floor((F.col("left_day") + gap) / (BANDS * width)) for gap in (-days, days))
    ours = side(left, "left").withColumn("bucket", F.explode(F.sequence(first, last)))
    theirs = side(right, "right").withColumn("bucket", F.floor(F.col("right_day") / (BANDS * width)))
    day_gap = F.col("right_day") - F.col("left_day")
    amount_gap = F.col("right_amount") - F.col("left_amount")
    largest = F.greatest(F.abs("left_amount"), F.abs("right_amount"))
    # Both parts of the residual in shares of their tolerance.
    residual = F.abs("day_gap") / F.lit(float(width)) + F.when(
        F.col("largest") > 0, F.abs("amount_gap") / (F.col("largest") * F.lit(share))
    ).otherwise(0.0)
    return (
        ours.join(theirs, [*keys, "bucket"])
        .select("left_id", "right_id", day_gap.alias("day_gap"), amount_gap.alias("amount_gap"), largest.alias("largest"))
        .where((F.abs("day_gap") <= days) & (F.abs("amount_gap") <= F.col("largest") * F.lit(share)))
        .select("left_id", "right_id", F.col("day_gap").cast("int").alias("day_gap"), "amount_gap", F.round(residual, 9).alias("residual"))
    )


def assigned(pairs: DataFrame) -> DataFrame:
    """The pairs that are matched, one to one."""
    best = F.struct("residual", "left_id", "right_id")
    every = free = stage(pairs, "pairs")
    rounds = []
    while not free.isEmpty():
        # Summed up before the exchange, so a line with very many partners is a row per task.
        by_left = free.groupBy("left_id").agg(F.min(best).alias("left_best"))
        by_right = free.groupBy("right_id").agg(F.min(best).alias("right_best"))
        mutual = by_left.join(by_right, F.col("left_best") == F.col("right_best")).select(
            F.col("left_best.left_id").alias("left_id"), F.col("left_best.right_id").alias("right_id")
        )
        mutual = stage(mutual, "mutual")
        rounds.append(mutual)
        rest = free.join(mutual.select("left_id"), "left_id", "left_anti")
        rest = stage(rest.join(mutual.select("right_id"), "right_id", "left_anti"), "pairs")
        if free is not every:
            discard(free)
        free = rest
    if not rounds:
        return every
    # What was chosen in any round gets its gaps once, at the end.
    found = stage(reduce(DataFrame.unionByName, rounds).join(every, ["left_id", "right_id"]), "matched")
    discard(every, free, *rounds)
    return found


def reconciled(left: DataFrame, right: DataFrame, keys: Sequence[str], *, days: int, share: float) -> DataFrame:
    """``left_id, right_id, status, day_gap, amount_gap, residual``: every line of both reports.

    ``status`` is ``exact`` (no gaps), ``within`` the tolerance, ``left_only`` or ``right_only``.
    """
    pairs = assigned(candidates(left, right, keys, days=days, share=share))
    exact = (F.col("day_gap") == 0) & (F.col("amount_gap") == 0)
    matched = pairs.select(
        "left_id", "right_id", F.when(exact, "exact").otherwise("within").alias("status"), "day_gap", "amount_gap", "residual"
    )

    def alone(df: DataFrame, name: str) -> DataFrame:
        own = df.select(F.col("id").alias(f"{name}_id")).join(pairs.select(f"{name}_id"), f"{name}_id", "left_anti")
        columns = {f.name: F.lit(None).cast(f.dataType) for f in matched.schema}
        columns |= {f"{name}_id": F.col(f"{name}_id"), "status": F.lit(f"{name}_only")}
        return own.select(*[c.alias(n) for n, c in columns.items()])

    told = matched.unionByName(alone(left, "left")).unionByName(alone(right, "right"))
    # For callers that store the result and then ``discard`` what it was made from.
    told.made_from = (pairs,)
    return told
