"""Whether one classifier is better than another, or only looks so on these rows.

Both have judged the same test rows. ``compared`` gives each accuracy and their difference with an
interval from the bootstrap, and a paired test of the difference.

The bootstrap draws no rows: in each replicate a row counts as often as a Poisson number of mean 1 says that is
made from a hash of its key and the replicate. So all replicates are sums in one
aggregate, one row of each task and replicate is exchanged, and the result is the same on any
layout, after any lost executor, and in any engine that has MD5.

Interval: the replicates' values at ranks ``floor(tail * n) + 1`` from below and from above.
``opposite`` is the share of replicates in which the difference is not of the sign that was seen
(a difference of 0 is opposite). ``mcnemar`` is the square statistic of the rows on which just one is right, with
correction; null if there are none. Values over 3.84 occur by chance once in 20 times.

A null judgement counts as wrong. Rows of one key are drawn together, as copies should be; a
null key is one key. Without rows all numbers are null but the counts.
"""

from __future__ import annotations

from itertools import accumulate
from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.functions.keys import DEFAULT_SEED

# Hash values of 32 bits, four in a digest of MD5.
LANES, VALUES = 4, 2**32
# A count of more than 12 has a chance of 1e-10, below one hash value.
MOST = 12


def thresholds() -> list[int]:
    """A hash value counts once for each of these that it reaches."""
    return [round(VALUES * p) for p in accumulate(exp(-1) / factorial(k) for k in range(MOST))]


def _values(key: Column, replicates: int, seed: int) -> Column:
    """An array of ``replicate, value``, one digest for each LANES of them."""

    def digest(block: Column) -> Column:
        told = F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))
        return F.struct((block * LANES).alias("first"), told.alias("told"))

    def lanes(d: Column) -> Column:
        def one(lane: Column) -> Column:
            value = F.conv(F.substring(d["told"], lane * 8 + 1, F.lit(8)), 16, 10).cast("long")
            return F.struct((d["first"] + lane).alias("replicate"), value.alias("value"))

        return F.transform(F.array(*map(F.lit, range(LANES))), one)

    blocks = F.sequence(F.lit(0), F.lit((replicates - 1) // LANES))
    return F.flatten(F.transform(F.transform(blocks, digest), lanes))


def replicated(judged: DataFrame, key: str, first: str, second: str, *, replicates: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """``replicate, n, first, second, only_first, only_second``: rows drawn, and how many of them each, or just one, got right.

    Replicate -1 is the rows as they are.
    """
    a, b = (F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in (first, second))
    counts = {"first": a, "second": b, "only_first": a & ~b, "only_second": b & ~a}
    # Rows of one key are drawn together, so a digest is taken once for each key.
    rows = judged.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(holds).alias(name) for name, holds in counts.items()]
    )
    itself = F.struct(F.lit(-1).alias("replicate"), F.lit(None).cast("long").alias("value"))
    drawn = rows.select("n", *counts, F.explode(F.concat(F.array(itself), _values(F.col("key"), replicates, seed))).alias("d"))
    reached = sum(((F.col("d.value") >= t).cast("int") for t in thresholds()), F.lit(0))
    times = F.when(F.col("d.replicate") < 0, 1).otherwise(reached)
    weighted = drawn.where(F.col("d.replicate") < replicates).select("n", *counts, F.col("d.replicate").alias("replicate"), times.alias("times"))
    return weighted.groupBy("replicate").agg(*[F.sum(F.col(c) * F.col("times")).alias(c) for c in ("n", *counts)])


def compared(
    judged: DataFrame,
    key: str,
    first: str,
    second: str,
    *,
    replicates: int = 1000,
    percent: int = 95,
    seed: int = DEFAULT_SEED,
    places: int | None = None,
) -> DataFrame:
    """``measure, value, low, high, opposite, mcnemar, row_count`` for the first, the second and their difference.

    ``first`` and ``second`` are columns that say whether each was right. Accuracies are in
    percent; a replicate that draws no row is left out.
    """
    drawn = replicated(judged, key, first, second, replicates=replicates, seed=seed)
    percents = {name: F.col(c) * 100 / F.col("n") for name, c in ((first, "first"), (second, "second"))}
    percents["difference"] = (F.col("first") - F.col("second")) * 100 / F.col("n")
    itself, n_only = F.col("replicate") < 0, F.col("only_first") + F.col("only_second")
    gap = F.greatest(F.abs(F.col("only_first") - F.col("only_second")) - 1, F.lit(0))
    measures = [F.struct(F.lit(name).alias("measure"), value.alias("value")) for name, value in percents.items()]
    told = drawn.where("n > 0").select(
        itself.alias("itself"), "n", F.when(n_only > 0, gap * gap / n_only).alias("mcnemar"), F.explode(F.array(*measures)).alias("m")
    )

    def seen(name: str) -> Column:
        return F.max(F.when(F.col("itself"), F.col(name)))

    # As many values as there are replicates, whatever the rows.
    every = told.groupBy("m.measure").agg(
        seen("m.value").alias("value"),
        F.sort_array(F.collect_list(F.when(~F.col("itself"), F.col("m.value")))).alias("v"),
        seen("mcnemar").alias("mcnemar"),
        seen("n").alias("row_count"),
    )
    names = F.array(*map(F.lit, percents))
    asked = judged.sparkSession.range(1).select(F.explode(names).alias("measure"))
    from_below = F.floor(F.size("v") * (100 - percent) / 200).cast("int")
    opposite = F.size(F.filter("v", lambda d: d * F.sign("value") <= 0)) / F.nullif(F.size("v"), F.lit(0))
    is_gap = F.col("measure") == "difference"
    numbers = {
        "value": F.col("value"),
        "low": F.get("v", from_below),
        "high": F.get("v", F.size("v") - 1 - from_below),
        "opposite": F.when(is_gap, opposite),
        "mcnemar": F.when(is_gap, F.col("mcnemar")),
    }
    shown = [(c if places is None else F.round(c, places)).alias(name) for name, c in numbers.items()]
    return asked.join(every, "measure", "left").select("measure", *shown, F.coalesce("row_count", F.lit(0)).alias("row_count"))
