"""Slowly changing dimensions: what was known of a key, and when.

A change says what holds for a key from a moment on: ``key, at, order, removed`` and
attributes. A history has a row per key and stretch of time in which nothing changed:
``key, valid_from, valid_to`` (exclusive, null: still) and the attributes.

Changes may come in any order, late, and more than once: only moments count. Of several for
one key and moment the one with the largest ``order`` holds; of those with the same, the
largest attributes. A change that changes nothing makes no row, and after ``removed`` the
key has no row until it comes back. Changes without a key or moment are left out.

Each key is one window, sorted by moment, so a key with very many changes is sorted in one
task, on disk if need be; no key is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(changes: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """The history that ``changes`` (``key, at, order, removed``, attributes) tell."""
    state = F.struct(*attributes).alias("state")
    told = (
        changes.where(F.col(key).isNotNull() & F.col("at").isNotNull())
        .select(key, "at", F.struct("order", F.coalesce("removed", F.lit(False)).alias("gone"), state).alias("told"))
        .groupBy(key, "at")
        .agg(F.max("told").alias("told"))
        .select(key, "at", "told.gone", "told.state")
    )
    path = Window.partitionBy(key).orderBy("at")
    before = F.struct("gone", "state")
    known = told.withColumn("before", F.lag(before).over(path))
    # A key that was not there before and is removed again tells nothing either.
    new = F.when(F.col("before").isNull() | F.col("before.gone"), ~F.col("gone")).otherwise(
        F.col("gone") | ~F.col("before.state").eqNullSafe(F.col("state"))
    )
    turns = known.where(new).withColumn("valid_to", F.lead("at").over(path))
    return turns.where(~F.col("gone")).select(key, F.col("at").alias("valid_from"), "valid_to", "state.*")


def changes_of(history: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """The changes that tell ``history``; they rank before any other of the same moment."""
    first = F.lit(None).cast("long").alias("order")
    opened = history.select(key, F.col("valid_from").alias("at"), first, F.lit(False).alias("removed"), *attributes)
    empty = [F.lit(None).cast(history.schema[c].dataType).alias(c) for c in attributes]
    closed = history.where("valid_to is not null").select(
        key, F.col("valid_to").alias("at"), first, F.lit(True).alias("removed"), *empty
    )
    # Where one stretch ends as the next begins, the next one holds.
    begins = history.select(key, F.col("valid_from").alias("at"))
    return opened.unionByName(closed.join(begins, [key, "at"], "left_anti"))


def applied(history: DataFrame, changes: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """``history`` with more changes, which may lie before what it has.

    Only keys with changes are taken apart; the stretches of all others stay as they are.
    A change of a moment that the history has holds in its place. A history does not keep
    changes that only confirmed what was known, so a late change before one of those holds
    until the next different one; where that matters, keep the changes and use ``intervals``.
    """
    touched = changes.select(key).where(F.col(key).isNotNull()).distinct()
    same = history.join(touched, key, "left_anti")
    old = changes_of(history.join(touched, key, "left_semi"), key, attributes)
    new = changes.select(key, "at", F.coalesce("order", F.lit(0)).cast("long").alias("order"), "removed", *attributes)
    told = intervals(old.unionByName(new), key, attributes)
    return same.select(told.columns).unionByName(told)


def split(history: DataFrame, cuts: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """``history`` with keys that became others: ``cuts`` are ``key, at, into``, a row per heir.

    The old key ends at that moment; each heir starts there with what the old key was then
    and takes over what was already known for later. Cuts of keys that the history does not
    have then change nothing.
    """
    heirs = cuts.select(F.col(key).alias("old"), F.col("at").alias("cut"), "into").distinct()
    parted = history.join(heirs, history[key] == heirs["old"])
    later = F.col("valid_to").isNull() | (F.col("valid_to") > F.col("cut"))
    handed = parted.where(later).select(
        F.col("into").cast(history.schema[key].dataType).alias(key),
        F.greatest("valid_from", "cut").alias("valid_from"),
        "valid_to",
        *attributes,
    )
    ends = heirs.groupBy(F.col("old").alias(key)).agg(F.min("cut").alias("cut"))
    stays = history.join(ends, key, "left").where("cut is null or valid_from < cut")
    end = F.least(F.coalesce("valid_to", "cut"), F.coalesce("cut", "valid_to"))
    return stays.select(key, "valid_from", end.alias("valid_to"), *attributes).unionByName(handed)


def as_of(facts: DataFrame, history: DataFrame, key: str | Column, at: str, history_key: str) -> DataFrame:
    """``facts`` with the attributes that held for their key at their moment; null if none did.

    An equi-join on the key, so Spark splits keys with very many facts.
    """
    fact_key = F.col(key) if isinstance(key, str) else key
    then = history.select(
        F.col(history_key).alias("_key"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *[c for c in history.columns if c not in (history_key, "valid_from", "valid_to")],
    )
    held = (F.col("_from") <= F.col(at)) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    return facts.join(then, (fact_key == F.col("_key")) & held, "left").drop("_key", "_from", "_to")
