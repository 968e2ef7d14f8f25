"""Declared rules on the quality of tables, judged together.

Rules are plain values; a table's rules become one aggregate over it, each unique key one
count by key, and each foreign key one join of its distinct values. ``verdicts`` has one row per rule:
``rule, checked, failed, passed``. ``quarantined`` has the rows that break a rule on rows,
with the names of the rules they break.

Nulls: a condition that is null counts as failed, so say ``x is null or ...`` to allow
them; a range, a foreign key and a unique key pass over nulls (``NotNull`` finds them). A unique key
counts each row of a value that occurs more than once. Empty tables: nothing is checked and
nothing fails, but ``Fresh`` and ``Share`` fail, as there is nothing to be fresh.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERDICT = ("rule", "checked", "failed", "passed")


@dataclass(frozen=True)
class Condition:
    """Every row satisfies an expression of SQL."""

    name: str
    expression: str

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.expression), F.lit(False))


@dataclass(frozen=True)
class NotNull:
    name: str
    column: str

    def holds(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class Range:
    """Every value lies from ``least`` to ``most``; an end that is None is open."""

    name: str
    column: str
    least: object = None
    most: object = None

    def holds(self) -> Column:
        value = F.col(self.column)
        ends = [value >= F.lit(self.least)] * (self.least is not None) + [value <= F.lit(self.most)] * (self.most is not None)
        return reduce(Column.__and__, ends, F.lit(True)) | value.isNull()


@dataclass(frozen=True)
class Share:
    """At least ``least`` of all rows satisfy an expression; the others are no failure of a row."""

    name: str
    expression: str
    least: float


@dataclass(frozen=True)
class Fresh:
    """The latest value of ``column`` is at or after ``since``."""

    name: str
    column: str
    since: object


@dataclass(frozen=True)
class Unique:
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    """Every value of ``columns`` is one of ``other_columns`` of the table ``other``."""

    name: str
    columns: tuple[str, ...]
    other: str
    other_columns: tuple[str, ...]


ON_ROWS = (Condition, NotNull, Range)
Rule = Condition | NotNull | Range | Share | Fresh | Unique | ForeignKey


def verdicts(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """All rules, by the name of their table."""
    names = [rule.name for each in rules.values() for rule in each]
    if len(set(names)) != len(names) or not names:
        raise ValueError("rules need names, each its own")
    parts = []
    for table, each in rules.items():
        df = tables[table]
        whole = [r for r in each if not isinstance(r, Unique | ForeignKey)]
        if whole:
            parts.append(_of_one_pass(df, whole))
        parts += [_unique(df, r) for r in each if isinstance(r, Unique)]
        parts += [_foreign(df, tables[r.other], r) for r in each if isinstance(r, ForeignKey)]
    return reduce(DataFrame.unionByName, parts)


def _of_one_pass(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One aggregate for all rules that need no other row than their own, or only the latest."""
    judged = [_judged(rule) for rule in rules]
    counts = [c.alias(f"{what}{i}") for i, both in enumerate(judged) for what, c in zip(("checked", "failed"), both)]
    rows = [
        F.struct(F.lit(r.name).alias("rule"), F.col(f"checked{i}").alias("checked"), F.col(f"failed{i}").alias("failed"))
        for i, r in enumerate(rules)
    ]
    return _passed(df.agg(*counts).select(F.inline(F.array(*rows))))


def _judged(rule: Rule) -> tuple[Column, Column]:
    """How many are checked and how many fail."""
    all_rows = F.count(F.lit(1))
    if isinstance(rule, Fresh):
        latest = F.max(rule.column) >= F.lit(rule.since)
        return all_rows, F.when(latest, 0).otherwise(1).cast("long")
    if isinstance(rule, Share):
        held = F.count_if(F.coalesce(F.expr(rule.expression), F.lit(False)))
        # As decimals, so that 0.1 of 30 rows are 3.
        least = F.lit(Decimal(str(rule.least)))
        enough = (all_rows > 0) & (held.cast("decimal(20,0)") >= least * all_rows.cast("decimal(20,0)"))
        return all_rows, F.when(enough, 0).otherwise(F.greatest(all_rows - held, F.lit(1))).cast("long")
    return all_rows, F.count_if(~rule.holds())


def _passed(counted: DataFrame) -> DataFrame:
    return counted.withColumn("passed", F.col("failed") == 0).select(*VERDICT)


def _keys(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    keys = df.select(*[F.col(c).alias(n) for c, n in zip(columns, names)])
    return keys.where(reduce(Column.__and__, [F.col(n).isNotNull() for n in names]))


def _unique(df: DataFrame, rule: Unique) -> DataFrame:
    names = [f"k{i}" for i in range(len(rule.columns))]
    counted = _keys(df, rule.columns, names).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    return _passed(
        counted.agg(
            F.lit(rule.name).alias("rule"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed"),
        )
    )


def _foreign(df: DataFrame, other: DataFrame, rule: ForeignKey) -> DataFrame:
    """Keys are counted before they are joined, so a frequent key is one row."""
    names = [f"k{i}" for i in range(len(rule.columns))]
    counted = _keys(df, rule.columns, names).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    known = _keys(other, rule.other_columns, names).distinct().withColumn("known", F.lit(True))
    return _passed(
        counted.join(known, names, "left").agg(
            F.lit(rule.name).alias("rule"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("failed"),
        )
    )


def quarantined(df: DataFrame, rules: Sequence[Rule], into: str = "broken") -> DataFrame:
    """Rows that break a rule on rows, with the names of those rules; read where they lie."""
    broken = [F.when(~r.holds(), F.lit(r.name)) for r in rules if isinstance(r, ON_ROWS)]
    found = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn(into, found).where(F.size(into) > 0)
