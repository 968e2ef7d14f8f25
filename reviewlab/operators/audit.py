"""Counts about a table, all from one pass.

Every count is an aggregate of the same row, so the table is read once and the
only thing exchanged is one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

AUDIT_SCHEMA = StructType(
    [
        StructField("run_id", StringType()),
        StructField("event", StringType()),
        StructField("subject", StringType()),
        StructField("value", DoubleType()),
    ]
)


def complete(columns: Sequence[str]) -> Column:
    """True where none of the columns is null."""
    return reduce(and_, (F.col(c).isNotNull() for c in columns), F.lit(True))


def counts(
    columns: Sequence[str],
    domains: Mapping[str, Sequence[str]] | None = None,
    *,
    fitted_on: Column | None = None,
) -> dict[str, Column]:
    """The aggregates, by name: rows, complete rows, nulls per column, rows per class.

    Names are ``rows``, ``complete``, ``nulls.<column>``, ``other.<column>`` for
    values outside the domain, and ``class.<column>.<value>``. Classes are counted
    over complete rows, as those are what remains; ``fitted_on`` narrows this to
    the rows an index is fitted on.
    """
    whole = complete(columns)
    counted = whole if fitted_on is None else whole & fitted_on
    named = {"rows": F.count(F.lit(1)), "complete": F.count_if(whole)}
    for c in columns:
        named[f"nulls.{c}"] = F.count_if(F.col(c).isNull())
    for c, values in (domains or {}).items():
        named[f"other.{c}"] = F.count_if(~F.col(c).isin(*values))
        for v in values:
            named[f"class.{c}.{v}"] = F.count_if(counted & (F.col(c) == v))
    return named


def one_row(df: DataFrame, named: Mapping[str, Column]) -> DataFrame:
    """All aggregates of ``df`` in a single row."""
    return df.agg(*(agg.alias(name) for name, agg in named.items()))


def null_report(df: DataFrame) -> DataFrame:
    """``column_name, null_count, null_pct`` for columns that hold nulls; empty for no rows."""
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(
            *(
                F.struct(F.lit(c).alias("name"), F.count_if(F.col(c).isNull()).alias("nulls"))
                for c in df.columns
            )
        ).alias("per_column"),
    )
    return (
        wide.select("rows", F.inline("per_column"))
        .where(F.col("nulls") > 0)
        .select(
            F.col("name").alias("column_name"),
            F.col("nulls").alias("null_count"),
            (F.col("nulls") / F.col("rows") * 100).alias("null_pct"),
        )
    )


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in which nothing is null. Without nulls this changes nothing, so no test comes first."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def row_counts(df: DataFrame) -> DataFrame:
    """Rows before and after ``drop_nulls``."""
    return one_row(
        df,
        {
            "rows_before": F.count(F.lit(1)),
            "rows_after": F.count_if(complete(df.columns)),
            "rows_dropped": F.count_if(~complete(df.columns)),
        },
    )


def class_balance(df: DataFrame, column: str = "sentiment") -> DataFrame:
    """Rows per class. Counted map-side: one row per class and task is exchanged."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def audit_rows(df: DataFrame, named: Mapping[str, Column], run_id: str) -> DataFrame:
    """The aggregates as audit records: one row each, carrying the run id.

    ``class.sentiment.positive`` becomes event ``class``, subject
    ``sentiment.positive``.
    """
    cells = F.array(
        *(
            F.struct(
                F.lit(name.partition(".")[0]).alias("event"),
                F.lit(name.partition(".")[2]).alias("subject"),
                agg.cast("double").alias("value"),
            )
            for name, agg in named.items()
        )
    )
    return (
        df.agg(cells.alias("cells"))
        .select(F.inline("cells"))
        .select(F.lit(run_id).alias("run_id"), "event", "subject", "value")
    )


def audit_of(spark: SparkSession, measured: Mapping[str, float], run_id: str) -> DataFrame:
    """Audit records from numbers already measured, as a run collects them."""
    rows = [
        (run_id, *(name.partition(".")[::2]), float(value)) for name, value in measured.items()
    ]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Audit records of all runs; the schema is given, so no inference pass."""
    return spark.read.schema(AUDIT_SCHEMA).json(path)
