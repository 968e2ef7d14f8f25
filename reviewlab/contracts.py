"""What a table must look like before anything is fitted on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

REVIEW_SCHEMA = StructType(
    [
        StructField("review", StringType(), nullable=False),
        StructField("sentiment", StringType(), nullable=False),
    ]
)


class ContractError(ValueError):
    """The table breaks its contract.

    ``missing`` names the columns that lack; ``violations`` is a table of all values
    outside their domain with their row counts, not collected. ``measured`` holds the
    counts of the table, where they were taken before.
    """

    def __init__(
        self, message: str, missing: Sequence[str] = (), violations: DataFrame | None = None
    ):
        super().__init__(message)
        self.missing = tuple(missing)
        self.violations = violations
        self.measured: Mapping[str, int] = {}


@dataclass(frozen=True)
class Contract:
    """Columns that must exist, and for some of them the only values they may hold."""

    required: frozenset[str]
    allowed: Mapping[str, frozenset[str]] = field(default_factory=dict)

    def check_columns(self, df: DataFrame) -> None:
        """Compare names on the driver; runs no job."""
        found = set(df.columns)
        missing = sorted(self.required - found)
        if missing:
            raise ContractError(
                f"no column {', '.join(missing)} among {', '.join(sorted(found))}", missing
            )

    def outside(self, column: str) -> Column:
        """True where ``column`` holds none of its allowed values; null counts as outside."""
        return F.col(column).isNull() | ~F.col(column).isin(sorted(self.allowed[column]))

    def domain_violations(self, df: DataFrame, column: str) -> DataFrame:
        """Each value outside the domain with its row count.

        Good rows are filtered out before the exchange and bad ones are counted
        map-side, so a clean table shuffles nothing and one frequent bad value
        becomes one row per task.
        """
        return (
            df.where(self.outside(column))
            .groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(column).alias("column_name"), "value", "row_count")
        )

    def check_domain(self, df: DataFrame, column: str) -> None:
        violations = self.domain_violations(df, column)
        total = violations.agg(F.count("*").alias("n"), F.sum("row_count").alias("rows")).first()
        if total["n"]:
            raise ContractError(
                f"{total['rows']} rows of '{column}' hold {total['n']} values other than "
                f"{', '.join(sorted(self.allowed[column]))}",
                violations=violations,
            )

    def check(self, df: DataFrame) -> None:
        """Columns first, then every domain; raises at the first that fails."""
        self.check_columns(df)
        for column in self.allowed:
            self.check_domain(df, column)


REVIEWS = Contract(
    required=frozenset({"review", "sentiment"}),
    allowed={"sentiment": frozenset({"positive", "negative"})},
)
