"""Text classification on Spark: audited input, three feature sets, compared models."""

__all__ = ["config", "contracts", "functions", "operators", "plans", "scratch", "sinks", "sources"]
