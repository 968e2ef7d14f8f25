"""The given tables as review tables.

``documents`` and ``labels`` both have one row per ``doc_id``. The join is left
to Spark: it broadcasts ``labels`` while that is under
``spark.sql.autoBroadcastJoinThreshold`` and sort-merges, splitting skewed
partitions at run time, beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.config import under


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(under(sf_dir, f"{name}.parquet"))


def sentiment_of(quality: Column) -> Column:
    return F.when(quality == 1, "positive").when(quality.isNotNull(), "negative")


def labelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review_id, review, sentiment`` for every labelled document."""
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select(
            F.col("doc_id").alias("review_id"),
            F.col("text").alias("review"),
            sentiment_of(F.col("quality")).alias("sentiment"),
        )
    )


def unchecked_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it might arrive: with nulls, and with a label outside the contract.

    Unlabelled documents have no sentiment, toxic ones are labelled ``toxic``,
    and German texts are missing.
    """
    sentiment = F.when(F.col("toxic") == 1, "toxic").otherwise(sentiment_of(F.col("quality")))
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select(
            F.col("doc_id").alias("review_id"),
            F.when(F.col("lang") != "de", F.col("text")).alias("review"),
            sentiment.alias("sentiment"),
        )
    )
