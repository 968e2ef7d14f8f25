"""Scoring of rows that arrive as files, each row once.

A run takes the files that came since the last one, in batches, and ends; the checkpoint
knows what was taken. Rows are written below ``batch_id=N`` of the sink, and a batch that
is run again, because a run died before it was committed, overwrites its own folder and
nothing else. Rows delivered again, in whatever file, are known by their key until the
watermark has passed them: later than ``late`` they count as too late and are dropped.

A stored table per batch is all the sink needs; readers see a batch when it is whole, as
Spark's writer puts files in place at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlab.config import under

Write = Callable[[DataFrame, int], None]


def arriving(spark: SparkSession, path: str, schema: StructType, *, files_per_batch: int = 100) -> DataFrame:
    """The Parquet files below ``path``, as they come."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("recursiveFileLookup", True).parquet(path)


def once(rows: DataFrame, key: str, at: str, *, late: str) -> DataFrame:
    """Each key once; ``at`` is when a row happened, ``late`` how long it may take to come."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def batch_writer(sink: str) -> Write:
    """Writes a batch to a folder of its own, the same one whenever it is run."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(under(sink, f"batch_id={batch_id}"))

    return write


def run_available(rows: DataFrame, write: Write, checkpoint: str, *, mode: str = "append") -> None:
    """One run over what is there; returns when it is written."""
    query = (
        rows.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def score_available(
    spark: SparkSession,
    source: str,
    schema: StructType,
    model: Transformer,
    sink: str,
    checkpoint: str,
    *,
    key: str,
    at: str,
    late: str,
    files_per_batch: int = 100,
    write: Write | None = None,
) -> None:
    """Score what came since the last run with a stored model."""
    rows = once(arriving(spark, source, schema, files_per_batch=files_per_batch), key, at, late=late)
    run_available(model.transform(rows), write or batch_writer(sink), checkpoint)


def count_available(
    spark: SparkSession,
    source: str,
    schema: StructType,
    sink: str,
    checkpoint: str,
    *,
    at: str,
    by: str,
    value: str,
    width: str,
    late: str,
    files_per_batch: int = 100,
) -> None:
    """Rows, and sums of ``value``, per window of time and ``by``; batches write what changed."""
    rows = arriving(spark, source, schema, files_per_batch=files_per_batch).withWatermark(at, late)
    counts = rows.groupBy(F.window(at, width).alias("w"), by).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col(value).cast("decimal(18,4)")).alias("total")
    )
    counts = counts.select(F.col("w.start").alias("window_start"), by, "row_count", "total")
    run_available(counts, batch_writer(sink), checkpoint, mode="update")


def latest(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """Of what several batches wrote for the same keys, what the last one wrote."""
    stored = spark.read.parquet(sink)
    others = [c for c in stored.columns if c not in (*keys, "batch_id")]
    last = stored.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("last"))
    return last.select(*keys, "last.*")
