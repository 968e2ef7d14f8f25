"""Sharding by a two-pass external shuffle.

Pass 1 scatters records over buckets of about ``bucket_bytes`` by a seeded hash of the
record's place in the input, so no value, group or copy can make a bucket large. Pass 2
puts each bucket into a Fisher-Yates order in the memory of one task and writes it. The
buckets, one after the other, are the shuffled corpus; dealing them out in turn gives
shards whose row counts differ by one at most.

The same files and seed give the same shards, also when tasks are run again. The input
should be a table that is read from files, as a record's place counts. Null texts,
equal rows and extra columns of any name are kept as they are; an empty table has no
buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from reviewlab.scratch import stage

BUCKET_BYTES = 32 << 20
# Rows of one bucket block, so that running totals of bucket sizes need no large task.
BLOCK = 1024


def bucket_count(docs: DataFrame, text: str, bucket_bytes: int) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col(text)) + 64)).first()[0] or 0
    return max(1, -(-size // bucket_bytes))


def shuffled(
    docs: DataFrame, *, text: str = "text", seed: int = 0, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """A written table of ``bucket``, ``place`` and ``record`` (all columns of ``docs``)."""
    buckets = bucket_count(docs, text, bucket_bytes)
    record = StructField("record", docs.schema)
    scattered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        F.monotonically_increasing_id().alias("origin"),
    ).select(
        F.pmod(F.xxhash64(F.lit(seed), "origin"), F.lit(buckets)).cast("int").alias("bucket"),
        "origin",
        "record",
    )

    def fisher_yates(table: pa.Table) -> pa.Table:
        table = table.sort_by("origin")
        bucket = table.column("bucket")[0].as_py() if len(table) else 0
        order = np.arange(len(table))
        np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
        place = pa.array(np.arange(len(table)), pa.int32())
        table = table.take(pa.array(order))
        return pa.table(
            [table.column("bucket"), place, table.column("record")], ["bucket", "place", "record"]
        )

    schema = StructType(
        [StructField("bucket", IntegerType()), StructField("place", IntegerType()), record]
    )
    return stage(scattered.groupBy("bucket").applyInArrow(fisher_yates, schema), "shuffled")


def sharded(shuffle: DataFrame, shards: int) -> DataFrame:
    """``shard, slot, record``: the shuffled records dealt out in turn.

    Only the first rank of each bucket is joined to the records: one number for each
    ``bucket_bytes`` of text, in a written table whose size Spark checks.
    """
    sizes = shuffle.groupBy("bucket").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    blocks = sizes.groupBy("block").agg(F.sum("n").alias("n"))
    running = F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("block", running.alias("start"))
    inner = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.withColumn("before", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    first = first.join(blocks, "block").select("bucket", (F.col("start") + F.col("before")).alias("first"))
    rank = F.col("first") + F.col("place")
    return shuffle.join(stage(first, "first-ranks"), "bucket").select(
        (rank % shards).cast(LongType()).cast("int").alias("shard"),
        F.floor(rank / shards).cast("long").alias("slot"),
        "record",
    )
