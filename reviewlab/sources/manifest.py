"""Content digests: what is there, what should be there, and what is left to load.

A manifest has one row per file (or per record): ``path, length, digest``. Only
these short rows are compared; content is joined to nothing but the digest of its file.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import batched
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.scratch import stage

MANIFEST_DDL = "path string, length bigint, digest string"
# Stores that tasks can open by themselves, and what the client calls them.
CLIENTS = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
BLOCK_BYTES = 1 << 20
# Paths that a reader gets at a time.
GROUP = 10_000


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, in hex."""
    return F.sha2(text, 256)


def record_manifest(df: DataFrame, key: Column, content: Column) -> DataFrame:
    """A manifest of table rows; digests are taken before anything is shuffled."""
    return df.select(
        key.cast("string").alias("path"),
        F.octet_length(content).cast("bigint").alias("length"),
        text_digest(content).alias("digest"),
    )


def file_manifest(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    pattern: str | None = None,
    range_bytes: int | None = None,
) -> DataFrame:
    """SHA-256 of every file under ``path``, of any size.

    Spark lists the files, without content; tasks read them through a file system client, a
    megabyte at a time. Without ``range_bytes`` a file is one row and its digest that of
    its bytes. With it, ranges of that size are rows, so many tasks share a large file, and
    the digest is that of the range digests, in hex and in order. In stores that only Spark
    can open (see ``CLIENTS``) files are read whole by Spark, which refuses one of 2 GB.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path if isinstance(path, str) else list(path))
    # Spark passes over files of no bytes; its list of files, which the driver holds for any
    # scan, has them.
    names = [plain_path(unquote(name)) for name in files.inputFiles()]
    every = spark.createDataFrame([(name,) for name in names], "path string")
    length = F.coalesce("length", F.lit(0)).cast("bigint").alias("length")
    if any(name.split(":")[0] not in CLIENTS for name in names):
        if range_bytes:
            raise ValueError(f"ranges need a store with a client: {sorted(CLIENTS)}")
        read = files.select(_plain(F.col("path")).alias("path"), "length", F.sha2("content", 256).alias("digest"))
        none = F.sha2(F.lit("").cast("binary"), 256)
        return every.join(read, "path", "left").select("path", length, F.coalesce("digest", none).alias("digest"))
    sizes = files.select(_plain(F.col("path")).alias("path"), "length")
    listed = every.join(sizes, "path", "left").select("path", length)
    if not range_bytes:
        whole = listed.select("path", "length", F.lit(0).cast("long").alias("start"), F.col("length").alias("end"))
        return _digests(whole).select("path", "length", "digest")
    step = F.lit(range_bytes).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0).cast("long")), step)
    ranges = listed.select("path", "length", F.explode(starts).alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + step, "length"))
    parts = _digests(ranges).groupBy("path", "length").agg(F.array_sort(F.collect_list(F.struct("start", "digest"))).alias("d"))
    joined = F.array_join(F.transform("d", lambda r: r["digest"]), "")
    return parts.select("path", "length", F.sha2(joined, 256).alias("digest"))


def _digests(ranges: DataFrame) -> DataFrame:
    """``ranges`` (``path, length, start, end``) with the SHA-256 of their bytes."""

    def digest(path: str, start: int, end: int) -> str:
        found = hashlib.sha256()
        with opened(path) as file:
            file.seek(start)
            while start < end:
                block = file.read(min(BLOCK_BYTES, end - start))
                if not block:
                    raise EOFError(f"{path} ended before {end}")
                found.update(block)
                start += len(block)
        return found.hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("path", "start", "end")])
            yield batch.append_column("digest", pa.array([digest(*r) for r in rows], pa.string()))

    # Spread over tasks; a row is a name and three numbers.
    spread = ranges.repartition("path", "start")
    return spread.mapInArrow(work, "path string, length long, start long, end long, digest string")


def opened(path: str) -> pa.NativeFile:
    """A file of one of ``CLIENTS``, for a task that reads parts of it."""
    scheme, _, rest = path.partition(":")
    # Local names are taken as they are: a uri would have signs in them decoded.
    if scheme == "file":
        system, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        system, name = fs.FileSystem.from_uri(f"{CLIENTS[scheme]}:{rest}")
    return system.open_input_file(name)


def plain_path(path: str) -> str:
    """Local files by one name: readers say ``file:/x`` or ``file:///x``."""
    return re.sub("^file:/+", "file:/", path)


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def verify(expected: DataFrame, actual: DataFrame, *, check_digest: bool = True) -> DataFrame:
    """Every expected path with its status: ``ok``, ``missing``, ``mismatch`` or ``unchecked``.

    ``unchecked`` means present, with no digest to compare or none asked for.
    Nothing is deleted, so the caller decides what a mismatch means. Repeated lines
    count once; a path that was found with two contents is a mismatch.
    """
    wanted = expected.select("path", F.lower("digest").alias("expected_digest")).distinct()
    found = actual.groupBy("path").agg(
        F.min("digest").alias("actual_digest"),
        F.coalesce(F.min("digest") != F.max("digest"), F.lit(False)).alias("several"),
        F.lit(True).alias("found"),
    )
    unchecked = F.col("expected_digest").isNull() if check_digest else F.lit(True)
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(unchecked, "unchecked")
        .when(~F.col("several") & (F.col("expected_digest") == F.col("actual_digest")), "ok")
        .otherwise("mismatch")
    )
    return wanted.join(found, "path", "left").select(
        "path", "expected_digest", "actual_digest", status.alias("status")
    )


def all_valid(expected: DataFrame, actual: DataFrame, *, check_digest: bool = True) -> bool:
    """True when nothing expected is missing or different."""
    bad = verify(expected, actual, check_digest=check_digest).where(
        F.col("status").isin("missing", "mismatch")
    )
    return bad.isEmpty()


def pending(offered: DataFrame, loaded: DataFrame, *, force: bool = False) -> DataFrame:
    """Offered entries not loaded yet with the same content; all of them when forced.

    Digests compare null-safe: an entry without content is loaded once like any
    other, and no test for null makes Spark take a digest twice.
    """
    if force:
        return offered
    known = loaded.select(F.col("path").alias("known"), F.col("digest").alias("known_digest"))
    same = (F.col("path") == F.col("known")) & F.col("digest").eqNullSafe(F.col("known_digest"))
    return offered.join(known, same, "left_anti")


def load_pending(
    spark: SparkSession,
    read: Callable[[list[str]], DataFrame],
    offered: DataFrame,
    table_path: str,
    *,
    force: bool = False,
) -> DataFrame:
    """Load the files that ``table_path`` does not hold yet; return what was pending.

    Only pending files are read: ``read`` gets their paths and returns their rows,
    and is never called without any. Each stored row keeps the path and digest it
    came from, and each file has its own partition, so a load replaces just the rows
    of the files it reads: a new version takes the place of the old one, rows of
    files that are no longer offered stay, and a repeated run, forced or not, leaves
    the same table. What is pending is a stored table; paths are handed out GROUP at a
    time. A run that died has loaded whole groups or nothing of them, and the next run
    goes on with the rest.
    """
    loaded = _ledger(spark, table_path)
    todo = offered if loaded is None else pending(offered, loaded, force=force)
    todo = stage(todo.select("path", "length", "digest"), "pending")
    digests = todo.select("path", "digest")
    for group in batched((row["path"] for row in todo.select("path").distinct().toLocalIterator()), GROUP):
        rows = read(list(group)).withColumn("path", _plain(F.col("_metadata.file_path")))
        stored = rows.join(digests, "path").withColumn("source", F.sha2("path", 256))
        stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "source"
        ).parquet(table_path)
    return todo


def current_rows(spark: SparkSession, table_path: str, offered: DataFrame) -> DataFrame:
    """Loaded rows whose file is still offered with the same content."""
    return spark.read.parquet(table_path).drop("source").join(
        offered.select("path", "digest"), ["path", "digest"], "left_semi"
    )


def _ledger(spark: SparkSession, table_path: str) -> DataFrame | None:
    try:
        stored = spark.read.parquet(table_path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return stored.select("path", "digest").distinct()
