"""Taking all rows of some subjects out of a table of Parquet files, and keeping them out.

Only files that hold a subject are written anew; all others stay byte for byte.

- ``file_index`` keeps a Bloom filter of fixed size of the subjects of each file, so most files
  need not be read to be ruled out. It is built where rows lie: what is exchanged is bits.
- ``suspects`` are the files whose filter has all bits of a subject; ``erase`` reads those and
  decides by the values themselves, so a false positive costs a read and no row.
- ``erase`` writes what is left of the hit files, then removes them. What was removed is
  logged per file and subject, subjects as digests only, and each subject leaves a tombstone.
- ``without_erased`` holds back rows of erased subjects that arrive later.

Stopped runs: a run is named, and repeated under its name it ends what it began; until then
rows are never fewer than they should be, but between moving the new files in and
removing the old, what is left of hit files is there twice. Read the table with ``read``. One
run at a time; rows added meanwhile to new files are not looked at.

Nulls: a row without a subject stays, a null among the subjects names nobody. Equal rows all go.
Subjects are compared as text. Repeated subjects count once; those that the table does not
have leave a tombstone and no log. No subjects: nothing is written. A file of which nothing is
left goes. The table is a folder of files without partition folders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.config import under

# Fixed by Spark's bitmap functions: bits of one bitmap.
BITMAP_BITS = 32_768
BITMAPS = 32
HASHES = 5


def digest(subject: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt + ":"), subject.cast("string")), 256)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table, files written by earlier runs included."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def _place(subject: Column, i: int, bitmaps: int) -> Column:
    return F.pmod(F.xxhash64(subject, F.lit(i)), F.lit(bitmaps * BITMAP_BITS))


def _bits(subject: Column, bitmaps: int) -> Column:
    """The places of a subject's bits: bitmap, and bit in it."""
    places = [_place(subject, i, bitmaps) for i in range(HASHES)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("hash"), F.floor(p / BITMAP_BITS).cast("int").alias("bitmap"), (p % BITMAP_BITS).cast("long").alias("bit"))
            for i, p in enumerate(places)
        ]
    )


def file_index(rows: DataFrame, subject: str, bitmaps: int = BITMAPS) -> DataFrame:
    """``file, bitmap, bits``: at most ``bitmaps`` times 4 KB per file, whatever its rows.

    Bits are set while a file is read, in one table of that size per task, so no row is sorted;
    parts of a file that several tasks read are put together.
    """
    value = F.col(subject).cast("string")
    places = [_place(value, i, bitmaps) for i in range(HASHES)]
    placed = rows.where(value.isNotNull()).select(F.col("_metadata.file_path").alias("file"), *[p.alias(f"p{i}") for i, p in enumerate(places)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, table = None, np.zeros(bitmaps * BITMAP_BITS, bool)
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            of = names.indices.to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                file = names.dictionary[int(of[start])].as_py()
                if current is not None and file != current:
                    yield filled(current, table)
                    table[:] = False
                current = file
                for column in batch.columns[1:]:
                    table[column.slice(start, end - start).to_numpy()] = True
        if current is not None:
            yield filled(current, table)

    def filled(file: str, table: np.ndarray) -> pa.RecordBatch:
        bits = np.packbits(table.reshape(bitmaps, -1), axis=1, bitorder="little")
        (used,) = np.nonzero(bits.any(axis=1))
        columns = [pa.array([file] * len(used)), pa.array(used, pa.int32()), pa.array([bits[i].tobytes() for i in used], pa.binary())]
        return pa.record_batch(columns, ["file", "bitmap", "bits"])

    parts = placed.mapInArrow(work, "file string, bitmap int, bits binary")
    return parts.groupBy("file", "bitmap").agg(F.bitmap_or_agg("bits").alias("bits"))


def suspects(index: DataFrame, subjects: DataFrame, bitmaps: int = BITMAPS) -> DataFrame:
    """``file``: those that may hold one of ``subjects`` (one column, text)."""
    (name,) = subjects.columns
    asked = subjects.select(F.col(name).alias("subject"), F.explode(_bits(F.col(name), bitmaps)).alias("p")).select("subject", "p.*")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(F.col("bit") / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.pow(F.lit(2), F.col("bit") % 8).cast("int")) != 0
    met = asked.join(index, "bitmap").where(is_set)
    return met.groupBy("file", "subject").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == HASHES).select("file").distinct()


def erase(
    spark: SparkSession,
    path: str,
    subject: str,
    subjects: DataFrame,
    log: str,
    run: str,
    *,
    salt: str,
    index: DataFrame | None = None,
    bitmaps: int = BITMAPS,
) -> DataFrame:
    """Remove all rows whose ``subject`` is among ``subjects`` (one column); this run's part of the log.

    ``log`` is a folder beside the table, with ``plans``, ``removed`` and ``tombstones``
    by run. ``index``, where one is kept, has to cover all files; else it is taken first.
    The driver gets the names of the files that are hit, which it has for any scan of them.
    """
    (name,) = subjects.columns
    wanted = subjects.select(F.col(name).cast("string").alias("subject")).where("subject is not null").distinct()
    plan, moved, halfway = (under(log, "plans", run), under(path, f"erased-{run}"), under(path, f"_erasing-{run}"))
    if not _is_whole(spark, plan):
        _remove(spark, plan)
        if index is None:
            index = file_index(read(spark, path), subject, bitmaps)
        files = [r["file"] for r in suspects(index, wanted, bitmaps).collect()]
        found = _among(spark, files, path).join(wanted, F.col(subject).cast("string") == F.col("subject"))
        found = found.groupBy("file", "subject").agg(F.count(F.lit(1)).alias("rows_removed"))
        found.select("file", digest(F.col("subject"), salt).alias("subject"), "rows_removed").write.parquet(plan)
    planned = spark.read.parquet(plan)
    hit = [r["file"] for r in planned.select("file").distinct().collect()]
    if hit and not _exists(spark, moved):
        _remove(spark, halfway)
        left = _among(spark, hit, path)
        gone = F.col(subject).cast("string") == F.col("subject")
        left.join(wanted, gone, "left_anti").drop("file").write.parquet(halfway)
        if not _rename(spark, halfway, moved):
            raise OSError(f"could not move {halfway}")
    for file in hit:
        _remove(spark, file)
    planned.write.mode("overwrite").parquet(under(log, "removed", f"run={run}"))
    wanted.select(digest(F.col("subject"), salt).alias("subject")).write.mode("overwrite").parquet(under(log, "tombstones", f"run={run}"))
    return spark.read.parquet(under(log, "removed", f"run={run}"))


def tombstones(spark: SparkSession, log: str) -> DataFrame:
    """Digests of all subjects ever erased, with the run."""
    try:
        return spark.read.parquet(under(log, "tombstones"))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "subject string, run string")
        raise


def without_erased(arriving: DataFrame, subject: str, stones: DataFrame, *, salt: str) -> DataFrame:
    """Rows of subjects that were never erased."""
    gone = stones.select(F.col("subject").alias("_stone")).distinct()
    return arriving.join(gone, digest(F.col(subject), salt) == F.col("_stone"), "left_anti")


def _among(spark: SparkSession, files: list[str], path: str) -> DataFrame:
    """Rows of some files of the table, with their file."""
    every = read(spark, path)
    some = spark.read.schema(every.schema).parquet(*files) if files else every.limit(0)
    return some.withColumn("file", F.col("_metadata.file_path"))


def _file_system(spark: SparkSession, path: str) -> tuple:
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), name


def _exists(spark: SparkSession, path: str) -> bool:
    system, name = _file_system(spark, path)
    return system.exists(name)


def _is_whole(spark: SparkSession, path: str) -> bool:
    return _exists(spark, under(path, "_SUCCESS"))


def _remove(spark: SparkSession, path: str) -> None:
    system, name = _file_system(spark, path)
    system.delete(name, True)


def _rename(spark: SparkSession, old: str, new: str) -> bool:
    system, name = _file_system(spark, old)
    return system.rename(name, _file_system(spark, new)[1])
