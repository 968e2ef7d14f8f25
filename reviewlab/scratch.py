"""Tables written between steps, in a folder all executors share.

A written table cuts the lineage and outlives any executor, and a later step
reads only the columns it needs. What was exchanged to make it goes as soon as it is
written, and not when the driver next collects garbage.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from reviewlab.config import under

SETTING = "spark.checkpoint.dir"
OWN = "reviewlab.staging"
CLEANING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = Lock()
# Per session: how many writes run, and the setting to go back to after the last.
_writing: Counter[SparkSession] = Counter()
_before: dict[SparkSession, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of the run, else the one the cluster names.

    Where neither is set, a local master, which is one machine, gets a folder of its
    own that goes when the program ends. A cluster has to name one.
    """
    named = spark.conf.get(OWN, None) or spark.conf.get(SETTING, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder every executor can reach")
    return _own_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _own_folder(application: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"reviewlab-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


@contextmanager
def staging(spark: SparkSession, folder: str) -> Iterator[None]:
    """Stage below ``folder`` and remove it at the end, also on failure."""
    before = spark.conf.get(OWN, None)
    spark.conf.set(OWN, folder)
    try:
        yield
    finally:
        spark.conf.set(OWN, before) if before else spark.conf.unset(OWN)
        _remove(spark, folder)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses."""
    return under(shared_folder(spark), f"reviewlab-{name}-{uuid.uuid4().hex}")


@contextmanager
def _cleaning(spark: SparkSession) -> Iterator[None]:
    """Queries that begin inside remove their shuffle files as they end; threads may be inside together."""
    with _lock:
        if not _writing[spark]:
            _before[spark] = spark.conf.get(CLEANING, "false")
            spark.conf.set(CLEANING, "true")
        _writing[spark] += 1
    try:
        yield
    finally:
        with _lock:
            _writing[spark] -= 1
            if not _writing[spark]:
                del _writing[spark]
                spark.conf.set(CLEANING, _before.pop(spark))


def stage(df: DataFrame, name: str, by: Sequence[str] = (), **options: str | int) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back; ``options`` go to the writer.

    Columns of ``by`` become folders, so that rows with some of their values are read alone.
    """
    path = fresh_path(df.sparkSession, name)
    with _cleaning(df.sparkSession):
        df.write.options(**options).parquet(path, partitionBy=list(by) or None)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.staged_at = path
    return stored


def discard(*staged: DataFrame) -> None:
    """Remove tables that ``stage`` returned, once no table still to be computed reads them."""
    for df in staged:
        _remove(df.sparkSession, df.staged_at)


@contextmanager
def temporaries() -> Iterator[Callable[..., DataFrame]]:
    """A ``stage`` whose tables go at the end of the block, also on failure."""
    made: list[DataFrame] = []

    def keep(df: DataFrame, name: str, **options: str | int) -> DataFrame:
        made.append(stage(df, name, **options))
        return made[-1]

    try:
        yield keep
    finally:
        discard(*made)
