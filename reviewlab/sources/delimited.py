"""Review files: delimited text with a header, quotes doubled inside quotes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from reviewlab.config import under
from reviewlab.contracts import REVIEW_SCHEMA

# Fixed value: the file a folder of raw data holds.
DATASET_NAME = "dataset.csv"


def dataset_path(folder: str) -> str:
    """The data set inside ``folder``; a path that already names files is kept."""
    last = folder.rstrip("/").rsplit("/", 1)[-1]
    if last.endswith((".csv", ".csv.gz", ".csv.bz2")) or "*" in last:
        return folder
    return under(folder, DATASET_NAME)


def read_reviews(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    schema: StructType = REVIEW_SCHEMA,
    multi_line: bool = False,
    enforce_schema: bool = False,
    mode: str = "PERMISSIVE",
    malformed: str | None = None,
) -> DataFrame:
    """Scan with a fixed schema; no inference pass over the data.

    The header is compared with the schema unless ``enforce_schema`` is set, in
    which case names come from the schema whatever the file says. A file is split
    over many tasks unless ``multi_line`` is set; turn that on only for texts with
    quoted newlines, and then keep each file to what one task can read. ``malformed``
    names a column that gets the text of records with too few or too many fields.
    """
    if malformed:
        schema = StructType([*schema.fields, StructField(malformed, StringType())])
    return spark.read.csv(
        path if isinstance(path, str) else list(path),
        schema=schema,
        header=True,
        escape='"',
        multiLine=multi_line,
        enforceSchema=enforce_schema,
        mode=mode,
        columnNameOfCorruptRecord=malformed,
    )


def header_of(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The columns as the file names them, for a check before the scan; reads one line."""
    return spark.read.csv(path if isinstance(path, str) else list(path), header=True, escape='"')


def write_reviews(df: DataFrame, path: str) -> None:
    """The form ``read_reviews`` reads back unchanged."""
    df.write.csv(path, header=True, quoteAll=True, escape='"')
