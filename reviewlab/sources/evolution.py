"""Files whose schema changed over time, read as one table.

The footers of all files are read in tasks and grouped by schema; only the distinct schemas
and the paths of their files come to the driver, as for any scan. A field is followed by its
Parquet field id, so a renamed column stays one column, under the name that the newest file
(by time of change, then path) has for it. Fields without an id go by name, and join the
field with an id if exactly one ever bore that name.

Each column gets the least type that holds all values of all its types exactly. Where no
such type exists (a long and a double, a number and a text) the column is read as text, and
``conflicts`` has a row for each type. Files without a column
have nulls in it. Two columns that end under one name keep it apart by ``_<id>``. Files of no
rows count by their schema; a folder without files has no schema and raises.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column as Value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from reviewlab.sources.manifest import CLIENTS, GROUP, opened, plain_path

INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
DIGITS = dict(zip(INTEGERS, (3, 5, 10, 19)))
MOST_DIGITS = 38
# Where Spark writes its own schema in a footer, and the id of a field in it.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
FIELD_ID = "parquet.field.id"


def least_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds the values of both exactly; None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in DIGITS and b in DIGITS:
        return max(a, b, key=DIGITS.get)
    pair = {type(a), type(b)}
    if pair == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if pair & {T.FloatType, T.DoubleType}:
        whole = a if a in DIGITS else b
        return T.DoubleType() if DIGITS.get(whole, 99) <= 10 else None
    if pair == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    sizes = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (DIGITS.get(t), 0) for t in (a, b)]
    if T.DecimalType in pair and all(digits for digits, _ in sizes):
        scale = max(s for _, s in sizes)
        digits = max(p - s for p, s in sizes) + scale
        return T.DecimalType(digits, scale) if digits <= MOST_DIGITS else None
    if pair == {T.ArrayType}:
        # Structs in arrays would be cast by place, not by name.
        inner = None if isinstance(a.elementType, T.StructType) else least_type(a.elementType, b.elementType)
        return inner and T.ArrayType(inner)
    if pair == {T.StructType}:
        inner = {f.name: f.dataType for f in a}
        for f in b:
            inner[f.name] = least_type(inner[f.name], f.dataType) if f.name in inner else f.dataType
        return T.StructType([T.StructField(n, t) for n, t in inner.items()]) if all(inner.values()) else None
    return None


def footers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path, modified, row_count, fields`` of every Parquet file: fields as JSON of
    ``[id or null, name, type]``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = reader.load(path if isinstance(path, str) else list(path)).select("path", "modificationTime")
    names = {plain_path(unquote(name)).split(":")[0] for name in files.inputFiles()}
    if names - set(CLIENTS):
        raise ValueError(f"footers need a store with a client: {sorted(CLIENTS)}")

    def read(path: str) -> tuple[int, str]:
        with opened(plain_path(path)) as file:
            found = pq.ParquetFile(file)
            own = (found.metadata.metadata or {}).get(SPARK_SCHEMA)
            old = {c.name for c in (found.schema.column(i) for i in range(len(found.schema))) if c.physical_type == "INT96"}
            fields = _fields_of_spark(own) if own else [_field(f, f.name in old) for f in found.schema_arrow]
            return found.metadata.num_rows, json.dumps(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [read(p) for p in batch.column("path").to_pylist()]
            counts, fields = pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())
            yield batch.append_column("row_count", counts).append_column("fields", fields)

    ddl = "path string, modified timestamp, row_count long, fields string"
    return files.withColumnRenamed("modificationTime", "modified").repartition("path").mapInArrow(work, ddl)


def _fields_of_spark(schema: bytes) -> list:
    """Fields as Spark wrote them beside the file's own schema, with their exact types."""
    fields = T.StructType.fromJson(json.loads(schema)).fields
    return [[(f.metadata or {}).get(FIELD_ID), f.name, f.dataType.json()] for f in fields]


def _field(field: pa.Field, is_instant: bool) -> list:
    number = (field.metadata or {}).get(b"PARQUET:field_id")
    kind = T.TimestampType() if is_instant else from_arrow_type(field.type, prefer_timestamp_ntz=True)
    return [None if number is None else int(number), field.name, kind.json()]


@dataclass(frozen=True)
class Version:
    """One of the distinct schemas: its fields by identity, name and type, and its files."""

    fields: tuple[tuple[str, str, T.DataType], ...]
    paths: tuple[str, ...]
    row_count: int


def versions(spark: SparkSession, path: str | Sequence[str]) -> list[Version]:
    """The distinct schemas, oldest first."""
    rows = footers(spark, path).groupBy("fields").agg(
        F.max(F.struct("modified", "path")).alias("newest"),
        F.sum("row_count").alias("row_count"),
        F.array_sort(F.collect_list("path")).alias("paths"),
    )
    rows = sorted(rows.collect(), key=lambda r: tuple(r["newest"]))
    read = [[(n, name, _type(kind)) for n, name, kind in json.loads(r["fields"])] for r in rows]
    bearers: dict[str, set[int]] = {}
    for n, name, _ in (f for fields in read for f in fields):
        if n is not None:
            bearers.setdefault(name, set()).add(n)

    def identity(n: int | None, name: str, taken: set[int]) -> str:
        if n is None and len(bearers.get(name, ())) == 1 and not bearers[name] & taken:
            (n,) = bearers[name]
        return name if n is None else f"#{n}"

    found = []
    for row, fields in zip(rows, read):
        taken = {n for n, _, _ in fields if n is not None}
        fields = tuple((identity(n, name, taken), name, kind) for n, name, kind in fields)
        found.append(Version(fields, tuple(row["paths"]), row["row_count"]))
    return found


def _type(kind: str) -> T.DataType:
    field = {"name": "x", "type": json.loads(kind), "nullable": True, "metadata": {}}
    return T.StructType.fromJson({"type": "struct", "fields": [field]})["x"].dataType


@dataclass(frozen=True)
class Column:
    """A column of the table: what it is called now, its type, and all its types."""

    identity: str
    name: str
    kind: T.DataType
    kinds: tuple[T.DataType, ...]

    @property
    def is_conflict(self) -> bool:
        return reduce(lambda a, b: a and least_type(a, b), self.kinds) is None


def columns(found: Sequence[Version]) -> list[Column]:
    """The columns of all versions, in order of first appearance."""
    if not found:
        raise ValueError("no files, so no schema")
    names: dict[str, str] = {}
    kinds: dict[str, list[T.DataType]] = {}
    for version in found:
        for identity, name, kind in version.fields:
            names[identity] = name
            if kind not in kinds.setdefault(identity, []):
                kinds[identity].append(kind)
    made: list[Column] = []
    for identity, name in names.items():
        if list(names.values()).count(name) > 1:
            name = f"{name}_{identity.lstrip('#')}"
        # In one order, as the least type of several may depend on it.
        every = sorted(kinds[identity], key=lambda t: (not isinstance(t, T.DecimalType), t.simpleString()))
        kind = reduce(lambda a, b: a and least_type(a, b), every) or T.StringType()
        made.append(Column(identity, name, kind, tuple(every)))
    return made


def read_evolved(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All rows of all files under the newest names and the least common types."""
    found = versions(spark, path)
    wanted = columns(found)
    parts = [_read(spark, version, wanted, version.paths[at : at + GROUP]) for version in found for at in range(0, len(version.paths), GROUP)]
    return reduce(DataFrame.unionByName, parts)


def _read(spark: SparkSession, version: Version, wanted: Sequence[Column], paths: Sequence[str]) -> DataFrame:
    """Columns are cast after the scan, so filters on unchanged columns reach the files."""
    schema = T.StructType([T.StructField(name, kind) for _, name, kind in version.fields])
    has = {identity: (name, kind) for identity, name, kind in version.fields}

    def column(c: Column) -> Value:
        if c.identity not in has:
            return F.lit(None).cast(c.kind).alias(c.name)
        name, kind = has[c.identity]
        read = F.col(f"`{name.replace('`', '``')}`")
        return _widened(read, kind, c.kind).alias(c.name)

    return spark.read.schema(schema).parquet(*paths).select(*[column(c) for c in wanted])


def _widened(value: Value, have: T.DataType, want: T.DataType) -> Value:
    """Cast to the wider type, structs field by field by name."""
    if not (isinstance(have, T.StructType) and isinstance(want, T.StructType)):
        return value.cast(want)
    inner = [
        (_widened(value[f.name], have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in want
    ]
    return F.when(value.isNotNull(), F.struct(*inner))


def conflicts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``column, type, files, row_count``: the types of columns that no exact type holds."""
    found = versions(spark, path)
    rows = [
        (c.name, kind.simpleString(), sum(len(v.paths) for v in has), sum(v.row_count for v in has))
        for c in columns(found)
        if c.is_conflict
        for kind in c.kinds
        for has in [[v for v in found if any(f[0] == c.identity and f[2] == kind for f in v.fields)]]
    ]
    return spark.createDataFrame(rows, "column string, type string, files long, row_count long")


def recoded(
    rows: DataFrame, mapping: DataFrame, code: str, version: str, last: int, *, weight: str = "weight"
) -> DataFrame:
    """``rows`` with ``code`` as it is in code list ``last``, and ``weight`` of each.

    ``mapping`` has ``version, old, new, weight``: what becomes of a code between that version
    and the next. A code that is split makes one row for each new code; one that is not
    listed stays. Codes are followed through all versions once per distinct code, then joined
    to the rows. Rows whose code or version is null, or whose version is ``last`` or later,
    keep their code at weight 1. Repeated lines of a mapping count once and a missing weight
    is 1; ``mapping_faults`` lists what is wrong with it.
    """
    share = F.max(F.coalesce("weight", F.lit(1.0))).alias("share")
    ways = mapping.where("old is not null and new is not null").groupBy("version", "old", "new").agg(share)
    first = mapping.agg(F.min("version")).first()[0]
    walk = rows.select(F.col(version).alias("_from"), F.col(code).alias("_code")).where("_from is not null and _code is not null").distinct()
    walk = walk.withColumn("_at", F.col("_code")).withColumn("_share", F.lit(1.0))
    for step in range(last if first is None else int(first), last):
        way = ways.where(F.col("version") == step).drop("version")
        moved = walk.join(way, (F.col("_at") == F.col("old")) & (F.col("_from") <= step), "left")
        moved = moved.withColumn("_at", F.coalesce("new", "_at"))
        part = F.sum(F.col("_share") * F.coalesce("share", F.lit(1.0))).alias("_share")
        walk = moved.groupBy("_from", "_code", "_at").agg(part)
    known = walk.withColumnRenamed("_from", "_v").withColumnRenamed("_code", "_c")
    joined = rows.join(known, (rows[version] == known["_v"]) & (rows[code] == known["_c"]), "left")
    kept = [F.coalesce("_at", rows[c]).alias(c) if c == code else rows[c] for c in rows.columns]
    return joined.select(*kept, F.coalesce("_share", F.lit(1.0)).alias(weight))


def mapping_faults(mapping: DataFrame) -> DataFrame:
    """``version, old, fault``: weights that do not add up to one, or an end that is missing."""
    shares = mapping.groupBy("version", "old", "new").agg(F.max("weight").alias("weight"))
    total = shares.groupBy("version", "old").agg(F.sum("weight").alias("total"), F.count_if(F.col("new").isNull() | F.col("weight").isNull()).alias("open"))
    fault = F.when((F.col("open") > 0) | F.col("old").isNull() | F.col("version").isNull(), "open").when(F.abs(F.col("total") - 1) > 1e-9, "weights")
    return total.select("version", "old", fault.alias("fault")).where("fault is not null")
