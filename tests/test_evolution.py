"""Files of changing schemas and code lists against brute force."""

from __future__ import annotations

import itertools
import os
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.sources import evolution
from reviewlab.sources.evolution import least_type

TYPES = [
    *evolution.INTEGERS,
    *(T.FloatType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampNTZType(), T.NullType()),
    *(T.DecimalType(5, 2), T.DecimalType(38, 10), T.ArrayType(T.ByteType()), T.ArrayType(T.LongType())),
    *(T.StructType([T.StructField("a", T.IntegerType())]), T.StructType([T.StructField("b", T.LongType())])),
]


def plain(t):
    return t and t.simpleString()


def test_the_types_are_a_lattice():
    for a, b in itertools.product(TYPES, repeat=2):
        both = least_type(a, b)
        if not isinstance(a, T.StructType):
            assert plain(both) == plain(least_type(b, a))
        if both:
            assert plain(least_type(both, a)) == plain(both) == plain(least_type(both, b))
    for a, b, c in itertools.product([t for t in TYPES if not isinstance(t, T.StructType)], repeat=3):
        one, other = least_type(a, b), least_type(b, c)
        assert plain(one and least_type(one, c)) == plain(other and least_type(a, other))


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        (T.IntegerType(), T.DoubleType(), "double"),
        (T.LongType(), T.DoubleType(), None),
        (T.IntegerType(), T.DecimalType(5, 2), "decimal(12,2)"),
        (T.LongType(), T.DecimalType(38, 20), None),
        (T.StringType(), T.IntegerType(), None),
    ],
)
def test_least_types(a, b, want):
    assert plain(least_type(a, b)) == want


def written(path, name, when, fields, rows):
    """A file of fields ``(name, id, type)``, last changed at ``when``."""
    schema = pa.schema([pa.field(n, t, metadata={"PARQUET:field_id": str(i)} if i is not None else None) for n, i, t in fields])
    pq.write_table(pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema), path / name)
    os.utime(path / name, (when, when))


def test_columns_follow_their_ids(spark, tmp_path):
    point = pa.struct([("x", pa.int32())])
    wide = pa.struct([("y", pa.string()), ("x", pa.int64())])
    written(tmp_path, "b.parquet", 1000, [("k", 1, pa.int32()), ("old", 2, pa.string()), ("p", 3, point)], [(1, "a", {"x": 1}), (2, None, None)])
    # Two columns changed names with each other; one has no id and joins by name.
    written(tmp_path, "a.parquet", 2000, [("old", 1, pa.int64()), ("k", 2, pa.string()), ("p", None, wide)], [(2**40, "b", {"y": "t", "x": 2**40})])
    written(tmp_path, "c.parquet", 500, [("gone", 9, pa.decimal128(5, 2))], [(Decimal("1.50"),)])
    written(tmp_path, "d.parquet", 400, [("gone", 9, pa.int16())], [])
    (tmp_path / "notes.txt").write_text("not a table")
    found = evolution.read_evolved(spark, str(tmp_path))
    assert dict(found.dtypes) == {"gone": "decimal(7,2)", "old": "bigint", "k": "string", "p": "struct<x:bigint,y:string>"}
    rows = Counter((r.gone, r.old, r.k, r.p and (r.p.x, r.p.y)) for r in found.collect())
    assert rows == Counter(
        [(Decimal("1.50"), None, None, None), (None, 1, "a", (1, None)), (None, 2, None, None), (None, 2**40, "b", (2**40, "t"))]
    )
    assert evolution.conflicts(spark, str(tmp_path)).count() == 0


def test_conflicts_are_rows_and_read_as_text(spark, tmp_path):
    written(tmp_path, "a.parquet", 1, [("v", 1, pa.int64()), ("w", 2, pa.int32())], [(7, 1), (None, 2)])
    written(tmp_path, "b.parquet", 2, [("v", 1, pa.float64()), ("w", 3, pa.int32())], [(1.5, 3)])
    written(tmp_path, "c.parquet", 3, [("v", 1, pa.float64()), ("w", 3, pa.int32())], [(2.5, 4)])
    found = evolution.read_evolved(spark, str(tmp_path))
    # Two columns of one name are told apart by their ids.
    assert sorted(found.columns) == ["v", "w_2", "w_3"]
    assert Counter(map(tuple, found.select("v", "w_2", "w_3").collect())) == Counter(
        [("7", 1, None), (None, 2, None), ("1.5", None, 3), ("2.5", None, 4)]
    )
    rows = sorted(map(tuple, evolution.conflicts(spark, str(tmp_path)).collect()))
    assert rows == [("v", "bigint", 1, 2), ("v", "double", 2, 2)]


def test_spark_files_keep_exact_types(spark, tmp_path):
    rows = spark.range(3).select(
        F.col("id").alias("k", metadata={evolution.FIELD_ID: 4}), F.timestamp_seconds("id").alias("t"), F.lit("x").cast("char(3)").alias("c")
    )
    rows.write.parquet(str(tmp_path / "one"))
    rows.withColumn("k", F.col("k").cast("int").alias("n", metadata={evolution.FIELD_ID: 4})).write.parquet(str(tmp_path / "two"))
    found = evolution.read_evolved(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert dict(found.dtypes)["t"] == "timestamp" and dict(found.dtypes)["k"] == "bigint"
    assert Counter(found.select("t").collect()) == Counter(rows.select("t").union(rows.select("t")).collect())


def test_filters_reach_the_files(spark, tmp_path):
    written(tmp_path, "a.parquet", 1, [("k", 1, pa.int64()), ("v", 2, pa.int64())], [(1, 1)])
    plan = evolution.read_evolved(spark, str(tmp_path)).where("k = 1").select("k")._jdf.queryExecution().toString()
    assert "EqualTo(k,1)" in plan and "ReadSchema: struct<k:bigint>" in plan


def plain_recoded(rows, mapping, last):
    found = defaultdict(float)
    for i, (code, version) in enumerate(rows):
        now = {code: 1.0}
        if code is not None and version is not None:
            for step in range(version, last):
                after = defaultdict(float)
                for c, w in now.items():
                    ways = [(new, share) for v, old, new, share in set(mapping) if v == step and old == c]
                    for new, share in ways or [(c, 1.0)]:
                        after[new] += w * share
                now = after
        for c, w in now.items():
            found[i, c] += w
    return {k: round(w, 9) for k, w in found.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_codes_are_followed_to_the_end(spark, seed):
    rng = random.Random(seed)
    codes = "abcdefg"
    mapping = []
    for version in range(1, 6):
        for old in rng.sample(codes, 4):
            news = rng.sample(codes, rng.randint(1, 3))
            mapping += [(version, old, new, 1.0 / len(news)) for new in news]
    rows = [(rng.choice([*codes, None, "z"]), rng.choice([0, 1, 2, 4, 6, 7, None])) for _ in range(200)]
    ddl = "version int, old string, new string, weight double"
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, code string, list int")
    found = evolution.recoded(table, spark.createDataFrame(mapping + mapping[:3], ddl), "code", "list", 6)
    got = found.collect()
    assert {(r.i, r.code): round(r.weight, 9) for r in got} == plain_recoded(rows, mapping, 6)
    assert len(got) == len({(r.i, r.code) for r in got})
    same = evolution.recoded(table, spark.createDataFrame([], ddl), "code", "list", 6)
    assert Counter((r.i, r.code, r.weight) for r in same.collect()) == Counter((i, c, 1.0) for i, (c, _) in enumerate(rows))
    assert evolution.mapping_faults(spark.createDataFrame(mapping, ddl)).count() == 0


def test_faults_of_a_mapping(spark):
    rows = [(1, "a", "b", 0.5), (1, "a", "c", 0.4), (1, "b", None, 1.0), (2, "c", "d", 1.0), (2, "c", "d", 1.0), (3, None, "x", 1.0)]
    found = evolution.mapping_faults(spark.createDataFrame(rows, "version int, old string, new string, weight double"))
    assert {(r.version, r.old, r.fault) for r in found.collect()} == {(1, "a", "weights"), (1, "b", "open"), (3, None, "open")}
