from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from reviewlab import sinks
from reviewlab.config import ConfigError, RunConfig, resolve
from reviewlab.contracts import REVIEW_SCHEMA, REVIEWS, ContractError
from reviewlab.operators import audit

DDL = "review string, sentiment string"
# Of eight rows, two lack the text, one the label, and one both.
ROWS = [(f"text {i}", "positive") for i in range(4)]
ROWS += [(None, "negative"), (None, "positive"), ("unlabelled", None), (None, None)]


def test_contract_is_fixed():
    assert REVIEWS.required == frozenset(REVIEW_SCHEMA.names)
    assert isinstance(REVIEWS.allowed["sentiment"], frozenset)
    with pytest.raises(AttributeError):
        REVIEWS.required = frozenset()


def test_good_table_passes(spark):
    REVIEWS.check(spark.createDataFrame([("a", "positive"), ("b", "negative")], DDL))


def test_missing_column(spark):
    df = spark.createDataFrame([("a",)], "review string")
    with pytest.raises(ContractError, match="no column sentiment among review") as caught:
        REVIEWS.check(df)
    assert caught.value.missing == ("sentiment",) and caught.value.violations is None


def test_bad_and_null_labels_are_violations_together(spark):
    df = spark.createDataFrame([("a", "neutral"), ("b", None), ("c", "neutral")], DDL)
    with pytest.raises(ContractError, match="3 rows of 'sentiment' hold 2 values") as caught:
        REVIEWS.check(df)
    found = {tuple(r) for r in caught.value.violations.collect()}
    assert found == {("sentiment", "neutral", 2), ("sentiment", None, 1)}


@pytest.mark.parametrize("n", [1, 50, 3000])
def test_all_violations_are_kept_whatever_their_number(spark, n):
    df = spark.range(n).selectExpr("'x' as review", "concat('label ', id) as sentiment")
    with pytest.raises(ContractError) as caught:
        REVIEWS.check(df)
    assert caught.value.violations.count() == n


def test_null_report(spark):
    df = spark.createDataFrame(ROWS, DDL).withColumn("full", F.lit(1))
    rows = audit.null_report(df).collect()
    assert {r["column_name"]: (r["null_count"], r["null_pct"]) for r in rows} == {
        "review": (3, 37.5),
        "sentiment": (2, 25.0),
    }
    clean = spark.createDataFrame([("a", "positive")], DDL)
    assert audit.null_report(clean).collect() == []
    assert audit.null_report(spark.createDataFrame([], DDL)).collect() == []


def test_drop_and_count(spark):
    df = spark.createDataFrame(ROWS, DDL)
    assert sorted(tuple(r) for r in audit.drop_nulls(df).collect()) == ROWS[:4]
    assert audit.row_counts(df).first().asDict() == {
        "rows_before": 8,
        "rows_after": 4,
        "rows_dropped": 4,
    }


def test_counts_in_one_pass(spark):
    df = spark.createDataFrame([*ROWS, ("x", "neutral"), ("y", "negative")], DDL)
    named = audit.counts(["review", "sentiment"], {"sentiment": ["negative", "positive"]})
    assert audit.one_row(df, named).first().asDict() == {
        "rows": 10,
        "complete": 6,
        "nulls.review": 3,
        "nulls.sentiment": 2,
        "other.sentiment": 1,
        "class.sentiment.negative": 1,
        "class.sentiment.positive": 4,
    }


def test_audit_rows_carry_the_run(spark):
    df = spark.createDataFrame(ROWS, DDL)
    named = audit.counts(["review"])
    got = {tuple(r) for r in audit.audit_rows(df, named, "r1").collect()}
    assert got == {
        ("r1", "rows", "", 8.0),
        ("r1", "complete", "", 5.0),
        ("r1", "nulls", "review", 3.0),
    }
    measured = audit.one_row(df, named).first().asDict()
    assert {tuple(r) for r in audit.audit_of(spark, measured, "r1").collect()} == got


def test_audit_accumulates_as_json_lines(spark, tmp_path):
    config = RunConfig("in", str(tmp_path / "out"), "r1", persist=True)
    for run_id in ("r1", "r2"):
        sinks.append_audit(audit.audit_of(spark, {"rows": 3}, run_id), config)
    back = audit.read_audit(spark, config.audit_path)
    assert back.schema == audit.AUDIT_SCHEMA
    assert {tuple(r) for r in back.collect()} == {("r1", "rows", "", 3.0), ("r2", "rows", "", 3.0)}
    lines = [
        json.loads(line)
        for part in (tmp_path / "out" / "audit").glob("part-*")
        for line in part.read_text().splitlines()
    ]
    assert sorted(line["run_id"] for line in lines) == ["r1", "r2"]


def test_class_balance(spark):
    df = spark.createDataFrame([("a", "positive"), ("b", "positive"), ("c", "negative")], DDL)
    assert dict(audit.class_balance(df).collect()) == {"positive": 2, "negative": 1}


def test_one_scan_for_all_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS, DDL).write.parquet(path)
    named = audit.counts(["review", "sentiment"], {"sentiment": ["positive"]})
    plan = audit.one_row(spark.read.parquet(path), named)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("FileScan") == 1


def test_settings():
    config = RunConfig("s3://b/raw/", "s3://b/out/", "r", persist=True)
    assert config.features_root == "s3://b/out/features"
    assert config.models_root == "s3://b/out/models"
    with pytest.raises(AttributeError):
        config.run_id = "other"
    with pytest.raises(TypeError):
        RunConfig("only-input")
    with pytest.raises(ConfigError, match="input_path"):
        resolve(None, "out", "r", env={})
    assert resolve(None, None, "r", env={"REVIEWLAB_INPUT": "i", "REVIEWLAB_OUTPUT": "o"}) == (
        RunConfig("i", "o", "r", persist=True)
    )


def test_violations_are_filtered_before_the_exchange(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "positive")], DDL).write.parquet(path)
    df = REVIEWS.domain_violations(spark.read.parquet(path), "sentiment")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<sentiment:string>" in plan
    assert plan.index("Exchange") < plan.index("Filter")  # printed top down
    assert df.select(F.sum("row_count")).first()[0] is None
