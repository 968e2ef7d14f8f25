"""One value may hold a third of all rows: results stay whole, and it stays one row per task."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlab.contracts import REVIEWS
from reviewlab.functions import text
from reviewlab.operators import audit, features, hygiene
from reviewlab.plans import featurize
from reviewlab.sources import manifest

ROWS = 3000


@pytest.fixture(scope="module")
def hot(spark):
    """Every third row is the same text under the same bad label."""
    same = F.col("id") % 3 == 0
    label = F.when(same, "junk").when(F.col("id") % 3 == 1, "positive").otherwise("negative")
    body = F.when(same, "copied words\nnao sei").otherwise(F.concat(F.lit("word no "), "id"))
    return spark.range(0, ROWS, 1, 6).select(
        F.col("id").alias("review_id"), body.alias("review"), label.alias("sentiment")
    )


def exchanged(spark, df) -> int:
    """Rows the largest exchange of a finished plan wrote."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.metrics().contains("shuffleRecordsWritten"):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return max(found)


def test_bad_label(spark, hot):
    found = REVIEWS.domain_violations(hot, "sentiment")
    assert [tuple(r) for r in found.collect()] == [("sentiment", "junk", ROWS // 3)]
    assert exchanged(spark, REVIEWS.domain_violations(hot, "sentiment")) == 6


def test_counts(spark, hot):
    balance = audit.class_balance(hot)
    assert dict(balance.collect()) == dict.fromkeys(("junk", "positive", "negative"), ROWS // 3)
    assert exchanged(spark, audit.class_balance(hot)) == 3 * 6


def test_words(spark, hot):
    words = hot.select(text.content_words(text.clean_text(F.col("review"))).alias("filtered"))
    third = ROWS // 3
    assert Counter(dict(features.word_counts(words).collect())) == {
        "copied": third,
        "wordsnao": third,
        "sei": third,
        "word": 2 * third,
    }
    assert exchanged(spark, features.word_counts(words)) <= 4 * 6


def test_findings(spark, hot):
    found = hygiene.scan_lines(hot, ["review_id"], "review")
    assert {(r["line_no"], r["kind"]) for r in found.collect()} == {(2, "keyword")}
    assert dict(hygiene.summary(found).collect()) == {"keyword": ROWS // 3}
    assert exchanged(spark, hygiene.summary(found)) == 6


def test_copies_stay_apart_by_key(spark, hot):
    good = hot.withColumn("sentiment", F.regexp_replace("sentiment", "junk", "positive"))
    tokens = featurize.tokens_of(good)
    assert tokens.table.count() == ROWS
    assert tokens.label_index.labels == ["positive", "negative"]
    seen = manifest.record_manifest(good, F.col("review_id"), F.col("review"))
    assert manifest.pending(seen, seen.where(F.col("path") != "0")).count() == 1
