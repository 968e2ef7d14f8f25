"""Bootstrap and paired test against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from reviewlab.operators import models, significance

DDL = "key string, one boolean, two boolean, replicate int"


def made(seed, n=150):
    rng = random.Random(seed)
    rows = [(rng.choice([None, "", *(f"k{i}" for i in range(n))]), rng.choice([True, True, False, None]), rng.choice([True, False]), i) for i in range(n)]
    return rows + [("hot", True, False, 0)] * (n // 3)


def times(key, replicate):
    told = hashlib.md5(f"11:{replicate // 4}:{key or ''}".encode()).hexdigest()
    share = int(told[replicate % 4 * 8 :][:8], 16) / 2**32
    k, below = 0, math.exp(-1)
    while share >= below:
        k += 1
        below += math.exp(-1) / math.factorial(k)
    return k


def plainly(rows, replicates):
    def percents(weights):
        n = sum(weights)
        one, two = (sum(w for w, r in zip(weights, rows) if r[c]) for c in (1, 2))
        return (one * 100 / n, two * 100 / n, (one - two) * 100 / n)

    seen = percents([1] * len(rows))
    drawn = list(zip(*[percents([times(r[0], i) for r in rows]) for i in range(replicates)]))
    x, y = sum(bool(r[1]) and not r[2] for r in rows), sum(bool(r[2]) and not r[1] for r in rows)
    found = {}
    for name, value, values in zip(("one", "two", "difference"), seen, drawn):
        values, cut = sorted(values), replicates * 5 // 200
        sign = (value > 0) - (value < 0)
        gap = name == "difference"
        opposite = sum(v * sign <= 0 for v in values) / replicates if gap else None
        square = max(abs(x - y) - 1, 0) ** 2 / (x + y) if gap and x + y else None
        found[name] = (value, values[cut], values[-1 - cut], opposite, square, len(rows))
    return found


@pytest.mark.parametrize("seed,replicates", [(1, 50), (2, 101), (3, 1)])
def test_intervals_by_brute_force(spark, seed, replicates):
    rows = made(seed)
    df = spark.createDataFrame(rows, DDL).repartition(5)
    found = {r["measure"]: tuple(r)[1:] for r in significance.compared(df, "key", "one", "two", replicates=replicates).collect()}
    want = plainly(rows, replicates)
    assert set(found) == set(want)
    for name, values in want.items():
        assert found[name] == pytest.approx(values)


def test_counts_are_poisson_of_mean_one(spark):
    df = spark.range(2000).selectExpr("cast(id as string) key", "true one", "false two")
    drawn = significance.replicated(df, "key", "one", "two", replicates=40).where("replicate >= 0").collect()
    assert len(drawn) == 40 and all(r["n"] == r["first"] == r["only_first"] and r["second"] == 0 for r in drawn)
    n = [r["n"] for r in drawn]
    mean = sum(n) / 40
    assert abs(mean - 2000) < 4 * math.sqrt(2000 / 40)
    assert 0.4 < sum((v - mean) ** 2 for v in n) / 39 / 2000 < 2


def test_equal_classifiers_and_no_rows(spark):
    same = spark.createDataFrame([(str(i), i % 3 > 0, i % 3 > 0, 0) for i in range(30)], DDL)
    gap = significance.compared(same, "key", "one", "two", replicates=20).where("measure = 'difference'").first()
    assert (gap["value"], gap["low"], gap["high"], gap["opposite"], gap["mcnemar"]) == (0, 0, 0, 1, None)
    none = significance.compared(same.limit(0), "key", "one", "two", replicates=20).collect()
    assert [tuple(r)[1:] for r in none] == [(None,) * 5 + (0,)] * 3


def test_forest_and_boosted_trees_on_the_same_test_rows(spark):
    """Learned from what a line cannot divide: trees are better, and the test says so."""
    from pyspark.ml.linalg import Vectors

    rng = random.Random(4)
    points = [(i, rng.random(), rng.random()) for i in range(600)]
    rows = spark.createDataFrame([(i, float((x > 0.5) != (y > 0.5)), Vectors.dense(x, y)) for i, x, y in points], ["review_id", "label", "features"])
    _, test = models.split_by_key(rows, "review_id")
    right = test.select("review_id")
    for name in ("LogisticRegression", "Forest", "BoostedTrees"):
        result, model = models.train_and_score(name, rows, "points", parallelism=2)
        assert result.accuracy > (85 if name != "LogisticRegression" else 30)
        scored = model.transform(test).selectExpr("review_id", f"prediction = label as {name}")
        right = right.join(scored, "review_id")
        assert models.grid_rows(spark, model).count() == 3
    told = significance.compared(right, "review_id", "Forest", "LogisticRegression", replicates=200)
    gap = told.where("measure = 'difference'").first()
    assert gap["low"] > 10 and gap["opposite"] == 0 and gap["mcnemar"] > 3.84
