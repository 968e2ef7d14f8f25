"""Declared rules against brute force."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pytest

from reviewlab.operators import rules

DDL = "k bigint, part int, v double, at timestamp_ntz, rule string"
RULES = [
    rules.Unique("key", ("k", "part")),
    rules.ForeignKey("known", ("k",), "other", ("id",)),
    rules.NotNull("given", "v"),
    rules.Range("between", "v", 1.0, 5.0),
    rules.Range("open", "v", most=6.0),
    rules.Condition("cond", "v > part"),
    rules.Share("half", "v >= 3", 0.5),
    rules.Share("most", "v >= 3", 0.9),
    rules.Fresh("fresh", "at", datetime(2024, 1, 5)),
    rules.Fresh("old", "at", datetime(2030, 1, 5)),
]


def made(seed, n=300):
    rng = random.Random(seed)
    return [
        (7 if i % 3 == 0 else rng.choice([None, *range(60)]), rng.randrange(4), rng.choice([None, 0.5, 1.0, 3.0, 5.0, 7.0]), datetime(2024, 1, rng.randint(1, 9)), "r")
        for i in range(n)
    ]


def plain_verdicts(rows, ids):
    keys = Counter((k, p) for k, p, *_ in rows if k is not None)
    n, held = len(rows), sum(v is not None and v >= 3 for _, _, v, *_ in rows)
    latest = max((at for *_, at, _ in rows), default=None)
    found = {
        "key": (sum(keys.values()), sum(c for c in keys.values() if c > 1)),
        "known": (sum(r[0] is not None for r in rows), sum(r[0] is not None and r[0] not in ids for r in rows)),
        "given": (n, sum(r[2] is None for r in rows)),
        "between": (n, sum(r[2] is not None and not 1 <= r[2] <= 5 for r in rows)),
        "open": (n, sum(r[2] is not None and r[2] > 6 for r in rows)),
        "cond": (n, sum(r[2] is None or not r[2] > r[1] for r in rows)),
        "half": (n, 0 if n and held >= 0.5 * n else max(n - held, 1)),
        "most": (n, 0 if n and held >= 0.9 * n else max(n - held, 1)),
        "fresh": (n, int(latest is None or latest < datetime(2024, 1, 5))),
        "old": (n, int(latest is None or latest < datetime(2030, 1, 5))),
    }
    return {name: (*both, both[1] == 0) for name, both in found.items()}


@pytest.mark.parametrize("n", [0, 1, 300])
def test_verdicts(spark, n):
    rows, ids = made(n, n), [*range(0, 60, 2), 7, 7, None]
    tables = {"t": spark.createDataFrame(rows, DDL), "other": spark.createDataFrame([(i,) for i in ids], "id bigint")}
    found = rules.verdicts(tables, {"t": RULES}).collect()
    assert {r.rule: (r.checked, r.failed, r.passed) for r in found} == plain_verdicts(rows, set(ids))
    assert len(found) == len(RULES)


def test_a_share_is_exact(spark):
    table = spark.range(30)
    (row,) = rules.verdicts({"t": table}, {"t": [rules.Share("tenth", "id < 3", 0.1)]}).collect()
    assert row.passed and row.failed == 0


def test_rows_that_break_rules_are_set_apart(spark):
    rows = made(5) + made(5)[:10]
    found = rules.quarantined(spark.createDataFrame(rows, DDL), RULES).collect()
    want = Counter()
    for row in rows:
        v = row[2]
        broken = ["given"] * (v is None) + ["between"] * (v is not None and not 1 <= v <= 5) + ["open"] * (v is not None and v > 6)
        broken += ["cond"] * (v is None or not v > row[1])
        if broken:
            want[(*row, tuple(broken))] += 1
    assert Counter((*r[:5], tuple(r.broken)) for r in found) == want
    assert rules.quarantined(spark.createDataFrame(rows, DDL), RULES[:2]).count() == 0


def test_rules_of_one_name_are_refused(spark):
    with pytest.raises(ValueError):
        rules.verdicts({"t": spark.createDataFrame([], DDL)}, {"t": [RULES[2], RULES[2]]})


def test_one_pass_for_all_rules_on_rows(spark, tmp_path):
    spark.createDataFrame(made(1), DDL).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = rules.verdicts({"t": table}, {"t": [r for r in RULES if isinstance(r, rules.ON_ROWS)]})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan
