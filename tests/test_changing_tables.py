"""Histories, reconciliation, layers and streams against brute force."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reviewlab.catalog import data_queries
from reviewlab.operators import deltas, history, reconcile
from reviewlab.streaming import scoring

START = datetime(2024, 1, 1)
CHANGES = "k int, at timestamp_ntz, order bigint, removed boolean, a string, b int"


def day(n):
    return START + timedelta(days=n)


def plain_history(changes, keys=range(8), days=40):
    """What holds on each day, then days of the same state together."""
    rows = []
    for k in keys:
        state, since = None, None
        for d in range(days):
            told = [(o or 0, bool(gone), (a, b)) for kk, at, o, gone, a, b in changes if kk == k and at == day(d)]
            if not told:
                continue
            _, gone, new = max(told, key=lambda t: (t[0], t[1], tuple((x is not None, x) for x in t[2])))
            new = None if gone else new
            if new != state:
                if state is not None:
                    rows.append((k, since, day(d), *state))
                state, since = new, day(d)
        if state is not None:
            rows.append((k, since, None, *state))
    return Counter(rows)


def made_changes(seed):
    rng = random.Random(seed)
    rows = [
        (rng.randrange(8), day(rng.randrange(40)), i, rng.random() < 0.2, rng.choice(["x", "y", None]), rng.choice([1, 2, None]))
        for i in range(150)
    ]
    return rows + rows[:20]


@pytest.mark.parametrize("seed", [1, 2])
def test_history_is_what_holds_each_day(spark, seed):
    rows = made_changes(seed)
    table = spark.createDataFrame([*rows, (None, day(1), 1, False, "x", 1), (1, None, 1, False, "x", 1)], CHANGES)
    found = history.intervals(table.repartition(5), "k", ["a", "b"])
    assert Counter(tuple(r) for r in found.collect()) == plain_history(rows)
    assert history.intervals(table.where("false"), "k", ["a", "b"]).count() == 0


def test_later_changes_touch_only_their_keys(spark):
    rows = [r for r in made_changes(3) if r[0] < 4]
    first = history.intervals(spark.createDataFrame(rows, CHANGES), "k", ["a", "b"])
    more = [(2, day(50), 1, False, "z", 9), (2, day(60), 2, True, None, None), (6, day(-3), 3, False, "new", None)]
    found = history.applied(first, spark.createDataFrame(more, CHANGES), "k", ["a", "b"])
    want = history.intervals(spark.createDataFrame(rows + more, CHANGES), "k", ["a", "b"])
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, want.collect()))
    told = history.intervals(history.changes_of(first, "k", ["a", "b"]), "k", ["a", "b"])
    assert Counter(map(tuple, told.collect())) == Counter(map(tuple, first.collect()))


def test_late_changes_cut_stretches(spark):
    first = history.intervals(spark.createDataFrame([(1, day(0), 1, False, "x", 1), (1, day(20), 2, False, "y", 1)], CHANGES), "k", ["a", "b"])
    late = spark.createDataFrame([(1, day(5), None, False, "w", 1), (1, day(20), None, False, "v", 1)], CHANGES)
    found = sorted(tuple(r) for r in history.applied(first, late, "k", ["a", "b"]).collect())
    assert found == [(1, day(0), day(5), "x", 1), (1, day(5), day(20), "w", 1), (1, day(20), None, "v", 1)]


def test_a_key_becomes_two_and_facts_see_their_time(spark):
    rows = [(1, day(0), 1, False, "x", 1), (1, day(20), 2, False, "y", 2), (5, day(0), 1, False, "z", 3)]
    known = history.intervals(spark.createDataFrame(rows, CHANGES), "k", ["a", "b"])
    cuts = spark.createDataFrame([(1, day(10), 11), (1, day(10), 12), (7, day(3), 13)], "k int, at timestamp_ntz, into int")
    parted = history.split(known, cuts, "k", ["a", "b"])
    assert sorted(map(str, map(tuple, parted.collect()))) == sorted(
        map(str, [(1, day(0), day(10), "x", 1), (5, day(0), None, "z", 3)]
            + [(k, *r) for k in (11, 12) for r in ((day(10), day(20), "x", 1), (day(20), None, "y", 2))])
    )
    facts = spark.createDataFrame([(1, day(9)), (1, day(10)), (11, day(10)), (12, day(30)), (None, day(1)), (5, None)], "k int, t timestamp_ntz")
    seen = history.as_of(facts, parted, "k", "t", "k").collect()
    assert Counter((r.k, r.t, r.a) for r in seen) == Counter(
        [(1, day(9), "x"), (1, day(10), None), (11, day(10), "x"), (12, day(30), "y"), (None, day(1), None), (5, None, None)]
    )


def plain_matches(ours, theirs, days, share):
    pairs = []
    for i, k, d, x in ours:
        for j, kk, e, y in theirs:
            if None in (k, d, x, kk, e, y) or k != kk:
                continue
            most = max(abs(x), abs(y))
            gap = (e - d).days
            if abs(gap) <= days and abs(y - x) <= most * share:
                residual = abs(gap) / (days + 1.0) + (abs(y - x) / (most * share) if most else 0.0)
                pairs.append((round(residual, 9), i, j))
    left, right, found = set(), set(), set()
    for _, i, j in sorted(pairs):
        if i not in left and j not in right:
            left.add(i), right.add(j), found.add((i, j))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_each_line_gets_its_best_free_partner(spark, seed):
    rng = random.Random(seed)
    schema = "id string, k int, day date, amount double"

    def report(name, n):
        rows = [(f"{name}{i:03}", rng.randrange(4), (day(rng.randrange(25))).date(), rng.choice([0.0, 10.0, 10.1, 10.2, -5.0, 200.0])) for i in range(n)]
        return rows + [(f"{name}x", None, day(1).date(), 1.0), (f"{name}y", 1, None, 1.0), (f"{name}z", 1, day(1).date(), None)]

    ours, theirs = report("a", 90), report("b", 110)
    a, b = spark.createDataFrame(ours, schema), spark.createDataFrame(theirs, schema)
    found = reconcile.reconciled(a, b, ["k"], days=3, share=0.02).collect()
    want = plain_matches(ours, theirs, 3, 0.02)
    assert {(r.left_id, r.right_id) for r in found if r.status in ("exact", "within")} == want
    assert Counter(r.left_id for r in found if r.left_id) == Counter(r[0] for r in ours)
    assert Counter(r.right_id for r in found if r.right_id) == Counter(r[0] for r in theirs)
    assert all((r.status == "exact") == (r.day_gap == 0 and r.amount_gap == 0) for r in found if r.residual is not None)
    nobody = reconcile.reconciled(a.where("false"), b, ["k"], days=3, share=0.02).collect()
    assert len(nobody) == len(theirs) and {r.status for r in nobody} == {"right_only"}


def test_layers_follow_changes_and_rewrite_touched_parts_only(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(12), rng.randrange(30)) for _ in range(200)] + [(None, 3), (99, None)]
    path = str(tmp_path / "layer")
    table = spark.createDataFrame(rows, "k int, v bigint")
    deltas.update_layer(spark, path, deltas.weighted(table), ["k"], "v", parts=8)
    # The smallest of key 1 goes, key 2 goes as a whole, a row of key 3 comes twice.
    least = min(v for k, v in rows if k == 1)
    after = [r for r in rows if r[0] != 2 and r != (1, least)] + [(3, 7), (3, 7)]
    before = {p: [(f.name, f.stat().st_mtime_ns) for f in p.iterdir()] for p in (tmp_path / "layer").glob("part=*")}
    change = deltas.difference(table, spark.createDataFrame(after, "k int, v bigint"))
    touched = deltas.update_layer(spark, path, change, ["k"], "v", parts=8)
    for p, files in before.items():
        same = files == [(f.name, f.stat().st_mtime_ns) for f in p.iterdir()]
        assert same == (int(p.name[5:]) not in touched)
    found = {r.k: (r.row_count, r.total, r.least, r.largest) for r in deltas.summary(deltas.layer(spark, path), ["k"], "v").collect()}
    want = {}
    for k in {k for k, _ in after}:
        own = [v for kk, v in after if kk == k]
        real = [v for v in own if v is not None]
        want[k] = (len(own), sum(real) if real else None, min(real, default=None), max(real, default=None))
    assert found == want
    assert deltas.negative(deltas.layer(spark, path)).isEmpty()
    assert deltas.update_layer(spark, path, change.where("false"), ["k"], "v", parts=8) == []


def test_changes_of_a_join_are_those_of_its_results(spark):
    rng = random.Random(5)
    tables = [[(rng.randrange(6), rng.randrange(3)) for _ in range(40)] for _ in range(4)]
    a, b, c, d = (spark.createDataFrame(t, f"k int, {n} int") for t, n in zip(tables, "xyxy"))
    change = deltas.joined(deltas.weighted(a), deltas.difference(a, c), deltas.weighted(b), deltas.difference(b, d), ["k"])
    want = deltas.difference(a.join(b, "k"), c.join(d, "k"))
    columns = ["k", "x", "y", "weight"]
    assert Counter(map(tuple, deltas.compacted(change).select(columns).collect())) == Counter(map(tuple, want.select(columns).collect()))


class Identity:
    """A model that scores by length."""

    def transform(self, df):
        return df.withColumn("score", F.length("text"))


def test_a_killed_batch_is_written_once(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / x) for x in ("in", "out", "progress"))
    rows = spark.range(60).select(
        "id", F.concat(F.lit("text "), F.col("id")).alias("text"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("at")
    )
    rows.where("id < 30").repartition(3).write.parquet(f"{source}/one")
    write, died = scoring.batch_writer(sink), []

    def dies_once(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not died:
            died.append(batch_id)
            raise RuntimeError("killed after writing, before the commit")

    def run():
        scoring.score_available(
            spark, source, rows.schema, Identity(), sink, checkpoint, key="id", at="at", late="30 days", files_per_batch=1, write=dies_once
        )

    with pytest.raises(Exception, match="killed after writing"):
        run()
    # Another delivery, with rows that came before.
    rows.where("id >= 20").write.parquet(f"{source}/two")
    run()
    run()
    found = spark.read.parquet(sink).collect()
    assert died == [1] and Counter(r.id for r in found) == Counter(range(60))
    assert all(r.score == len(r.text) for r in found)


def test_lines_look_into_few_buckets_and_matches_are_stored_once(spark, monkeypatch):
    stored, real = [], reconcile.stage
    monkeypatch.setattr(reconcile, "stage", lambda df, name: stored.append(name) or real(df, name))
    # A chain: each line's best partner is taken by the one before, so there are many rounds.
    days = "id string, k int, amount double, d int"
    left = spark.createDataFrame([("a0", 1, 1000.0, 0), ("a1", 1, 1009.0, 0), ("a2", 1, 1014.0, 0)], days)
    right = spark.createDataFrame([("b0", 1, 1005.0, 0), ("b1", 1, 1012.0, 0), ("b2", 1, 1015.0, 0)], days)
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("d")).alias("day")
    left, right = (x.select("id", "k", "amount", day) for x in (left, right))
    found = reconcile.reconciled(left, right, ["k"], days=3, share=0.02).where("status <> 'left_only' and status <> 'right_only'")
    assert {(r["left_id"], r["right_id"]) for r in found.collect()} == {("a0", "b0"), ("a1", "b1"), ("a2", "b2")}
    assert stored.count("mutual") == 3 and stored.count("matched") == 1
    many = spark.range(1000).select(
        F.concat(F.lit("a"), "id").alias("id"), F.lit(1).alias("k"), F.col("id").cast("double").alias("amount"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
    )
    looked = []
    explode = F.explode
    monkeypatch.setattr(reconcile.F, "explode", lambda c: looked.append(c) or explode(c))
    reconcile.candidates(many, many, ["k"], days=3, share=0.02)
    side = many.select(F.datediff("day", F.lit("1970-01-01").cast("date")).alias("left_day"))
    assert side.select(F.size(looked[0]).alias("n")).agg(F.avg("n")).first()[0] < 1.5


def test_a_delivery_has_a_bounded_number_of_files_and_all_rows(spark, tmp_path):
    rows = spark.range(0, 500, 1, 40)
    data_queries.deliver(rows.unionByName(rows.where("id < 7")), str(tmp_path / "run"))
    assert len(list((tmp_path / "run").glob("part-*"))) <= data_queries.DELIVERY_FILES
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "run")).collect()) == sorted([*range(500), *range(7)])


def test_lines_are_reconciled_in_slices_with_the_same_result(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    rows = []
    for i in range(150):
        part, supplier, date = rng.choice([1, 2, 3, 4, 5, None]), rng.choice([1, 2, 3, None]), datetime(1995, 1, 1 + rng.randrange(9))
        rows.append((rng.randrange(1, 40), 1, part, supplier, date, rng.choice([1000.0, 1010.0, 990.0]), 1.0))
    # One name of three lines with two parts: "1-1-2-19950101-1".
    rows += [(1, 1, 2, None, datetime(1995, 1, 1), 1000.0, 1.0), (1, 1, None, 2, datetime(1995, 1, 1), 1000.0, 1.0), (1, None, 1, 2, datetime(1995, 1, 1), 1000.0, 1.0)]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double, l_quantity double"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    stored, real = [], data_queries.stage
    monkeypatch.setattr(data_queries, "stage", lambda df, name, *a, **o: stored.append(name) or real(df, name, *a, **o))
    whole = Counter(map(tuple, data_queries.reconcile_lines(spark, str(tmp_path)).collect()))
    assert stored.count("reconciled") == 1 and "tied" not in stored
    monkeypatch.setattr(data_queries, "SLICE_LINES", 50)
    assert Counter(map(tuple, data_queries.reconcile_lines(spark, str(tmp_path)).collect())) == whole
    assert stored.count("reconciled") == 5
