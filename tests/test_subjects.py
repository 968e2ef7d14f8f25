"""Subject access and erasure against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from reviewlab.operators import erasure, subjects
from reviewlab.operators.subjects import InColumn, InText, Source

MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
SOURCES = (
    Source("people", ("id",), (InColumn("person", "id"), InColumn("mail", "mail"), InColumn("town", "town", ends=True))),
    Source("notes", ("id", "part"), (InText("mail", "text", MAIL, fold=True), InText("phone", "text", r"\+[0-9][0-9 -]{4,}[0-9]", drop="[ -]"))),
)


def made(seed):
    rng = random.Random(seed)
    people = [(i, rng.choice([None, "", f"m{rng.randrange(12)}@x.org"]), rng.choice([None, "Ulm", "Bern"])) for i in range(25)]
    notes = [(rng.randrange(30), rng.randrange(2), None if rng.random() < 0.1 else " ".join(
        rng.choice([f"M{rng.randrange(12)}@x.org.", f"+49 {rng.randrange(10)}-55{rng.randrange(3)} 7", "word", ""]) for _ in range(rng.randrange(4)))) for _ in range(45)]
    return people, notes


def said_plainly(people, notes):
    found = set()
    for i, mail, town in people:
        found.add(("people", str(i), "person", str(i), False))
        found |= {("people", str(i), "mail", mail, False)} if mail else set()
        found |= {("people", str(i), "town", town, True)} if town else set()
    for i, part, text in notes:
        row = f"{i}/{part}"
        found |= {("notes", row, "mail", m.lower(), False) for m in re.findall(MAIL, text or "")}
        found |= {("notes", row, "phone", re.sub("[ -]", "", m), False) for m in re.findall(r"\+[0-9][0-9 -]{4,}[0-9]", text or "")}
    return found


def reached_plainly(said, request, kind, identifier):
    """Breadth first, one subject at a time."""
    paths, ends = {(kind, identifier): (0, f"{kind}:{identifier}")}, {}
    level = {(kind, identifier)}
    depth = 0
    while level:
        depth += 1
        best = {}
        for table, row, k, i, _ in said:
            if (k, i) in level and not ends.get((k, i), False):
                for t, r, k2, i2, e2 in said:
                    if (t, r) == (table, row) and (k2, i2) not in paths:
                        path = f"{paths[k, i][1]} > {table}:{row} > {k2}:{i2}"
                        best[k2, i2] = min(best.get((k2, i2), path), path)
                        ends[k2, i2] = e2
        paths |= {n: (depth, p) for n, p in best.items()}
        level = set(best)
    follows = {n: v for n, v in paths.items() if not ends.get(n, False)}
    rows = {}
    for table, row, k, i, _ in said:
        if (k, i) in follows:
            depth, path = follows[k, i]
            new = (depth, f"{path} > {table}:{row}")
            rows[table, row] = min(rows.get((table, row), new), new)
    return {(request, *n, *v) for n, v in paths.items()}, {(request, *n, *v) for n, v in rows.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_by_brute_force(spark, seed):
    people, notes = made(seed)
    tables = {
        "people": spark.createDataFrame(people, "id long, mail string, town string"),
        "notes": spark.createDataFrame(notes, "id long, part int, text string"),
    }
    said = subjects.mentions(tables, SOURCES)
    want = said_plainly(people, notes)
    assert {tuple(r) for r in said.collect()} == want and said.count() == len(want)
    asked = [(f"r{i}", "person", str(i)) for i in range(0, 25, 4)] + [("mail", "mail", "m3@x.org"), ("none", "mail", "nobody@x.org"), ("town", "town", "Ulm")]
    reached = subjects.closure(said, spark.createDataFrame(asked + asked[:2], "request string, kind string, identifier string"))
    identifiers, rows = set(), set()
    for request in asked:
        one = reached_plainly(want, *request)
        identifiers |= one[0]
        rows |= one[1]
    got = [tuple(r) for r in reached.select("request", "kind", "identifier", "depth", "path").collect()]
    assert sorted(got) == sorted(identifiers)
    assert sorted(tuple(r) for r in subjects.rows_of(said, reached).collect()) == sorted(rows)


def test_no_rows_and_no_requests(spark):
    tables = {"people": spark.createDataFrame([], "id long, mail string, town string"), "notes": spark.createDataFrame([], "id long, part int, text string")}
    said = subjects.mentions(tables, SOURCES)
    none = spark.createDataFrame([], "request string, kind string, identifier string")
    assert subjects.rows_of(said, subjects.closure(said, none)).isEmpty()


@pytest.mark.parametrize("numbers", [True, False])
def test_rows_are_marked_by_how_many_identifiers_they_have(spark, numbers):
    """Repeated rows of one key are one row, with null keys and with keys that are texts, too."""
    kind = "long" if numbers else "string"
    put = (lambda v: v) if numbers else (lambda v: None if v is None else str(v))
    tables = {
        "lines": spark.createDataFrame([(put(o), put(n)) for o, n in [(1, 1), (1, 1), (1, 2), (2, None), (None, 3)]], f"o {kind}, n {kind}"),
        "visits": spark.createDataFrame([(put(i), put(o)) for i, o in [(1, 1), (1, 2), (2, 2), (2, 2), (3, None), (None, 1)]], f"i {kind}, o {kind}"),
    }
    sources = (Source("lines", ("o", "n"), (InColumn("order", "o"),)), Source("visits", ("i",), (InColumn("order", "o"),)))
    want = {
        ("lines", "1/1", "1", False), ("lines", "1/2", "1", False), ("lines", "2/", "2", False),
        ("visits", "1", "1", True), ("visits", "1", "2", True), ("visits", "2", "2", False), ("visits", "", "1", False),
    }
    said = subjects.mentions(tables, sources, mark=True)
    assert sorted(tuple(r) for r in said.select("table", "row", "identifier", "several").collect()) == sorted(want)
    plain = subjects.mentions(tables, sources)
    requests = spark.createDataFrame([("a", "order", "1"), ("b", "order", "2")], "request string, kind string, identifier string")
    told = [sorted(tuple(r) for r in subjects.rows_of(s, subjects.closure(s, requests)).collect()) for s in (said, plain)]
    assert told[0] == told[1] and len(told[0]) == 12


# --- erasure -----------------------------------------------------------------------------------

ROWS = [(i, None if i % 17 == 0 else i // 10, f"text {i}") for i in range(400)] + [(7, 0, "text 7")]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.createDataFrame(ROWS, "n long, who long, text string").repartitionByRange(8, "n").write.parquet(path)
    return path


def digests(path):
    return {f: hashlib.sha256(f.read_bytes()).hexdigest() for f in Path(path).rglob("*.parquet")}


def rows_in(spark, path):
    return Counter(tuple(r) for r in erasure.read(spark, path).select("n", "who", "text").collect())


def asked(spark, *who):
    return spark.createDataFrame([(w,) for w in who], "who long")


def test_only_files_that_hold_a_subject_change(spark, stored, tmp_path):
    before = digests(stored)
    index = erasure.file_index(erasure.read(spark, stored), "who")
    assert index.groupBy("file").count().count() == 8
    found = erasure.erase(spark, stored, "who", asked(spark, 0, 3, 3, 999, None), str(tmp_path / "log"), "r1", salt="s", index=index)
    gone = Counter(who for _, who, _ in ROWS if who in (0, 3))
    name = {hashlib.sha256(f"s:{w}".encode()).hexdigest(): w for w in (0, 3, 999)}
    removed = Counter()
    for row in found.collect():
        removed[name[row["subject"]]] += row["rows_removed"]
    assert removed == gone
    assert rows_in(spark, stored) == Counter(r for r in ROWS if r[1] not in (0, 3))
    after = digests(stored)
    held = {f for f in before if f in after}
    assert 5 <= len(held) < 8 and all(before[f] == after[f] for f in held)
    stones = erasure.tombstones(spark, str(tmp_path / "log"))
    assert {r["subject"] for r in stones.collect()} == set(name)
    late = spark.createDataFrame([(1, 3, "back"), (2, 4, "new"), (3, None, "null")], "n long, who long, text string")
    assert {r["n"] for r in erasure.without_erased(late, "who", stones, salt="s").collect()} == {2, 3}


def test_no_value_of_an_erased_subject_is_in_any_file(spark, stored, tmp_path):
    erasure.erase(spark, stored, "who", asked(spark, *range(0, 40, 3)), str(tmp_path / "log"), "a", salt="s")
    erasure.erase(spark, stored, "who", asked(spark, *range(1, 40, 3)), str(tmp_path / "log"), "b", salt="s")
    left = [r for r in ROWS if r[1] is None or r[1] % 3 == 2]
    assert rows_in(spark, stored) == Counter(left)
    assert erasure.tombstones(spark, str(tmp_path / "log")).count() == 27


@pytest.mark.parametrize("stop", ["_rename", "_remove_hit"])
def test_a_stopped_run_is_ended_by_its_name(spark, stored, tmp_path, monkeypatch, stop):
    """Stopped before the new files are moved in, and after some old files are removed."""
    log, kept = str(tmp_path / "log"), {"n": 0}
    plain_remove = erasure._remove

    def failing(session, path):
        if path.endswith(".parquet"):
            kept["n"] += 1
            if kept["n"] == 2:
                raise OSError("stopped")
        plain_remove(session, path)

    with monkeypatch.context() as patch:
        if stop == "_rename":
            patch.setattr(erasure, "_rename", lambda *a: False)
        else:
            patch.setattr(erasure, "_remove", failing)
        with pytest.raises(OSError):
            erasure.erase(spark, stored, "who", asked(spark, *range(0, 20)), log, "r", salt="s")
    left = Counter(r for r in ROWS if r[1] is None or r[1] >= 20)
    assert not left - rows_in(spark, stored)
    erasure.erase(spark, stored, "who", asked(spark, *range(0, 20)), log, "r", salt="s")
    assert rows_in(spark, stored) == left


def test_nothing_to_erase(spark, stored, tmp_path):
    before = digests(stored)
    for run, who in (("none", ()), ("unknown", (12345,))):
        found = erasure.erase(spark, stored, "who", asked(spark, *who), str(tmp_path / "log"), run, salt="s")
        assert found.isEmpty() and digests(stored) == before


def test_filters_rule_out_most_files_and_none_that_hold_a_subject(spark, stored):
    index = erasure.file_index(erasure.read(spark, stored), "who")
    for who in range(0, 40, 5):
        found = {r["file"] for r in erasure.suspects(index, asked(spark, who).selectExpr("cast(who as string) who")).collect()}
        read = erasure.read(spark, stored).where(f"who = {who}").select("_metadata.file_path").distinct()
        holds = {r["file_path"] for r in read.collect()}
        assert holds <= found and len(found) <= len(holds) + 1


def test_file_index_is_built_without_sorting_rows(spark, stored):
    index = erasure.file_index(erasure.read(spark, stored), "who", 3)
    value = F.col("who").cast("string")
    rows = erasure.read(spark, stored).where(value.isNotNull())
    placed = rows.select(F.col("_metadata.file_path").alias("file"), F.explode(erasure._bits(value, 3)).alias("p"))
    plain = placed.groupBy("file", F.col("p.bitmap").alias("bitmap")).agg(F.bitmap_construct_agg(F.col("p.bit")).alias("bits"))
    assert sorted(map(tuple, index.collect())) == sorted(map(tuple, plain.collect()))
    # Rows meet no sort or exchange on their way to the bits.
    plan = index._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan and "MapInArrow" in plan
