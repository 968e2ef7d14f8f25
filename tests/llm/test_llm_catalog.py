"""The llm queries against SQL, and the pipeline against brute force."""

from __future__ import annotations

import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from reviewlab.llm import catalog
from test_llm_duplicates_search import plain_components
from test_llm_pieces_language_secrets import ASSIGN

ROOT = Path(entry_point.__file__).parent


def test_every_operator_has_a_query():
    names = list(entry_point.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
    assert set(entry_point.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_values_as_sql(spark, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    duck = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        duck.execute(f"create view {table} as from '{sf_dir}/{table}.parquet'")
    cursor = duck.execute(catalog.oracle_sql()[name])
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    want = sorted(str([row[i] for i in order]) for row in cursor.fetchall())
    assert sorted(str(list(r)) for r in df.select(*columns).collect()) == want


@pytest.mark.parametrize("n", [1, 4, 5, 6, 7, 9, 10, 11])
def test_queries_give_a_row_for_each_of_theirs(spark, sf_dir, n):
    (name,) = [x for x in entry_point.queries() if x.startswith(f"op{n}_")]
    rows = entry_point.queries()[name](spark, sf_dir).count()
    assert rows == {7: rows, 10: 25 * 20}.get(n, 200) and rows > 0


def test_the_rest_stands_without_this_folder(tmp_path):
    without = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(ROOT / "reviewlab", tmp_path / "reviewlab", ignore=without)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 40 and not [q for q in e.queries() if q.startswith('op')]; e.oracle_sql()"
    done = subprocess.run(
        [sys.executable, "-c", code],
        cwd=tmp_path,
        env=os.environ | {"PYTHONPATH": str(tmp_path)},
        capture_output=True,
        text=True,
        timeout=120,
    )
    assert done.returncode == 0, done.stderr


WORD = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my".split()


def made_docs():
    item = "which of the many old bridges over the long river was built first? the one of grey stone near the mill"
    texts = {
        1: " ".join(WORD),
        2: " ".join(WORD).upper(),
        3: " ".join([*WORD, "extra"]),
        4: "123 456 --",
        5: None,
        6: "the start " + item + " the end",
        7: "login with password = hunter2hunter2 and go on with the rest of the day",
        8: "",
        9: "été: une très longue journée à la plage avec des amis venus de loin",
    }
    return [(i, t, "fr" if i == 9 else "en", "src", len(t or "")) for i, t in texts.items()], item


def test_the_pipeline_by_brute_force(spark, tmp_path):
    rows, item = made_docs()
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = [(i, t) for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    least = {i: c for (i, _), (_, c) in plain_components(kept, 5, 80).items()}
    kept = [(i, t) for i, t in kept if least[i] == i]
    kept = [(i, t) for i, t in kept if item not in t]
    kept = {i: ASSIGN.sub(lambda m: "[SECRET]" if len(m[2]) >= 6 else m[0], t) for i, t in kept}
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in found} == kept
    assert sorted(kept) == [1, 7, 9] and "[SECRET]" in kept[7]
    for r in found:
        assert r.round_trip and r.n_pieces == len(r.pieces) > 0 and r.n_chars == len(r.text)


def test_stages_take_empty_tables_nulls_and_extra_columns(spark, tmp_path):
    rows, item = made_docs()
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, found int, h int"
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows] + [(None,) * 8] * 2, schema)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, step in corpus_pipeline.STAGES:
        for given in (docs, docs.where("false")):
            out = step(spark, given, str(tmp_path))
            assert out.columns[: len(docs.columns)] == docs.columns
            n = out.count()
            assert n == 0 if given is not docs else n > 0
            if name != "pieces":
                assert out.schema == docs.schema and re.match("[a-z_]+$", name)
