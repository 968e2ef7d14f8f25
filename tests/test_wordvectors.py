"""Word vectors as a table: what they learn, and what texts get from them."""

from __future__ import annotations

import glob
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewlab import scratch
from reviewlab.catalog import queries
from reviewlab.operators import features, wordvectors

SEA = ["wave", "shore", "sail", "tide"]
HILL = ["rock", "ridge", "slope", "cliff"]


@pytest.fixture(scope="module")
def texts(spark):
    drawn = random.Random(3)
    rows = [(i, [*drawn.choices(SEA if i % 2 else HILL, k=8), "the"]) for i in range(400)]
    return spark.createDataFrame(rows, "i long, filtered array<string>")


def found(model) -> dict[str, np.ndarray]:  # noqa: ANN001
    return {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}


@pytest.mark.parametrize("tasks", [1, 3])
def test_words_of_one_topic_are_near(texts, tasks, monkeypatch):
    monkeypatch.setattr(wordvectors, "LEAST_WORDS", 100)
    vectors = found(features.fit_word2vec(texts, vector_size=16, tasks=tasks))

    def near(a: str, b: str) -> float:
        return vectors[a] @ vectors[b] / np.linalg.norm(vectors[a]) / np.linalg.norm(vectors[b])

    assert set(vectors) == {*SEA, *HILL, "the"}
    within = [near(a, b) for topic in (SEA, HILL) for a in topic for b in topic if a < b]
    across = [near(a, b) for a in SEA for b in HILL]
    assert min(within) > max(across)


def test_vectors_are_read_from_files_and_not_held_by_the_driver(texts):
    model = features.fit_word2vec(texts, vector_size=4, tasks=3)
    assert model.getVectors().inputFiles()


def test_every_row_gets_the_mean_of_its_words_in_any_number_of_parts(spark, texts, monkeypatch):
    monkeypatch.setattr(wordvectors, "MEAN_WORDS", 700)
    monkeypatch.setattr(wordvectors, "LEAST_WORDS", 100)
    odd = spark.createDataFrame([(-1, None), (-2, []), (-3, ["unseen"]), (-4, ["tide", "unseen"])], texts.schema)
    rows = texts.unionByName(odd).unionByName(texts.where("i < 3"))
    model = features.fit_word2vec(texts, vector_size=4, tasks=2)
    vectors = found(model)
    told = model.transform(rows).collect()
    assert sorted(r["i"] for r in told) == sorted([*range(400), -1, -2, -3, -4, 0, 1, 2])
    for r in told:
        words = r["filtered"] or []
        mean = sum((vectors.get(w, np.zeros(4)) for w in words), np.zeros(4)) / max(len(words), 1)
        assert r["features"].toArray() == pytest.approx(mean, abs=1e-6)


def test_no_words_to_learn_is_refused(texts):
    with pytest.raises(ValueError, match="no word occurs"):
        features.fit_word2vec(texts.select(F.col("filtered")), min_count=100_000)


def test_query_counts_no_words_where_the_text_is_null(spark, tmp_path):
    rows = [(1, "tide wave " * 10), (2, None), (3, "tide")]
    spark.createDataFrame([(i, t, "en", "made", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.w2v_doc_vectors(spark, str(tmp_path)).collect()}
    assert found == {1: (20, 20, True), 2: (0, 0, True), 3: (1, 1, True)}


@pytest.mark.parametrize("few", [1, 3, 8])
def test_gradients_of_one_row_are_added_together_however_many_there_are(few, monkeypatch):
    monkeypatch.setattr(wordvectors, "FEW", few)
    drawn = np.random.default_rng(5)
    # Rows of the matrix with none, one, a few and very many gradients.
    places = np.concatenate([np.full(60, 2), drawn.integers(3, 30, 90), [31, 32]])
    places = drawn.permutation(places)
    gradients = drawn.normal(size=(len(places), 7)).astype(np.float32)
    start = drawn.normal(size=(40, 7)).astype(np.float32)
    matrix, seen = start.copy(), np.ones(40, np.float32)
    wordvectors._ascend(matrix, seen, places, gradients)
    summed = np.zeros((40, 7))
    np.add.at(summed, places, gradients.astype(np.float64))
    want = 1 + (summed**2).mean(axis=1)
    assert seen == pytest.approx(want, rel=1e-5)
    assert matrix == pytest.approx(start + summed * (wordvectors.RATE / np.sqrt(want))[:, None], rel=1e-4, abs=1e-6)


def test_parts_are_learned_some_at_a_time_and_weigh_the_same(spark, texts, monkeypatch):
    monkeypatch.setattr(wordvectors, "LEAST_WORDS", 100)
    monkeypatch.setattr(wordvectors, "MEAN_WORDS", 500)
    monkeypatch.setattr(wordvectors, "FILE_ROWS", 50)
    monkeypatch.setitem(wordvectors.STORED, "maxRecordsPerFile", 50)
    stored, real = [], wordvectors.stage
    monkeypatch.setattr(wordvectors, "stage", lambda df, name, **o: stored.append(name) or real(df, name, **o))
    fitted = {}
    for at_once in (1, 100):
        monkeypatch.setattr(wordvectors, "_at_once", lambda df, n=at_once: n)
        stored.clear()
        model = features.fit_word2vec(texts.coalesce(1), vector_size=8, tasks=4)
        n_tables = stored.count("vectors")
        vectors = found(model)
        for r in model.transform(texts).collect():
            mean = sum(vectors[w] for w in r["filtered"]) / len(r["filtered"])
            assert r["features"].toArray() == pytest.approx(mean, abs=1e-6)
        fitted[at_once] = vectors, n_tables, stored.count("means")
    assert fitted[1][1] == 4 and fitted[1][2] > 1 and fitted[100][1:] == (1, 1)
    assert set(fitted[1][0]) == {*SEA, *HILL, "the"} == set(fitted[100][0])


def test_averages_go_on_from_earlier_ones():
    def rows(words, n, vectors):
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(n, pa.int64()), wordvectors._as_lists(np.array(vectors))], ["word", "n", "vector"])

    first = [rows(["a", "a"], [1, 2], [[3, 0], [0, 3]]), rows(["a", "b"], [3, 5], [[1, 1], [2, 2]])]
    (a, b) = (r for batch in wordvectors._averaged(2)(iter(first)) for r in batch.to_pylist())
    assert a == {"word": "a", "n": 6, "vector": [1.0, 1.5]} and b == {"word": "b", "n": 5, "vector": [2.0, 2.0]}
    (again,) = (r for x in wordvectors._averaged(2)(iter([rows(["a", "a"], [6, 6], [[1, 1.5], [3, 0.5]])])) for r in x.to_pylist())
    assert again == {"word": "a", "n": 12, "vector": [2.0, 1.0]}


@pytest.mark.parametrize("held", [1, 7, 100])
def test_rows_in_a_file_are_rows_like_those_in_memory(held):
    drawn = np.random.default_rng(2)
    matrix, plain = wordvectors._Matrix(20, 3, held), np.zeros((20, 3), np.float32)
    for _ in range(5):
        some = drawn.permutation(20)[:9]
        added = drawn.normal(size=(9, 3)).astype(np.float32)
        matrix[some] += added
        plain[some] += added
        assert np.array_equal(matrix[np.arange(20)], plain)
    assert len(matrix.first) == min(held, 20)


def test_vectors_do_not_depend_on_how_many_words_are_held(texts, monkeypatch):
    told = []
    for held in (3, 150_000):
        monkeypatch.setattr(wordvectors, "HELD", held)
        told.append(found(features.fit_word2vec(texts, vector_size=4)))
    assert all(np.array_equal(told[0][w], told[1][w]) for w in told[1])


def test_query_sums_words_that_are_sent_in_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "SENT_WORDS", 2)
    rows = [(1, "tide wave rock " * 10), (2, None), (3, "tide unseen"), (3, "rock")]
    spark.createDataFrame([(i, t, "en", "made", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = {(r["doc_id"], r["n_words"]): r["n_known"] for r in queries.w2v_doc_vectors(spark, str(tmp_path)).collect()}
    assert found == {(1, 30): 30, (2, 0): 0, (3, 2): 2, (3, 1): 2}


def test_shuffle_files_go_when_a_table_is_written(spark):
    before = spark.conf.get(scratch.CLEANING)
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def shuffled() -> set[str]:
        return {name for f in folders for name in glob.glob(f"{f}/*/shuffle_*")}

    counted = spark.range(1000).repartition(3, "id").groupBy("id").count()
    there = shuffled()
    counted.collect()
    assert shuffled() - there
    there = shuffled()
    stored = scratch.stage(counted, "counts")
    # Files are removed while the driver goes on.
    for _ in range(50):
        if not shuffled() - there:
            break
        time.sleep(0.1)
    assert not shuffled() - there
    assert stored.count() == 1000 and spark.conf.get(scratch.CLEANING) == before
