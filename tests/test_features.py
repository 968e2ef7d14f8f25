from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewlab.functions import vectors
from reviewlab.operators import features

DOCS = [["good", "plot", "good"], ["bad", "plot"], [], ["good", "ünïcode", "a" * 300]]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "i bigint, filtered array<string>")


@pytest.mark.parametrize(
    ("values", "order"),
    [
        (["positive", "negative", "positive"], ["positive", "negative"]),
        (["positive", "negative", "positive", "negative"], ["negative", "positive"]),
    ],
)
def test_label_index_fitted_or_from_counts(spark, values, order):
    df = spark.createDataFrame([(v,) for v in values], "sentiment string")
    fitted = features.fit_label_index(df)
    counted = features.label_index_from(Counter(values))
    assert fitted.labels == counted.labels == order
    assert counted.transform(df).collect() == fitted.transform(df).collect()
    field = counted.transform(df).schema["label"]
    assert field.metadata["ml_attr"]["vals"] == order


def test_unseen_label_is_an_error(spark):
    model = features.label_index_from({"positive": 1, "negative": 0})
    assert model.labels == ["positive"]
    df = spark.createDataFrame([("negative",)], "sentiment string")
    with pytest.raises(Exception, match="[Uu]nseen"):
        model.transform(df).collect()


def test_counts_add_up_and_match_the_hash(spark, words):
    rows = vectors.to_rows(
        features.hashing_tf().transform(words), ["i"], "rawfeatures", index="bucket", value="tf"
    ).collect()
    index = HashingTF(numFeatures=250).indexOf
    want = Counter((i, index(w)) for i, doc in enumerate(DOCS) for w in doc)
    assert {(r["i"], r["bucket"]): r["tf"] for r in rows} == dict(want)


def test_idf_formula(spark, words):
    counted = features.hashing_tf().transform(words)
    model = features.fit_idf(counted)
    index = HashingTF(numFeatures=250).indexOf
    having = Counter(b for doc in DOCS for b in {index(w) for w in doc})
    for r in features.idf_rows(counted, model).collect():
        assert r["doc_freq"] == having[r["bucket"]]
        assert r["idf"] == pytest.approx(math.log((len(DOCS) + 1) / (having[r["bucket"]] + 1)))


def test_document_vector_divides_by_all_words(spark):
    df = spark.createDataFrame([(["a", "a", "zz"],), (["a"],), ([],)], "filtered array<string>")
    model = features.fit_word2vec(df, vector_size=3, min_count=2)
    (word,) = model.getVectors().collect()
    of_a = word["vector"].toArray()
    first, second, empty = (r["features"].toArray() for r in model.transform(df).collect())
    assert word["word"] == "a"
    assert first == pytest.approx(of_a * 2 / 3)
    assert second == pytest.approx(of_a)
    assert not empty.any()


def test_vocabulary(spark, words):
    assert dict(features.vocabulary(words, min_count=2).collect()) == {"good": 3, "plot": 2}


def test_vocabulary_bound_is_checked_before_fitting(spark, words):
    with pytest.raises(features.VocabularyTooLarge, match="limit is 1"):
        features.fit_word2vec(words, vector_size=10, min_count=2, max_matrix_cells=19)
    assert features.fit_word2vec(words, vector_size=10, min_count=2, max_matrix_cells=20)


def test_word_vectors_repeat(spark, words):
    fits = [
        features.fit_word2vec(words.repartition(n, "i").orderBy("i"), vector_size=4, min_count=1)
        for n in (1, 3)
    ]
    one, other = ({r["word"]: r["vector"] for r in m.getVectors().collect()} for m in fits)
    assert one == other


def test_min_max(spark):
    df = spark.createDataFrame(
        [(Vectors.dense([1.0, 5.0, 0.0]),), (Vectors.dense([3.0, 5.0, -1.0]),)], ["features"]
    )
    got = features.fit_min_max(df).transform(df).select("scaledFeatures").collect()
    assert [r[0].toArray().tolist() for r in got] == [[0.0, 0.5, 1.0], [1.0, 0.5, 0.0]]


def test_rows_of_dense_sparse_and_empty_vectors(spark):
    made = [
        (1, Vectors.dense([0.0, 2.0])),
        (2, Vectors.sparse(4, {1: 3.0, 3: 0.0})),
        (3, Vectors.sparse(4, {})),
        (4, Vectors.dense([])),
    ]
    df = spark.createDataFrame(made, ["i", "v"])
    rows = {tuple(r) for r in vectors.to_rows(df, ["i"], "v").collect()}
    assert rows == {(1, 0, 0.0), (1, 1, 2.0), (2, 1, 3.0), (2, 3, 0.0)}
    sizes = df.select("i", vectors.dimensions("v"), vectors.nonzeros("v")).collect()
    assert [tuple(r) for r in sizes] == [(1, 2, 1), (2, 4, 1), (3, 4, 0), (4, 0, 0)]


def test_same_features_on_any_layout(spark, words):
    def cells(df):
        model = features.fit_idf(features.hashing_tf().transform(df))
        out = model.transform(features.hashing_tf().transform(df))
        rows = vectors.to_rows(out, ["i"], "features").withColumn("value", F.round("value", 12))
        return {tuple(r) for r in rows.collect()}

    assert cells(words.coalesce(1)) == cells(words.repartition(4))
