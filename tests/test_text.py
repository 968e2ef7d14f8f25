from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from reviewlab.functions import text

def raw():
    return F.col("raw")


def apply(spark, column, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, raw string").select("i", column.alias("out"))
    return [r["out"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def cleaned_by_hand(value: str) -> str:
    value = re.sub(r"<[^>]*>", "", value)
    value = re.sub(r"[^A-Za-z ]+", "", value)
    return re.sub(r" +", " ", value).lower()


EDGES = {
    "Good.<br /><br />Bad don't café 10/10\nnext  x": "goodbad dont caf next x",
    "a < b and c > d": "a d",
    "  ": " ",
    "": "",
    "<br/>hello<br/>": "hello",
    "<a\nhref='x'>link</a>": "link",
    "a    b   c": "a b c",
    "open < never closed": "open never closed",
    "1<b>2</b>": "",
}


def test_clean_edges(spark):
    assert apply(spark, text.clean_text(raw()), list(EDGES)) == list(EDGES.values())
    assert apply(spark, text.clean_text(raw()), [None]) == [None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aZé<> /\n1.!’", max_size=60), min_size=200, max_size=200))
def test_clean_is_the_four_steps(spark, values):
    assert apply(spark, text.clean_text(raw()), values) == [cleaned_by_hand(v) for v in values]


def test_steps_one_by_one(spark):
    value = ["<i>A</i>  b2 \n C"]
    assert apply(spark, text.strip_tags(raw()), value) == ["A  b2 \n C"]
    assert apply(spark, text.letters_only(raw()), value) == ["iAi  b  C"]
    assert apply(spark, text.collapse_spaces(raw()), ["a   b c  "]) == ["a b c "]


def test_replacement_keeps_words_apart(spark):
    assert apply(spark, text.clean_text(raw(), " "), ["Good.<br/>Bad\nnext"]) == ["good bad next"]


def test_tokenize_like_the_spark_stage(spark):
    values = ["Don't  stop, NOW!", "", "  ", "a_b c1", "été ok", "x"]
    stage = RegexTokenizer(inputCol="raw", outputCol="out", pattern=r"\W")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    want = [r["out"] for r in stage.transform(df).orderBy("i").collect()]
    assert apply(spark, text.tokenize(raw()), values) == want
    assert apply(spark, text.tokenize(raw()), [None]) == [None]
    assert apply(spark, text.tokenize(raw(), 2), ["a bb ccc"]) == [["bb", "ccc"]]


def test_clean_words_are_the_tokens_of_clean_text(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cleaned = text.clean_text(F.col("text"))
    assert df.where(text.clean_words(cleaned) != text.tokenize(cleaned)).isEmpty()


def test_stop_words_like_the_spark_stage(spark):
    assert len(text.english_stop_words()) == 181
    values = ["The plot AND the cast", "dont don't", "movie", "the the the", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")
    df = df.withColumn("words", F.split("raw", " "))
    want = StopWordsRemover(inputCol="words", outputCol="out").transform(df).orderBy("i").collect()
    got = apply(spark, text.remove_stop_words(F.split(raw(), " ")), values)
    assert got == [r["out"] for r in want]


def test_stop_words_can_be_cleaned_like_the_text(spark):
    kept = text.content_words(text.clean_text(raw()))
    assert apply(spark, kept, ["It isn't good"]) == [["isnt", "good"]]
    stop = text.matching_clean_text(text.english_stop_words())
    kept = text.content_words(text.clean_text(raw()), stop)
    assert apply(spark, kept, ["It isn't good"]) == [["good"]]
    unfiltered = text.remove_stop_words(F.split(raw(), " "), [])
    assert apply(spark, unfiltered, ["the a"]) == [["the", "a"]]


@pytest.mark.parametrize("value", ["<b>Good</b> the FILM", None])
def test_stage_matches_the_columns(spark, value, tmp_path):
    stage = text.CleanWords(inputCol="raw", outputCol="words")
    stage.save(str(tmp_path / "stage"))
    again = text.CleanWords.load(str(tmp_path / "stage"))
    df = spark.createDataFrame([(value,)], "raw string")
    want = df.select(text.content_words(text.clean_text(raw())).alias("words")).collect()
    assert again.transform(df).select("words").collect() == want
