"""Label index and the three feature sets.

All of these but word vectors are Spark ML stages. What is added here: fitting without an extra
pass where the counts are already known, an optional bound on the vocabulary, and exact row
forms of vectors for checks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.feature import (
    IDF,
    HashingTF,
    IDFModel,
    MinMaxScaler,
    MinMaxScalerModel,
    StringIndexer,
    StringIndexerModel,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.wordvectors import WordVectors, learn
from reviewlab.scratch import discard, stage

# Sizes the feature sets are defined with.
BUCKETS = 250
VECTOR_SIZE = 250
MIN_COUNT = 5
SEED = 11



class VocabularyTooLarge(ValueError):
    """More distinct words than the caller allows."""


def fit_label_index(
    df: DataFrame, column: str = "sentiment", output: str = "label"
) -> StringIndexerModel:
    """Most frequent value is 0.0; equal counts go by the value itself."""
    return StringIndexer(inputCol=column, outputCol=output).fit(df)


def label_index_from(
    class_counts: Mapping[str, int], column: str = "sentiment", output: str = "label"
) -> StringIndexerModel:
    """The same index from counts an audit already has, without reading the table."""
    present = [value for value, n in class_counts.items() if n > 0]
    ranked = sorted(present, key=lambda value: (-class_counts[value], value))
    return StringIndexerModel.from_labels(ranked, inputCol=column, outputCol=output)


def hashing_tf(words: str = "filtered", output: str = "rawfeatures") -> HashingTF:
    """Counts of words per hash bucket; needs no fitting."""
    return HashingTF(inputCol=words, outputCol=output, numFeatures=BUCKETS)


def fit_idf(counts: DataFrame, column: str = "rawfeatures", output: str = "features") -> IDFModel:
    """``ln((rows + 1) / (rows with the bucket + 1))`` per bucket."""
    return IDF(inputCol=column, outputCol=output).fit(counts)


def idf_rows(df: DataFrame, model: IDFModel) -> DataFrame:
    """The fitted weights as a table of one row per bucket."""
    weights = zip(model.idf.toArray().tolist(), model.docFreq, strict=True)
    rows = [(bucket, int(df_count), idf) for bucket, (idf, df_count) in enumerate(weights)]
    return df.sparkSession.createDataFrame(rows, "bucket bigint, doc_freq bigint, idf double")


def word_counts(df: DataFrame, words: str = "filtered") -> DataFrame:
    """Occurrences of each word. Summed map-side, so a frequent word is one row per task.

    A plain ``explode`` makes Catalyst test the word list for emptiness first, and
    where the list is computed that computes it once more; the outer form does not.
    """
    return (
        df.select(F.explode_outer(words).alias("word"))
        .where(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def vocabulary(df: DataFrame, words: str = "filtered", min_count: int = MIN_COUNT) -> DataFrame:
    """The words a vector is learned for."""
    return word_counts(df, words).where(F.col("occurrences") >= min_count)


def fit_word2vec(
    df: DataFrame,
    words: str = "filtered",
    output: str = "features",
    *,
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    seed: int = SEED,
    tasks: int = 1,
    max_matrix_cells: int | None = None,
) -> WordVectors:
    """Word vectors, kept as a table; the driver holds none of them.

    ``tasks`` is how many parts a corpus of some size is learned from in: a large one wants
    as many as the cluster has cores. One part gives the same vectors on any layout of the
    rows. ``max_matrix_cells``, if given, bounds vocabulary x ``vector_size`` and is checked first.
    """
    known = stage(vocabulary(df, words, min_count), "vocabulary")
    _check_vocabulary(known.count(), vector_size, min_count, max_matrix_cells)
    stored = learn(df, words, known, vector_size=vector_size, seed=seed, parts=tasks)
    discard(known)
    return WordVectors(stored, inputCol=words, outputCol=output, vectorSize=vector_size)


def _check_vocabulary(
    known: int, vector_size: int, min_count: int, max_matrix_cells: int | None
) -> None:
    if max_matrix_cells is not None and known * vector_size > max_matrix_cells:
        raise VocabularyTooLarge(
            f"{known} words occur {min_count} times or more; with "
            f"{vector_size} dimensions the limit is {max_matrix_cells // vector_size}. "
            "Raise min_count, lower vector_size, or raise max_matrix_cells."
        )
    if not known:
        raise ValueError(f"no word occurs {min_count} times or more, so there is nothing to learn")


def fit_min_max(
    df: DataFrame, column: str = "features", output: str = "scaledFeatures"
) -> MinMaxScalerModel:
    """Each dimension onto [0, 1]; a constant one becomes 0.5."""
    return MinMaxScaler(inputCol=column, outputCol=output).fit(df)
