"""Cleaning and tokens as plain columns, so that Catalyst sees through them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from string import ascii_letters

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns define the cleaned text. They are written for speed in
# java.util.regex: no backtracking inside a tag, letters as a bit set rather than
# two ranges, and no match for a single space, which would be replaced by itself.
TAG = r"<[^>]*+>"
NOT_LETTERS = f"[^{ascii_letters} ]+"
SPACES = r" {2,}"
NOT_WORD = r"\W"


def strip_tags(text: Column, replacement: str = "") -> Column:
    """Take out markup, also where a tag spans lines; what stood between tags stays."""
    return F.regexp_replace(text, F.lit(TAG), F.lit(replacement))


def letters_only(text: Column, replacement: str = "") -> Column:
    """Keep ASCII letters and spaces. Newlines go too: ``a\\nb`` becomes ``ab``."""
    return F.regexp_replace(text, F.lit(NOT_LETTERS), F.lit(replacement))


def collapse_spaces(text: Column) -> Column:
    """Runs of spaces become one; the ends are not trimmed."""
    return F.regexp_replace(text, F.lit(SPACES), F.lit(" "))


def clean_text(text: Column, replacement: str = "") -> Column:
    """Tags, then non-letters, then spaces, then case.

    Tags go first, or the letters inside them would stay. The default joins what
    stood on both sides of a removed run; ``replacement=" "`` keeps them apart.
    """
    return F.lower(collapse_spaces(letters_only(strip_tags(text, replacement), replacement)))


def tokenize(text: Column, min_length: int = 1) -> Column:
    """Lowercased runs of word characters; null stays null."""
    return _long_enough(F.split(F.lower(text), NOT_WORD), min_length)


def clean_words(cleaned: Column) -> Column:
    """``tokenize`` for text that ``clean_text`` made: only the space can separate words there."""
    return _long_enough(F.split(cleaned, " "), 1)


def _long_enough(words: Column, min_length: int) -> Column:
    words = F.array_remove(words, "")
    if min_length > 1:
        words = F.filter(words, lambda w: F.length(w) >= min_length)
    return words


@lru_cache(maxsize=None)
def english_stop_words() -> tuple[str, ...]:
    """The list that ships with Spark; needs a running session."""
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def matching_clean_text(words: Sequence[str]) -> tuple[str, ...]:
    """Stop words as ``clean_text`` would leave them: ``don't`` also stops ``dont``."""
    bare = ("".join(ch for ch in w.lower() if "a" <= ch <= "z") for w in words)
    return tuple(dict.fromkeys([*words, *bare]))


def remove_stop_words(
    words: Column, stop_words: Sequence[str] | None = None, *, case_sensitive: bool = False
) -> Column:
    """Drop listed words, keeping order and repeats."""
    stop_words = english_stop_words() if stop_words is None else tuple(stop_words)
    if not stop_words:
        return words
    if case_sensitive:
        return F.filter(words, lambda w: ~w.isin(*stop_words))
    lowered = [w.lower() for w in stop_words]
    return F.filter(words, lambda w: ~F.lower(w).isin(*lowered))


def content_words(cleaned: Column, stop_words: Sequence[str] | None = None) -> Column:
    """Words of cleaned text without stop words. Both are lower case, so no folding per word."""
    stop_words = english_stop_words() if stop_words is None else stop_words
    return remove_stop_words(
        clean_words(cleaned), [w.lower() for w in stop_words], case_sensitive=True
    )


class CleanWords(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Raw text to content words, as the first stage of a model that can be saved.

    It keeps the options of the cleaning, so a stored model reads text as it was
    trained. A stage of this package: such a model is loaded from Python only.
    """

    replacement = Param(Params._dummy(), "replacement", "put where a run was removed", TypeConverters.toString)
    stopWords = Param(Params._dummy(), "stopWords", "words to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(
        self,
        *,
        inputCol: str = "review",
        outputCol: str = "filtered",
        replacement: str = "",
        stopWords: Sequence[str] | None = None,
    ):
        super().__init__()
        self._setDefault(inputCol="review", outputCol="filtered", replacement="")
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stop_words = self.getOrDefault(self.stopWords) if self.isDefined(self.stopWords) else None
        cleaned = clean_text(F.col(self.getInputCol()), self.getOrDefault(self.replacement))
        return dataset.withColumn(self.getOutputCol(), content_words(cleaned, stop_words))
