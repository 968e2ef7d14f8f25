"""A corpus, from raw documents to pieces ready for training.

Each stage takes the documents its predecessor kept and returns documents with the same
columns (the last one adds their pieces). Nulls: a null text has no language and goes in
the first stage; given to a later stage alone, it stays (near duplicates, benchmark),
stays null (secrets) or has null pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.llm import decontaminate, language, minhash, pieces, secrets
from reviewlab.scratch import fresh_path, stage
from reviewlab.sources.tables import table

# A model file that users replace by their own.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    model = language.fit(docs, text="text", label="lang")
    found = language.identified(F.col("text"), model)["lang"]
    return docs.where(found != language.UNKNOWN) if model.languages else docs.where(language.has_letter(F.col("text")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, 80 of 100."""
    return minhash.deduplicated(docs, words=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = table(spark, sf_dir, "benchmark")
    return docs.where(F.size(decontaminate.hits(F.col("text"), items)) == 0)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets blotted out; ``n_chars`` is that of the new text."""
    ledger = fresh_path(spark, "ledger")
    secrets.update(docs, ledger)
    text = secrets.redacted(F.col("row.text"), F.col("found"))
    changed = F.size("found") > 0
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        length = F.length(text).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, length).otherwise(F.col("row.n_chars"))
    return secrets.findings(docs, ledger).select(*[c.alias(name) for name, c in columns.items()])


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``pieces``, their number, and whether they decode to the text."""
    return pieces.with_pieces(docs, pieces.read_model(MODEL))


STAGES = [
    ("language", known_language),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("secrets", without_secrets),
    ("pieces", in_pieces),
]
# Language and pieces are beyond SQL; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
