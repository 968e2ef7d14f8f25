"""Where results go: feature tables, fitted models and audit records."""

from __future__ import annotations

import logging

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame

from reviewlab.config import RunConfig, under

log = logging.getLogger(__name__)

# The names under which artifacts are found.
HASHED_COUNTS = "HTFfeaturizedData"
TFIDF = "TFIDFfeaturizedData"
WORD_VECTORS = "W2VfeaturizedData"
FEATURE_SETS = (HASHED_COUNTS, TFIDF, WORD_VECTORS)


def model_name(classifier: str, feature_set: str) -> str:
    return f"{classifier}_{feature_set}"


def write_features(
    df: DataFrame, name: str, config: RunConfig, *, even_files: bool = False
) -> str | None:
    """Parquet with one directory per label, replacing what was there; returns the path.

    Each task writes at most one file per label, without a shuffle. With
    ``even_files`` rows are first rebalanced into files of the adaptive advisory
    size; a label that holds most rows is spread over many tasks.
    """
    if not config.persist:
        log.warning("feature set %s not written: persist is off", name)
        return None
    path = under(config.features_root, name)
    rows = df.hint("rebalance", "label") if even_files else df
    rows.write.mode("overwrite").partitionBy("label").parquet(path)
    return path


def write_model(model: MLWritable, name: str, config: RunConfig) -> str | None:
    """Spark ML's own format, replacing what was there; returns the path."""
    if not config.persist:
        log.warning("model %s not written: persist is off", name)
        return None
    path = under(config.models_root, name)
    model.write().overwrite().save(path)
    return path


def append_audit(rows: DataFrame, config: RunConfig) -> str | None:
    """One JSON object per line, added to those of earlier runs."""
    if not config.persist:
        log.warning("audit rows not written: persist is off")
        return None
    rows.write.mode("append").json(config.audit_path)
    return config.audit_path


def write_violations(rows: DataFrame, config: RunConfig) -> str | None:
    """The values that break the contract, all of them; returns the path."""
    if not config.persist:
        log.warning("violations not written: persist is off")
        return None
    rows.write.mode("overwrite").json(config.violations_path)
    return config.violations_path
