"""The batch job: ``spark-submit reviewlab/plans/job.py <input> <output>``.

Exit codes name the stage that failed: 2 settings, 3 session, 4 contract,
5 features, 6 training.
"""

from __future__ import annotations

import argparse
import logging
import sys
import uuid
from collections.abc import Callable, Sequence
from dataclasses import astuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reviewlab import sinks
from reviewlab.config import ConfigError, RunConfig, resolve
from reviewlab.contracts import ContractError
from reviewlab.operators import features
from reviewlab.operators.audit import audit_of
from reviewlab.plans.compare import FeaturesFailed, compare_feature_sets
from reviewlab.plans.featurize import read_tokens
from reviewlab.scratch import staging
from reviewlab.sources.manifest import text_digest

log = logging.getLogger("reviewlab.job")

OK, BAD_CONFIG, NO_SESSION, BAD_INPUT, NO_FEATURES, NO_MODELS = 0, 2, 3, 4, 5, 6


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Featurize labelled reviews, compare models.")
    parser.add_argument("input", nargs="?", help="folder or file of reviews, any Hadoop URI")
    parser.add_argument("output", nargs="?", help="root for features, models and audit records")
    parser.add_argument("--run-id", help="name of this run; a fresh one if not given")
    parser.add_argument("--no-persist", action="store_true", help="write no results")
    parser.add_argument("--multi-line", action="store_true", help="texts hold quoted newlines")
    parser.add_argument(
        "--split-on",
        default="row",
        choices=["row", "text"],
        help="row: by position in the files; text: by content, the same on any layout, "
        "copies stay on one side",
    )
    parser.add_argument("--wide", action="store_true", help="store features with texts and words")
    parser.add_argument("--fit-scope", default="all", choices=["all", "train"])
    parser.add_argument(
        "--min-count",
        type=int,
        default=features.MIN_COUNT,
        help="occurrences a word needs to get a vector; raise it where the vocabulary is too large",
    )
    parser.add_argument("--vector-size", type=int, default=features.VECTOR_SIZE)
    parser.add_argument(
        "--max-matrix-cells",
        type=int,
        help="check first that vocabulary x vector size is at most this",
    )
    parser.add_argument(
        "--w2v-tasks",
        type=int,
        default=1,
        help="tasks that learn word vectors; with one, vectors repeat exactly",
    )
    parser.add_argument(
        "--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR"]
    )
    return parser.parse_args(argv)


def new_session() -> SparkSession:
    return SparkSession.builder.appName("reviewlab").getOrCreate()


def run(
    spark: SparkSession,
    config: RunConfig,
    *,
    multi_line: bool = False,
    fit_scope: str = "all",
    split_on: str = "row",
    word2vec: dict | None = None,
    slim: bool = True,
) -> int:
    """Tokens, then features and models, then the audit records; returns the exit code.

    Tables between steps lie below the output and go when the run ends. Audit records
    are written however it ends, and the values that broke the contract beside them.
    """
    with staging(spark, config.staging_path):
        code, measured, results = _steps(
            spark, config, multi_line, fit_scope, split_on, word2vec, slim
        )
        if code != OK:
            measured[f"failed.{code}"] = 1
        try:
            sinks.append_audit(audit_of(spark, measured, config.run_id).coalesce(1), config)
        except Exception:
            log.exception("run %s: no audit records", config.run_id)
            code = code or NO_MODELS
    for r in results:
        log.info("run %s: %s on %s: %.2f%%", config.run_id, *astuple(r))
    return code


def _steps(
    spark: SparkSession,
    config: RunConfig,
    multi_line: bool,
    fit_scope: str,
    split_on: str,
    word2vec: dict | None,
    slim: bool,
) -> tuple[int, dict[str, float], list]:
    """Exit code, what was measured, and the results."""
    measured: dict[str, float] = {}
    try:
        key = text_digest(F.col("review")) if split_on == "text" else None
        tokens = read_tokens(spark, config, multi_line=multi_line, key=key, fit_scope=fit_scope)
        measured.update(tokens.measured)
    except ContractError as error:
        log.exception("run %s: the input breaks its contract", config.run_id)
        measured.update(error.measured)
        measured.update({f"missing.{name}": 1 for name in error.missing})
        if error.violations is not None:
            sinks.write_violations(error.violations, config)
        return BAD_INPUT, measured, []
    except Exception:
        log.exception("run %s: no tokens", config.run_id)
        return NO_FEATURES, measured, []
    log.info("run %s: %s", config.run_id, tokens.measured)
    try:
        results = compare_feature_sets(tokens, config=config, word2vec=word2vec, slim=slim)
    except FeaturesFailed:
        log.exception("run %s: no features", config.run_id)
        return NO_FEATURES, measured, []
    except Exception:
        log.exception("run %s: no models", config.run_id)
        return NO_MODELS, measured, []
    measured.update({f"accuracy.{r.feature_name}": r.accuracy for r in results})
    return OK, measured, results


def main(
    argv: Sequence[str] | None = None, session: Callable[[], SparkSession] = new_session
) -> int:
    args = parse(argv)
    logging.basicConfig(level=args.log_level, format="%(asctime)s %(levelname)s %(message)s")
    try:
        config = resolve(
            args.input,
            args.output,
            args.run_id or str(uuid.uuid4()),
            persist=not args.no_persist,
        )
    except ConfigError:
        log.exception("settings")
        return BAD_CONFIG
    try:
        spark = session()
    except Exception:
        log.exception("run %s: no Spark session", config.run_id)
        return NO_SESSION
    try:
        return run(
            spark,
            config,
            multi_line=args.multi_line,
            fit_scope=args.fit_scope,
            split_on=args.split_on,
            slim=not args.wide,
            word2vec={
                "min_count": args.min_count,
                "vector_size": args.vector_size,
                "max_matrix_cells": args.max_matrix_cells,
                "tasks": args.w2v_tasks,
            },
        )
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
