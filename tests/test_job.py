from __future__ import annotations

import pytest
from conftest import made_reviews
from pyspark.ml import PipelineModel

from reviewlab import sinks
from reviewlab.config import RunConfig
from reviewlab.operators.audit import read_audit
from reviewlab.operators.models import split_by_key
from reviewlab.plans import job
from reviewlab.plans.compare import FeaturesFailed
from reviewlab.sources.delimited import write_reviews


@pytest.fixture
def raw(spark, tmp_path):
    path = str(tmp_path / "raw" / "dataset.csv")
    write_reviews(made_reviews(spark).select("review", "sentiment"), path)
    return str(tmp_path / "raw")


def test_whole_run(spark, raw, tmp_path):
    config = RunConfig(raw, str(tmp_path / "out"), "run-1", persist=True)
    assert job.run(spark, config) == job.OK
    for name in sinks.FEATURE_SETS:
        assert spark.read.parquet(f"{config.features_root}/{name}").count() == 120
        model = f"{config.models_root}/{sinks.model_name('LogisticRegression', name)}"
        assert PipelineModel.load(model).stages[-1].getOutputCol() == "predicted"
    rows = {
        (r["event"], r["subject"]): r["value"]
        for r in read_audit(spark, config.audit_path).collect()
        if r["run_id"] == "run-1"
    }
    assert rows["rows", ""] == rows["complete", ""] == 120
    assert rows["class", "sentiment.positive"] == 60
    assert {s for e, s in rows if e == "accuracy"} == set(sinks.FEATURE_SETS)


def test_slim_run_stores_no_texts(spark, raw, tmp_path):
    config = RunConfig(raw, str(tmp_path / "out"), "run-2", persist=True)
    assert job.run(spark, config, word2vec={"vector_size": 4}) == job.OK
    assert not (tmp_path / "out" / "_staging" / "run-2").exists()
    for name in sinks.FEATURE_SETS:
        stored = spark.read.parquet(f"{config.features_root}/{name}")
        assert set(stored.columns) == {"review_id", "sentiment", "label", "features"}


def test_split_on_text_is_the_same_on_any_layout(spark, tmp_path):
    sides = []
    for files in (1, 5):
        folder = tmp_path / f"raw{files}"
        reviews = made_reviews(spark).select("review", "sentiment").repartition(files)
        write_reviews(reviews, str(folder / "dataset.csv"))
        config = RunConfig(str(folder), str(tmp_path / f"out{files}"), "r", persist=True)
        assert job.run(spark, config, split_on="text", slim=True, word2vec={"vector_size": 2}) == 0
        stored = spark.read.parquet(f"{config.features_root}/{sinks.TFIDF}")
        train, _ = split_by_key(stored, "review_id")
        accuracies = read_audit(spark, config.audit_path).where("event = 'accuracy'")
        found = accuracies.where(f"subject = '{sinks.TFIDF}'").first()["value"]
        sides.append((sorted(r["review_id"] for r in train.collect()), found))
    assert sides[0] == sides[1]


def test_wrong_header_and_wrong_label_break_the_contract(spark, tmp_path):
    bad = {"header": "txt,lab\na,positive\n", "label": "review,sentiment\na,neutral\n"}
    for name, content in bad.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "dataset.csv").write_text(content)
        config = RunConfig(str(tmp_path / name), str(tmp_path / "out"), "r", persist=False)
        assert job.run(spark, config) == job.BAD_INPUT


def test_a_run_that_fails_leaves_its_counts_and_all_violations(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    lines = [f"text,{'positive' if i % 2 else f'label{i}'}" for i in range(60)]
    lines[1] += ",more"
    (tmp_path / "raw" / "dataset.csv").write_text("\n".join(["review,sentiment", *lines]) + "\n")
    config = RunConfig(str(tmp_path / "raw"), str(tmp_path / "out"), "r", persist=True)
    assert job.run(spark, config) == job.BAD_INPUT
    rows = {(r["event"], r["subject"]): r["value"] for r in read_audit(spark, config.audit_path).collect()}
    assert rows["rows", ""] == 60 and rows["other", "sentiment"] == 30
    assert rows["failed", str(job.BAD_INPUT)] == rows["malformed", ""] == 1
    assert spark.read.json(config.violations_path).count() == 30
    assert not (tmp_path / "out" / "_staging" / "r").exists()


def test_missing_input_gives_no_features(spark, tmp_path):
    config = RunConfig(str(tmp_path / "absent"), str(tmp_path / "out"), "r", persist=False)
    assert job.run(spark, config) == job.NO_FEATURES


def test_failed_training_gives_no_models(spark, tmp_path, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("training")

    tokens = type("Tokens", (), {"measured": {}})
    monkeypatch.setattr(job, "read_tokens", lambda *_, **__: tokens)
    monkeypatch.setattr(job, "compare_feature_sets", fail)
    config = RunConfig("in", str(tmp_path / "out"), "r", persist=False)
    assert job.run(spark, config) == job.NO_MODELS

    def fail_earlier(*_, **__):
        raise FeaturesFailed("features")

    monkeypatch.setattr(job, "compare_feature_sets", fail_earlier)
    assert job.run(spark, config) == job.NO_FEATURES


class Stoppable:
    stopped = False

    def stop(self):
        self.stopped = True


def test_settings_and_session_codes(monkeypatch):
    monkeypatch.delenv("REVIEWLAB_INPUT", raising=False)
    monkeypatch.delenv("REVIEWLAB_OUTPUT", raising=False)

    def broken():
        raise RuntimeError("no cluster")

    assert job.main([]) == job.BAD_CONFIG
    assert job.main(["in", "out"], session=broken) == job.NO_SESSION


def test_session_is_stopped_and_run_ids_are_fresh(monkeypatch):
    seen = []
    monkeypatch.setattr(job, "run", lambda spark, config, **_: seen.append(config) or job.NO_MODELS)
    session = Stoppable()
    assert job.main(["in", "out"], session=lambda: session) == job.NO_MODELS
    assert session.stopped
    job.main(["in", "out", "--no-persist"], session=Stoppable)
    job.main(["in", "out", "--run-id", "given"], session=Stoppable)
    assert seen[0].run_id != seen[1].run_id
    assert seen[2].run_id == "given"
    assert [c.persist for c in seen] == [True, False, True]
