from __future__ import annotations

import hashlib

import pytest
from conftest import made_reviews

from reviewlab import scratch
from reviewlab.contracts import REVIEWS, ContractError
from reviewlab.scratch import fresh_path, shared_folder, stage
from reviewlab.sources import manifest
from reviewlab.sources.delimited import dataset_path, header_of, read_reviews, write_reviews

MANIFEST = manifest.MANIFEST_DDL


def test_made_file(spark, review_csv):
    df = read_reviews(spark, str(review_csv))
    REVIEWS.check(df)
    assert sorted(tuple(r) for r in df.collect()) == sorted(
        tuple(r) for r in made_reviews(spark, 9).select("review", "sentiment").collect()
    )


def test_header_is_checked_unless_told_otherwise(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("txt,lab\na,positive\n")
    assert read_reviews(spark, str(path), enforce_schema=True).count() == 1
    with pytest.raises(Exception, match="header does not conform"):
        read_reviews(spark, str(path)).collect()
    assert header_of(spark, str(path)).columns == ["txt", "lab"]
    with pytest.raises(ContractError, match="no column review, sentiment"):
        REVIEWS.check_columns(header_of(spark, str(path)))


def test_short_long_and_empty_records(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('review,sentiment\nonly\na,b,c\n,\n"",""\n')
    rows = [tuple(r) for r in read_reviews(spark, str(path)).collect()]
    assert rows == [("only", None), ("a", "b"), (None, None), (None, None)]
    with pytest.raises(Exception, match="FAILFAST|[Mm]alformed"):
        read_reviews(spark, str(path), mode="FAILFAST").collect()


def test_quoted_newline_needs_multi_line(spark, tmp_path):
    df = spark.createDataFrame([("one\ntwo, \"x\"", "positive")], "review string, sentiment string")
    path = str(tmp_path / "m")
    write_reviews(df, path)
    assert read_reviews(spark, path, multi_line=True).collect() == df.collect()
    assert read_reviews(spark, path).count() == 2


def test_dataset_path():
    assert dataset_path("s3://b/raw/") == "s3://b/raw/dataset.csv"
    assert dataset_path("data") == "data/dataset.csv"
    assert dataset_path("data/other.csv") == "data/other.csv"
    assert dataset_path("data/*.csv") == "data/*.csv"


def test_file_digests_whatever_the_size(spark, tmp_path):
    contents = {"small": b"hello world\n", "big": b"a" * (10 << 20), "empty": b"", "a b%20c": b"x"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    rows = manifest.file_manifest(spark, str(tmp_path)).collect()
    got = {r["path"].rsplit("/", 1)[-1]: (r["length"], r["digest"]) for r in rows}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}


def test_an_empty_file_is_valid_and_a_path_found_twice_is_not(spark, tmp_path):
    (tmp_path / "empty").write_bytes(b"")
    found = manifest.file_manifest(spark, str(tmp_path))
    assert manifest.all_valid(found, found)
    twice = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 1, "z"), ("b", 1, "z")], MANIFEST)
    expected = spark.createDataFrame([("a", 1, "x"), ("b", 1, "z"), ("b", 1, "z")], MANIFEST)
    rows = manifest.verify(expected, twice).collect()
    assert sorted((r["path"], r["status"]) for r in rows) == [("a", "mismatch"), ("b", "ok")]


def test_status_of_expected_files(spark):
    expected = spark.createDataFrame(
        [("a", 1, "AA"), ("b", 1, "bb"), ("c", 1, "cc"), ("d", 1, None)], MANIFEST
    )
    actual = spark.createDataFrame([("a", 1, "aa"), ("b", 1, "xx"), ("d", 1, "dd")], MANIFEST)

    def statuses(**options):
        rows = manifest.verify(expected, actual, **options).collect()
        return {r["path"]: r["status"] for r in rows}

    assert statuses() == {"a": "ok", "b": "mismatch", "c": "missing", "d": "unchecked"}
    assert statuses(check_digest=False) == {
        "a": "unchecked",
        "b": "unchecked",
        "c": "missing",
        "d": "unchecked",
    }
    assert not manifest.all_valid(expected, actual)
    assert not manifest.all_valid(expected.where("path = 'b'"), actual)
    assert manifest.all_valid(expected.where("path = 'b'"), actual, check_digest=False)
    assert manifest.all_valid(expected.where("path = 'a'"), actual)


def test_pending(spark):
    offered = spark.createDataFrame([("a", 1, "aa"), ("b", 1, "b2"), ("c", 1, "cc")], MANIFEST)
    loaded = spark.createDataFrame([("a", 1, "aa"), ("b", 1, "b1")], MANIFEST)
    assert {r["path"] for r in manifest.pending(offered, loaded).collect()} == {"b", "c"}
    assert manifest.pending(offered, loaded, force=True).count() == 3
    empty = spark.createDataFrame([("a", None, None)], MANIFEST)
    assert manifest.pending(empty, empty).isEmpty()
    assert manifest.pending(empty, loaded).count() == 1


def test_load_is_idempotent_and_follows_changes(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()
    seen = []

    def put(name, *reviews):
        lines = ["review,sentiment", *(f"{r},positive" for r in reviews)]
        (source / name).write_text("\n".join(lines) + "\n")

    def load(**options):
        def read(paths):
            seen.append({p.rsplit("/", 1)[-1] for p in paths})
            return read_reviews(spark, paths)

        offered = manifest.file_manifest(spark, str(source))
        todo = manifest.load_pending(spark, read, offered, target, **options)
        current = manifest.current_rows(spark, target, offered)
        return todo.count(), sorted(r["review"] for r in current.collect())

    put("one.csv", "a", "b")
    assert load() == (1, ["a", "b"])
    assert load() == (0, ["a", "b"])
    put("two.csv", "c")
    assert load() == (1, ["a", "b", "c"])
    put("one.csv", "a", "changed")
    assert load() == (1, ["a", "c", "changed"])
    assert load(force=True) == (2, ["a", "c", "changed"])
    assert seen == [{"one.csv"}, {"two.csv"}, {"one.csv"}, {"one.csv", "two.csv"}]
    # A forced load leaves the rows of files that are gone.
    (source / "two.csv").unlink()
    assert load(force=True) == (1, ["a", "changed"])
    assert spark.read.parquet(target).count() == 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    staged = stage(spark.range(3), "x")
    assert staged.count() == 3
    assert staged.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(
        shared_folder(spark).lstrip("/")
    )


def test_own_folder_on_a_local_master_only(spark, monkeypatch):
    monkeypatch.setattr(scratch, "SETTING", "reviewlab.not.set")
    own = shared_folder(spark)
    assert shared_folder(spark) == own != spark.conf.get("spark.checkpoint.dir")
    assert stage(spark.range(3), "x").count() == 3

    class OnCluster:
        conf = spark.conf
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="every executor"):
        shared_folder(OnCluster)


def test_a_run_stages_in_its_own_folder_and_removes_it(spark, tmp_path):
    folder = tmp_path / "out" / "_staging"
    with pytest.raises(KeyError), scratch.staging(spark, str(folder)):
        assert stage(spark.range(3), "x").count() == 3
        assert list(folder.iterdir())
        raise KeyError
    assert not folder.exists()
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_digests_by_ranges_cover_every_byte(spark, tmp_path):
    import hashlib

    files = {"empty.bin": b"", "one.bin": b"x", "even.bin": bytes(range(256)) * 2, "cut by%20its last.bin": b"ab" * 333}
    (tmp_path / "in").mkdir()
    for name, body in files.items():
        (tmp_path / "in" / name).write_bytes(body)
    whole = manifest.file_manifest(spark, str(tmp_path / "in")).collect()
    found = {r["path"].rsplit("/", 1)[1]: (r["length"], r["digest"]) for r in whole}
    assert found == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in files.items()}
    size = 128
    parts = manifest.file_manifest(spark, str(tmp_path / "in"), range_bytes=size).collect()
    found = {r["path"].rsplit("/", 1)[1]: (r["length"], r["digest"]) for r in parts}
    want = {}
    for name, body in files.items():
        each = [hashlib.sha256(body[i : i + size]).hexdigest() for i in range(0, max(len(body), 1), size)]
        want[name] = len(body), hashlib.sha256("".join(each).encode()).hexdigest()
    assert found == want


def test_pending_files_are_read_in_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "GROUP", 2)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(50).repartition(5).write.parquet(source)
    offered = manifest.file_manifest(spark, source, pattern="*.parquet")
    asked = []

    def read(paths):
        asked.append(len(paths))
        return spark.read.parquet(*paths)

    assert manifest.load_pending(spark, read, offered, target).count() == 5
    assert asked == [2, 2, 1] and spark.read.parquet(target).count() == 50
    assert manifest.load_pending(spark, read, offered, target).count() == 0 and len(asked) == 3
