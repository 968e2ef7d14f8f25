"""Sharding, url filters and web archives on small inputs with odd rows."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from reviewlab.llm import catalog, sharding, urls, warc

DOCS = "doc_id bigint, text string, bucket string, record int"
ROWS = [(i, f"text {i % 7}" * (i % 5), "b", i) for i in range(60)]
ROWS += [(None, None, None, None), (3, "text 3" * 3, "b", 3), (99, "x" * 300_000, "b", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture
def stored(docs, tmp_path):
    path = str(tmp_path / "docs")
    docs.repartition(3).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def test_shards_hold_every_row_once_and_equally_many(stored):
    shuffle = sharding.shuffled(stored, bucket_bytes=2000)
    assert shuffle.select("bucket").distinct().count() > 20
    rows = sharding.sharded(shuffle, 8).collect()
    assert Counter(tuple(r.record) for r in rows) == Counter(ROWS)
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_same_seed_same_order_other_seed_another(stored):
    def order(seed):
        rows = sharding.sharded(sharding.shuffled(stored, seed=seed, bucket_bytes=4000), 1).collect()
        return [r.record.doc_id for r in sorted(rows, key=lambda r: r.slot)]

    assert order(1) == order(1) != order(2)
    assert order(1) != sorted(order(1), key=lambda x: x or 0)


def test_blocks_of_bucket_ranks_add_up(stored, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 3)
    rows = sharding.sharded(sharding.shuffled(stored, bucket_bytes=2000), 1).collect()
    assert sorted(r.slot for r in rows) == list(range(len(ROWS)))


def test_equal_rows_spread_over_buckets(spark, tmp_path):
    path = str(tmp_path / "same")
    spark.createDataFrame([(1, "same", "b", 0)] * 500, DOCS).write.parquet(path)
    shuffle = sharding.shuffled(spark.read.parquet(path), bucket_bytes=4000)
    sizes = [r["count"] for r in shuffle.groupBy("bucket").count().collect()]
    assert len(sizes) > 5 and max(sizes) < 250


def test_no_rows_no_shards(docs):
    assert sharding.sharded(sharding.shuffled(docs.where("false")), 8).count() == 0


RULES = [*catalog.URL_RULES, ("block", "a.b", "/x"), ("allow", "a.b", "/x/y"), ("allow", "b", "/x/"), ("block", "b", "/x/")]
URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://com",
    "http://com/",
    "HTTP://EXAMPLE.com/en/a?b#c",
    "https://www.Example.com/en/",
    "https://x.www.example.com/en/q",
    "https://notexample.com/en/q",
    "https://example.com/english",
    "http://a.net/es/",
    "http://a.net/es",
    "http://a.net?x=/es/",
    "http://q.a.b/xyz",
    "http://a.b/x/y/z",
    "http://c.b/x/",
    "a://b://com/fr/",
    "http://example.com:80/en/",
    "http://a.net/es/" + "p/" * 20_000,
    "http://ex\nample.com/en/\n",
]


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), v == "block", h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


@pytest.mark.parametrize("max_trie", [1000, 0])
def test_longest_rule_wins_by_trie_and_by_join(spark, max_trie):
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    table = spark.createDataFrame(
        [(i, u, "h", "v") for i, u in enumerate(URLS + URLS)], "n int, url string, host string, verdict string"
    )
    rows = urls.judged(table, rules, max_trie=max_trie).collect()
    assert len(rows) == 2 * len(URLS)
    for row in rows:
        assert (row.host, row.path, row.rule, row.verdict) == plain_verdict(row.row.url, RULES)


def test_no_urls_and_no_rules(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    table = spark.createDataFrame([("http://com/",)], "url string")
    assert [r.verdict for r in urls.judged(table, none, default="block").collect()] == ["block"]
    assert urls.judged(table.where("false"), none).count() == 0


PAGES = "id bigint, url string, payload binary, extra string"
# The magic of a member within payloads that do not shrink, so it stands in the archive too.
NOISE = bytes((i * i * 31 + i // 7) % 256 for i in range(3000))
PAYLOADS = [None, b"", b"a", b"a", b"same", b"same", b"same", NOISE, gzip.compress(NOISE), b"z" * 400_000]


def pages_of(spark):
    rows = [(i, f"http://h/{quote(str(i))}", p, "e") for i, p in enumerate(PAYLOADS)]
    return spark.createDataFrame([*rows, (6, "http://h/6", b"same", "e"), (None, None, b"same", "e")], PAGES)


def wanted(rows, min_bytes=0):
    out = []
    for r in rows:
        body = bytes(r.payload or b"")
        same = [x.id for x in rows if bytes(x.payload or b"") == body and x.id is not None]
        keeper = max(same, default=None) if len(body) >= min_bytes else r.id
        revisit = keeper is not None and keeper != r.id
        out.append(
            (
                f"urn:page:{'' if r.id is None else r.id}",
                "revisit" if revisit else "response",
                base64.b32encode(hashlib.sha1(body).digest()).decode(),
                f"urn:page:{keeper}" if revisit else None,
                len(body),
                None if revisit else body,
            )
        )
    return Counter(out)


def read(spark, path):
    rows = warc.read_archives(spark, path).collect()
    return Counter(
        (r.record_id, r.record_type, r.payload_digest, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload))
        for r in rows
    )


@pytest.mark.parametrize("min_bytes", [0, 2])
@pytest.mark.parametrize("split", ["128m", "512"])
def test_archives_give_back_every_page(spark, tmp_path, min_bytes, split):
    pages = pages_of(spark)
    path = str(tmp_path / "archive")
    warc.write_archives(warc.with_revisits(pages, min_bytes=min_bytes).coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert read(spark, path) == wanted(pages.collect(), min_bytes)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_archives_are_gzip_that_others_can_read(spark, tmp_path):
    path = tmp_path / "archive"
    warc.write_archives(warc.with_revisits(pages_of(spark)).coalesce(1), str(path))
    (file,) = path.glob("part-*")
    body = gzip.decompress(file.read_bytes())
    assert body.count(b"WARC/1.1\r\n") == len(PAYLOADS) + 2


def test_the_magic_inside_a_member_and_broken_members(spark, tmp_path):
    # Stored, not deflated: the payload stands in the member byte by byte.
    def member(id, payload):
        plain = warc._record(id, "http://h/", payload, hashlib.sha1(payload).hexdigest(), None, warc.DATE)
        return gzip.compress(gzip.decompress(plain), compresslevel=0, mtime=0)

    tricky = [warc.MAGIC * 3 + b"x" * 700 + warc.MAGIC + bytes(i) + warc.EMPTY_MEMBER for i in range(9)]
    whole = [member(i, p) for i, p in enumerate(tricky)]
    (tmp_path / "a.warc").write_bytes(b"".join(whole))
    (tmp_path / "a.warc.gz").write_bytes(b"".join(whole))
    rows = warc.read_archives(spark, str(tmp_path / "a.warc.gz"), split=False).collect()
    assert sorted(bytes(r.payload) for r in rows) == sorted(tricky)
    with pytest.raises(Exception, match="split=False"):
        warc.read_archives(spark, str(tmp_path / "a.warc.gz"))
    (tmp_path / "b.warc").write_bytes(b"junk" + whole[0] + whole[1][:-300] + whole[2])
    for split in ("128m", "300"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            rows = warc.read_archives(spark, str(tmp_path / "a.warc")).collect()
            assert sorted(bytes(r.payload) for r in rows) == sorted(tricky) and all(r.verified for r in rows)
            rows = warc.read_archives(spark, str(tmp_path / "b.warc")).collect()
            good = [bytes(r.payload) for r in rows if r.record_type == "response"]
            assert sorted(good) == sorted([tricky[0], tricky[2]])
            assert any(r.record_type == "damaged" for r in rows)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_no_pages_no_records(spark, tmp_path):
    path = str(tmp_path / "none")
    pages = warc.with_revisits(pages_of(spark).where(F.lit(False)))
    warc.write_archives(pages, path)
    assert warc.read_archives(spark, path).count() == 0
