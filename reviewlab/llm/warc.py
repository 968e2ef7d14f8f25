"""Web archives: one gzip member per record, written and read in splits by Spark.

Writing: Spark's text writer puts the members into files, so its commit protocol and
file systems apply. It needs something between two rows; that is an empty gzip member,
which a reader of members passes over.

Reading: Spark's text reader deals byte ranges to tasks and cuts them at the gzip magic;
what starts inside a range belongs to its task, which reads on to the next magic. Each
piece is a candidate: its header is decoded and its data inflated and checked. Where the
magic occurs inside a member, the pieces are joined again; if the range ends there,
the rest is a piece of the next range, and both meet in a second pass over the few such
pieces of a file. What never becomes a record is returned as ``damaged``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.scratch import stage

# How a gzip member with deflated data begins, and the member of no data.
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = MAGIC + bytes([0, 0, 0, 0, 0, 0, 3, 3]) + bytes(9)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
RECORD = (
    "record_id string, record_type string, target_uri string, payload_digest string, "
    "refers_to string, payload_bytes long, verified boolean, payload binary"
)
FIELDS = [part.split()[0] for part in RECORD.split(", ")]
LEFT = "path string, block long, place long, piece binary"


def with_revisits(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """``id, url, payload, sha1, refers_to`` for ``id, url, payload`` (null: empty).

    Of equal payloads of at least ``min_bytes`` bytes, the largest id is the response
    that the others refer to. Rows that share the largest id are all responses, and so
    are all if no copy has an id. Only payloads with several copies are joined: one
    row each, in a written table whose size Spark checks.
    """
    pages = pages.withColumn("payload", F.coalesce("payload", F.lit("").cast("binary")))
    pages = pages.withColumn("sha1", F.sha1("payload"))
    copies = (
        pages.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha1")
        .agg(F.max("id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1 and keeper is not null")
        .select("sha1", "keeper")
    )
    return pages.join(stage(copies, "keepers"), "sha1", "left").select(
        "id",
        "url",
        "payload",
        "sha1",
        F.when(~F.col("id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to"),
    )


def _record(id, url, payload: bytes, sha1: str, refers_to, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if id is None else id}>",
        "WARC-Target-URI": "".join((url or "").splitlines()),
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(body)}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n", compresslevel=4, mtime=0)


def write_archives(pages: DataFrame, path: str, *, date: str = DATE) -> None:
    """Archives of ``id, url, payload, sha1, refers_to`` in the folder ``path``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns), strict=True)
            yield pa.record_batch([pa.array([_record(*row, date) for row in rows], pa.binary())], ["member"])

    pages = pages.select("id", "url", "payload", "sha1", "refers_to")
    members = pages.mapInArrow(work, "member binary").select(F.col("member").cast("string"))
    members.write.option("encoding", "ISO-8859-1").option(
        "lineSep", EMPTY_MEMBER.decode("latin-1")
    ).text(path)


class _Members:
    """Joins pieces to members."""

    def __init__(self) -> None:
        self.pieces: list = []
        self.inflate = None
        self.content = b""

    def _more(self, piece: bytes) -> bool:
        """Whether the member goes on, or ends, with this piece."""
        try:
            self.content += self.inflate.decompress(piece)
        except zlib.error:
            return False
        return True

    def _starts(self, piece: bytes) -> bool:
        if len(piece) > 3 and piece[3] & 0xE0:
            return False
        self.inflate, self.content = zlib.decompressobj(31), b""
        return self._more(piece) and b"WARC/".startswith(self.content[:5])

    def feed(self, *queue: tuple) -> tuple[list, list]:
        """Takes tagged pieces; gives the contents of members that end, each with the tag
        and piece of its end, and the pieces that belong to none. If a member turns out to
        be broken, its later pieces may begin members of their own."""
        queue, done, lost = list(queue), [], []
        while queue:
            item = queue.pop(0)
            fits = self._more(item[1]) if self.pieces else self._starts(item[1])
            self.pieces.append(item)
            if not fits:
                lost.append(self.pieces[0])
                queue, self.pieces = self.pieces[1:] + queue, []
            elif self.inflate.eof:
                done.append((self.content, *item))
                self.pieces = []
        return done, lost

    def rest(self) -> list:
        left, self.pieces = self.pieces, []
        return left

    def finish(self) -> tuple[list, list]:
        """What the last, unfinished member leaves."""
        done, lost = [], []
        while left := self.rest():
            more, gone = self.feed(*left[1:])
            done += more
            lost += [left[0], *gone]
        return done, lost


def _parsed(content: bytes) -> tuple | None:
    """A record's fields, in the order of FIELDS; None for a member of no data."""
    head, _, rest = content.partition(b"\r\n\r\n")
    if not head:
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    size = fields.get("content-length", "")
    body = rest[: int(size)] if size.isdigit() else rest
    length = None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, body = body.partition(b"\r\n\r\n")
        for line in http.decode("latin-1").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            if name.strip().lower() == "content-length" and value.strip().isdigit():
                length = int(value)
    kind = fields.get("warc-type")
    digest = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    response = kind != "revisit"
    return (
        fields.get("warc-record-id", "").strip("<>") or None,
        kind,
        fields.get("warc-target-uri"),
        digest,
        fields.get("warc-refers-to", "").strip("<>") or None,
        len(body) if response or length is None else length,
        base64.b32encode(hashlib.sha1(body).digest()).decode() == digest if response else None,
        body if response else None,
    )


def _batch(rows: list[tuple], fields: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], fields)


RECORD_TYPES = [*[pa.string()] * 5, pa.int64(), pa.bool_(), pa.binary()]
LEFT_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.binary()]


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    """``path, block, piece``: what stands between two magics, by range of a file."""
    return (
        spark.read.option("encoding", "ISO-8859-1")
        .option("lineSep", MAGIC.decode("latin-1"))
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("piece"),
        )
    )


def _wholes(spark: SparkSession, path: str) -> DataFrame:
    """The same of whole files, one range each."""

    @F.arrow_udf("array<binary>")
    def pieces(column: pa.Array) -> pa.Array:
        return pa.array([c.split(MAGIC) for c in column.to_pylist()], pa.list_(pa.binary()))

    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.lit(0).cast("long").alias("block"), F.explode(pieces("content")).alias("piece"))


def read_archives(spark: SparkSession, path: str, *, split: bool = True) -> DataFrame:
    """All records below ``path``; see RECORD for the columns.

    Spark inflates files named ``.gz`` before anyone sees their members, so these are
    refused; ``split=False`` reads them, or any files, one task and up to 2 GB each.
    """
    ranges = _ranges(spark, path) if split else _wholes(spark, path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, at, place, sure = _Members(), None, 0, False
        for batch in batches:
            done, left = [], []
            for file, block, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if split and file.endswith(".gz"):
                    raise ValueError(f"{file}: read it with split=False")
                if (file, block) != at:
                    left += members.rest()
                    at, place, sure = (file, block), 0, block == 0
                place += 1
                if block == 0 and place == 1:
                    if piece:  # before the first magic of a file
                        left.append(((file, block, 0), piece))
                    continue
                ended, lost = members.feed(((*at, place), MAGIC + piece))
                left += lost
                for content, *end in ended:
                    if row := _parsed(content):
                        done.append((*row, None, None, None, None))
                        sure = True
                    elif not sure:
                        # A member of no data, or what looks like one in a record begun before.
                        left.append(end)
            yield _batch([*done, *[(*[None] * 8, *tag, p) for tag, p in left]], NAMES, TYPES)
        yield _batch([(*[None] * 8, *tag, p) for tag, p in members.rest()], NAMES, TYPES)

    NAMES = [*FIELDS, "path", "block", "place", "piece"]
    TYPES = [*RECORD_TYPES, *LEFT_TYPES]
    found = stage(ranges.mapInArrow(cut, f"{RECORD}, {LEFT}"), "records")

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("place", "ascending")])
        members = _Members()
        done, lost = members.feed(*((None, p) for p in table.column("piece").to_pylist()))
        for part, more in zip((done, lost), members.finish(), strict=True):
            part += more
        rows = [row for content, *_ in done if (row := _parsed(content))]
        rows += [(None, "damaged", None, None, None, len(p), None, p) for _, p in lost]
        return pa.Table.from_batches([_batch(rows, FIELDS, RECORD_TYPES)])

    parts = found.where("piece is not null").select("path", "block", "place", "piece")
    return (
        found.where("piece is null")
        .select(*FIELDS)
        .unionByName(parts.groupBy("path").applyInArrow(join, RECORD))
    )
