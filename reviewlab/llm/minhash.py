"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped links.

Each document's set of word shingles is hashed once; each of ``rows * bands`` bins keeps
its smallest hash, and empty bins borrow from a bin drawn by a fixed random order
(optimal densification). Documents that agree on the bins of a band share a bucket.

1. Texts with the same words are one node, whatever their number.
2. In each bucket the document with most bucket mates is the centre of a star; each
   document is linked to its best centre only, so there are fewer links than documents.
3. Links are confirmed on full shingle sets, and components are formed.
4. What stars can miss: two documents of one bucket that are still in different
   components. Only such documents are compared with each other, block by block.

With 5 rows and 40 bands a pair at 0.8 shares no bucket with a chance of 1e-7, and more
similar pairs with a smaller one.

Nulls and texts without words: empty set, linked with nothing. A null id: linked with
nothing, component null, kept. Rows of one id are judged by their own texts: nodes are
texts, not ids, and of several texts of a component under its smallest id one is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.graph import components
from reviewlab.llm.words import mix, normal_form, shingle_hashes, texts, word_hashes
from reviewlab.scratch import stage, temporaries

ROWS, BANDS = 5, 40
BLOCK = 256
# Bits of the table that says which texts are wanted: 4 MB, whatever the input.
WANTED_BITS = 1 << 25
PART = 8 * 4096


def donor_order(bins: int) -> np.ndarray:
    """For each bin, all bins in the order in which it borrows from them, itself first."""
    draw = np.random.Generator(np.random.PCG64(6)).random((bins, bins))
    np.fill_diagonal(draw, -1)
    return np.argsort(draw, axis=1)


def band_keys(shingles: np.ndarray, rows: int, bands: int, order: np.ndarray) -> np.ndarray:
    """One key per band of a non-empty array of sorted distinct hashes."""
    bins = rows * bands
    at = ((shingles >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(at, prepend=np.uint64(bins)))  # sorted: the first is the least
    full = np.zeros(bins, bool)
    least = np.zeros(bins, np.uint64)
    full[at[first]] = True
    least[at[first]] = shingles[first]
    donor = order[np.arange(bins), full[order].argmax(axis=1)]
    value = mix(least[donor]).reshape(bands, rows)
    key = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + value[:, i])
    return key


def signatures(docs: DataFrame, id: str, text: str, words: int, rows: int, bands: int) -> DataFrame:
    """``id, key, n_shingles, bands`` per document; no key without words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = donor_order(rows * bands)
        for batch in batches:
            keys, sizes, found = [], [], []
            for body in texts(batch.column(1)):
                hashes = word_hashes(body) if body is not None else ()
                if not len(hashes):
                    keys.append(None), sizes.append(0), found.append(None)
                    continue
                shingles = np.unique(shingle_hashes(hashes, words))
                keys.append(blake2b(normal_form(body), digest_size=16).digest())
                sizes.append(len(shingles))
                found.append(band_keys(shingles, rows, bands, order).view(np.int64))
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["id", "h", "key", "n_shingles", "bands"],
            )

    return _named(docs, id, text).mapInArrow(
        work, "id long, h long, key binary, n_shingles long, bands array<long>"
    )


def _named(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id, text`` and ``h``, a hash that tells rows of one id apart."""
    return docs.select(
        F.col(id).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h")
    )


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` for documents ``node, text``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                np.unique(shingle_hashes(word_hashes(body), words)).view(np.int64)
                for body in texts(batch.column(1))
            ]
            yield pa.record_batch(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"]
            )

    return docs.select("node", "text").mapInArrow(work, "node long, shingles array<long>")


def near_duplicates(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """``id, n_shingles, component_id, kept, text_hash`` per document.

    Documents are linked if ``100 * common shingles >= percent * all shingles``; the
    component is the smallest id that can be reached, and that document is kept.
    """
    signs = stage(signatures(docs, id, text, words, rows, bands), "signatures")
    places = _places(signs, _named(docs, id, text), words, percent)
    own = (F.col("id") == F.col("first.id")) & (F.col("h") == F.col("first.h"))
    return signs.join(places, "key", "left").select(
        F.col("id").alias(id),
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("first.id", "id")).alias("component_id"),
        F.col("h").alias("text_hash"),
        (F.col("id").isNull() | F.col("first").isNull() | own).alias("kept"),
    )


def _places(signs: DataFrame, source: DataFrame, words: int, percent: int) -> DataFrame:
    """``key, first``: the first document of the component of each text."""
    with temporaries() as passing:
        # A node is numbered, as ids can repeat; its document is the first of its text.
        nodes = passing(
            signs.where("key is not null and id is not null")
            .groupBy("key")
            .agg(
                F.min(F.struct("id", "h")).alias("doc"),
                F.first("n_shingles").alias("n"),
                F.first("bands").alias("bands"),
            )
            .withColumn("node", F.monotonically_increasing_id()),
            "nodes",
        )
        mates = passing(_bucket_mates(nodes), "buckets")
        wanted = passing(
            nodes.join(mates.select("node").distinct(), "node", "left_semi").select("node", "doc.id", "doc.h"),
            "wanted",
        )
        likely = _likely(source.where("text is not null"), wanted)
        sets = passing(
            shingle_sets(likely.join(wanted, ["id", "h"]).dropDuplicates(["id", "h"]), words), "shingles"
        )
        stars = _stars(mates, sets, percent)
        roots = components(stars)
        rest = _between(mates, roots, sets, percent)
        roots = roots if rest.isEmpty() else passing(_joined(roots, rest), "roots")
        linked = roots.join(nodes.select("node", "doc"), "node")
        first = linked.groupBy("root").agg(F.min("doc").alias("first"))
        linked = roots.join(first, "root").select("node", "first")
        found = nodes.join(linked, "node", "left").select("key", F.coalesce("first", "doc").alias("first"))
        return stage(found, "places")


def _likely(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``source`` that can be among ``wanted``, found where they lie.

    A bit table of fixed size, one bit per hashed id and text, goes to every task, so
    the texts that nobody needs are not exchanged. Where bits are shared, more rows
    than needed stay; the exact join comes after.
    """
    place = F.pmod(F.xxhash64("id", "h"), F.lit(WANTED_BITS))
    part, bit = F.floor(place / PART), place % PART
    bits = (
        wanted.select(part.alias("part"), bit.alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = source.withColumn("part", part).join(F.broadcast(bits), "part")
    return found.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(source.columns)


def deduplicated(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept; of equal rows, and of equal texts without an id, one."""
    judged = near_duplicates(docs, id=id, text=text, **options)
    gone = stage(judged.where("not kept").select(F.col(id).alias("i"), F.col("text_hash").alias("h")), "gone")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id).cast("long").alias("i"),
        F.xxhash64(text).alias("h"),
    )
    return rows.join(gone, ["i", "h"], "left_anti").dropDuplicates(["i", "h"]).select("row.*")


def _bucket_mates(nodes: DataFrame) -> DataFrame:
    """``bucket, node, n, size``: the documents of buckets of two or more."""
    placed = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return placed.join(shared, "bucket")


def _stars(mates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each document and the best centre among its buckets, confirmed."""
    with temporaries() as passing:
        rank = mates.groupBy("node").agg(F.sum("size").alias("rank"))
        ranked = passing(
            mates.join(rank, "node").select(
                "bucket", F.struct("rank", F.negative("node").alias("order"), "node", "n").alias("me")
            ),
            "ranked",
        )
        centres = ranked.groupBy("bucket").agg(F.max("me").alias("centre"))
        pairs = (
            ranked.join(centres, "bucket")
            .where("centre > me")
            .groupBy("me.node", "me.n")
            .agg(F.max("centre").alias("c"))
            .select(
                F.col("c.node").alias("a"),
                F.col("node").alias("b"),
                F.col("c.n").alias("na"),
                F.col("n").alias("nb"),
            )
        )
        return stage(confirmed(pairs, sets, percent), "stars")


def _between(mates: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between bucket mates of different components, confirmed on full sets.

    Shingles that occur in one component only can't be common to a pair, so the others
    bound what two documents have in common. Copies, and families of copies, that were
    changed too much to be linked with others fall away here. The rest is dealt into
    blocks of about BLOCK documents by the largest bucket they lie in, and blocks that
    share a bucket are compared, so a large bucket makes few rows and no large task.
    """
    with temporaries() as passing:
        placed = mates.join(roots, "node", "left").select(
            "bucket", "node", "n", F.coalesce("root", "node").alias("root")
        )
        placed = passing(_mixed(placed), "mixed")
        inner = sets.join(placed.select("node", "root").distinct(), "node").select(
            # 32 bits do: two shingles taken for one only raise the bound.
            "node", "root", F.explode(F.transform("shingles", lambda s: (s % (1 << 31)).cast("int"))).alias("s")
        )
        own = (
            inner.groupBy("s")
            .agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
            .where("lo = hi")
            .select("s")
        )
        alone = inner.join(own, "s").groupBy("node").agg(F.count("*").alias("alone"))
        placed = placed.join(passing(alone, "alone"), "node", "left").select(
            "bucket", "root", "node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("u")
        )
        placed = passing(_mixed(placed.where(F.col("u") * 100 >= F.col("n") * percent)), "mixed")

        homes = (
            placed.join(placed.groupBy("bucket").agg(F.count("*").alias("size")), "bucket")
            .groupBy("node")
            .agg(F.max(F.struct("size", "bucket")).alias("home"), *[F.first(c).alias(c) for c in ("root", "n", "u")])
            .select(
                "node",
                F.struct(
                    "home.bucket", F.pmod(F.xxhash64("node"), F.ceil(F.col("home.size") / BLOCK)).alias("part")
                ).alias("block"),
                F.struct("node", "root", "n", "u").alias("me"),
            )
        )
        # The size comes first, so of two blocks the smaller one is the one that is moved.
        sizes = homes.groupBy("block").agg(F.count("*").alias("size"))
        homes = passing(
            homes.join(sizes, "block").select("node", "me", F.struct("size", "block").alias("block")),
            "homes",
        )
        lying = placed.join(homes.select("node", "block"), "node").select("bucket", "block").distinct()
        pairs = (
            lying.alias("x")
            .join(lying.alias("y"), "bucket")
            .where("x.block <= y.block")
            .select(F.col("x.block").alias("xb"), F.col("y.block").alias("yb"))
            .distinct()
        )
        blocks = homes.join(sets, "node").groupBy("block").agg(
            F.collect_list(F.struct("me.*", "shingles")).alias("docs")
        )
        blocks = passing(blocks, "blocks")

        def linked(p: Column, q: Column) -> Column:
            sizes = p["n"] + q["n"]
            common = F.size(F.array_intersect(p["shingles"], q["shingles"]))
            return (
                (p["root"] != q["root"])
                & (F.least(p["n"], q["n"]) * 100 >= F.greatest(p["n"], q["n"]) * percent)
                & (F.least(p["u"], q["u"]) * (100 + percent) >= sizes * percent)
                & F.when(p["root"] != q["root"], common * (100 + percent) >= sizes * percent)
            )

        links = F.transform(
            "xs",
            lambda p: F.transform(
                F.filter("ys", lambda q: linked(p, q)),
                lambda q: F.struct(p["node"].alias("a"), q["node"].alias("b")),
            ),
        )
        found = (
            pairs.join(blocks.select(F.col("block").alias("xb"), F.col("docs").alias("xs")), "xb")
            .join(blocks.select(F.col("block").alias("yb"), F.col("docs").alias("ys")), "yb")
            .select(F.explode(F.flatten(links)).alias("link"))
            .select("link.a", "link.b")
            .distinct()
        )
        return stage(found, "rest")


def _mixed(placed: DataFrame) -> DataFrame:
    """What lies in buckets of two components or more."""
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    return placed.join(mixed.where("lo <> hi").select("bucket"), "bucket")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the pairs whose full sets are similar enough."""
    pairs = pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    both = (
        pairs.select("a", "b")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    )
    common = F.size(F.array_intersect("sa", "sb"))
    return (
        both.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("sizes"))
        .where(F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * percent)
        .select("a", "b")
    )


def _joined(roots: DataFrame, rest: DataFrame) -> DataFrame:
    """Roots once the links between components are added."""

    def root_of(side: str) -> DataFrame:
        return roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))

    between = (
        rest.join(root_of("a"), "a", "left")
        .join(root_of("b"), "b", "left")
        .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    )
    higher = components(between).select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(higher, "root", "left").select(
        "node", F.coalesce("top", "root").alias("root")
    )
    alone = higher.join(roots, higher["root"] == roots["node"], "left_anti")
    return moved.unionByName(
        alone.select(F.col("root").alias("node"), F.col("top").alias("root"))
    )
