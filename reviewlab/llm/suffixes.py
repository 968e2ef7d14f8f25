"""Exact removal of long repeated strings by deep-shallow suffix sorting.

A byte is removed if it lies in a string of ``length`` bytes that also starts somewhere
else in the corpus, in the same or another document. Only suffixes that can have a twin
are sorted: of every string of ``length`` bytes the gram with the smallest hash is its
anchor, so equal strings have their anchors at the same place.

1. One scan finds the anchors of each text, with a hash of the gram and one of its
   context: all bytes that a string of ``length`` around the gram can reach.
2. Grams that occur once are dropped. Equal contexts are twins as a whole.
3. Contexts that are unlike all others of their gram, and one of each of the others, are
   cut out. The suffixes from the gram on are sorted: multikey quicksort to a shallow
   depth, blind tries for the groups that are still equal there. The longest common
   prefixes with the sorted neighbours, and the same for the bytes before the gram, tell
   which strings of ``length`` have a twin; these cover both.
4. The covered stretches of a document are merged and cut out of its text.

Grams and contexts are counted before they are exchanged. A gram with very many
different contexts is dealt into blocks, which are compared pair by pair, so no gram
needs a large task. Null texts are empty. Texts shorter than ``length`` keep all bytes;
equal rows repeat each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.words import _BYTES, mix, powers, span_hashes, texts
from reviewlab.scratch import stage

LENGTH, GRAM = 200, 40
# Depth beyond the gram to which suffixes are sorted by bytes; contexts of a block.
SHALLOW, BLOCK = 16, 4096
# Up to so many contexts are compared one by one.
FEW = 5
CHUNK = 1 << 23


def anchors(text: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all strings of ``length`` bytes, and the hashes of their grams."""
    places, hashes = [], []
    for base in range(0, max(len(text) - length + 1, 0), CHUNK):
        part = text[base : base + CHUNK + length - 1]
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * up[: len(part)], out=sums[1:])
        h = mix((sums[gram:] - sums[:-gram]) * down[: len(part) - gram + 1])
        width = length - gram + 1
        low = np.uint64((1 << 24) - 1)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        # Smallest key of every window, by running minima of blocks from both sides.
        rows = np.concatenate((key, np.full(-len(h) % width, 2**64 - 1, np.uint64))).reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(h) - width + 1
        at = np.minimum(back[:windows], ahead[width - 1 : len(h)]) & low
        at = np.unique(at[np.flatnonzero(np.diff(at, prepend=low))]).astype(np.int64)
        places.append(at + base)
        hashes.append(h[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[first]


def _scanned(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Per row its key, size and digest, and the anchors with grams and contexts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, digest, grams, contexts, places = [], [], [], [], []
            for body in texts(batch.column(2)):
                at, h = anchors(body, length, gram)
                left = np.maximum(at - (length - gram), 0)
                right = np.minimum(at + length, len(body))
                context = mix(span_hashes(body, left, at) + mix(span_hashes(body, at, right)))
                size.append(len(body))
                digest.append(hashlib.sha256(body).hexdigest())
                grams.append(h.view(np.int64))
                contexts.append(context.view(np.int64))
                places.append(at.astype(np.int32))
            yield pa.record_batch(
                [
                    *batch.columns[:2],
                    pa.array(size, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(grams, pa.list_(pa.int64())),
                    pa.array(contexts, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                ["id", "h", "n", "digest", "grams", "contexts", "places"],
            )

    return docs.mapInArrow(
        work,
        "id long, h long, n long, digest string, grams array<long>, contexts array<long>, places array<int>",
    )


def deep_shallow(strings: list[bytes], shallow: int) -> list[int]:
    """The order of the strings: by bytes up to a depth, by blind tries beyond it."""
    done: list[int] = []
    common = min((common_prefix(strings[0], s) for s in strings), default=0)
    todo = [(list(range(len(strings))), common)] if strings else []
    while todo:
        group, depth = todo.pop()
        if len(group) == 1:
            done += group
        elif depth >= shallow:
            done += _blind_trie(strings, group)
        else:
            sign = [strings[i][depth] if depth < len(strings[i]) else -1 for i in group]
            pivot = sign[len(sign) // 2]
            less = [i for i, s in zip(group, sign, strict=True) if s < pivot]
            same = [i for i, s in zip(group, sign, strict=True) if s == pivot]
            more = [i for i, s in zip(group, sign, strict=True) if s > pivot]
            for part, deeper in ((more, depth), (same, depth + 1 if pivot >= 0 else max(shallow, depth)), (less, depth)):
                if part:
                    todo.append((part, deeper))
    return done


def _blind_trie(strings: list[bytes], group: list[int]) -> list[int]:
    """A trie that knows only where branches part; each descent is checked at its leaf."""
    sign = lambda i, at: strings[i][at] if at < len(strings[i]) else -1
    root: list = [group[0]]  # a leaf: equal strings; a branch: (depth, {sign: node})
    for new in group[1:]:
        node = root
        while isinstance(node, tuple):
            node = node[1].get(sign(new, node[0])) or next(iter(node[1].values()))
        apart = common_prefix(strings[new], strings[node[0]])
        if apart == len(strings[new]) == len(strings[node[0]]):
            node.append(new)
            continue
        above, node = None, root
        while isinstance(node, tuple) and node[0] < apart:
            above, node = (node, sign(new, node[0])), node[1][sign(new, node[0])]
        if isinstance(node, tuple) and node[0] == apart:
            node[1][sign(new, apart)] = [new]
            continue
        other = node
        while isinstance(other, tuple):
            other = next(iter(other[1].values()))
        branch = (apart, {sign(other[0], apart): node, sign(new, apart): [new]})
        if above is None:
            root = branch
        else:
            above[0][1][above[1]] = branch
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):
            todo += [node[1][s] for s in sorted(node[1], reverse=True)]
        else:
            order += node
    return order


def common_prefix(a: bytes, b: bytes) -> int:
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def neighbours(strings: list[bytes], shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of each string in their order, and the common prefix of each with the next."""
    order = deep_shallow(strings, shallow)
    place = np.empty(len(order), int)
    place[order] = np.arange(len(order))
    common = [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]
    return place, np.array(common, int)


def agreements(rows: list[dict], length: int, gram: int) -> Iterator[tuple[int, int, int]]:
    """``context, before, after`` of the contexts of a gram that agree with another one:
    how many bytes before and from the gram on are covered.

    What follows the gram is sorted, and so is what stands before it, read backwards.
    Strings with the same first ``n`` bytes are neighbours there; a string of
    ``length`` that begins ``o`` bytes before the gram has a twin if some other context
    is in the same class on both sides, with ``o`` bytes on one and the rest on the other.
    """
    before = [r["body"][: r["before"]][::-1] for r in rows]
    after = [r["body"][r["before"] :] for r in rows]
    lone = [i for i, r in enumerate(rows) if r["lone"]]
    if len(rows) <= FEW:
        for i in lone:
            both = [(common_prefix(before[i], before[j]), common_prefix(after[i], after[j])) for j in range(len(rows)) if j != i]
            good = [(b, a) for b, a in both if a >= gram and a + b >= length]
            if good:
                yield rows[i]["context"], max(b for b, _ in good), max(a for _, a in good)
        return
    reach = np.arange(length - gram + 1)[:, None]
    same: np.ndarray | int = 0
    for strings, deep, wanted in ((before, SHALLOW, reach), (after, gram + SHALLOW, length - reach)):
        place, common = neighbours(strings, deep)
        classes = np.zeros((len(reach), len(rows)), np.int64)
        np.cumsum(common[None] < wanted, axis=1, out=classes[:, 1:])
        long = np.array([len(x) for x in strings])[None] >= wanted
        # A string that is too short is alone in its class.
        own = np.where(long, classes[:, place], len(rows) + np.arange(len(rows))[None])
        same = same * (2 * len(rows)) + own
    flat = (same + reach * (2 * len(rows)) ** 2).ravel()
    order = np.argsort(flat, kind="stable")
    equal = flat[order[1:]] == flat[order[:-1]]
    twin = np.zeros(len(flat), bool)
    twin[order[1:][equal]] = True
    twin[order[:-1][equal]] = True
    twin = twin.reshape(same.shape)
    for i in lone:
        offsets = np.flatnonzero(twin[:, i])
        if len(offsets):
            yield rows[i]["context"], int(offsets[-1]), int(length - offsets[0])


def _covered(blocks: DataFrame, length: int, gram: int) -> DataFrame:
    """``gram, context, before, after`` for rows of contexts ``xs`` and perhaps ``ys``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for g, xs, ys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = list({r["context"]: r for r in [*xs, *(ys or ())]}.values())
                for found in agreements(rows, length, gram):
                    for column, value in zip(out, (g, *found), strict=True):
                        column.append(value)
            yield pa.record_batch(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())],
                ["gram", "context", "before", "after"],
            )

    return blocks.select("gram", "xs", "ys").mapInArrow(work, "gram long, context long, before int, after int")


def _cut_out(held: DataFrame, length: int, gram: int) -> DataFrame:
    """The bytes of the wanted contexts of documents ``text, wanted``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).flatten()
            owner = np.repeat(np.arange(batch.num_rows), [len(w) for w in batch.column(1)])
            at = wanted.field("place").to_numpy()
            bodies = list(texts(batch.column(0)))
            left = np.maximum(at - (length - gram), 0)
            cut = [bodies[o][lo : a + length].tobytes() for o, lo, a in zip(owner, left, at, strict=True)]
            yield pa.record_batch(
                [*(wanted.field(c) for c in ("gram", "context", "lone", "part", "parts")), pa.array((at - left).astype(np.int32)), pa.array(cut, pa.binary())],
                ["gram", "context", "lone", "part", "parts", "before", "body"],
            )

    return held.select("text", "wanted").mapInArrow(
        work, "gram long, context long, lone boolean, part int, parts int, before int, body binary"
    )


def _shortened(held: DataFrame) -> DataFrame:
    """``id, h, n_removed, n_spans, kept_sha256`` of documents ``id, h, text, spans``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digest = [], [], []
            for body, cuts in zip(texts(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                edge = np.zeros(len(body) + 1, np.int32)
                np.add.at(edge, [max(c["lo"], 0) for c in cuts], 1)
                np.add.at(edge, [min(c["hi"], len(body)) for c in cuts], -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                digest.append(hashlib.sha256(body[~gone]).hexdigest())
            yield pa.record_batch(
                [*batch.columns[:2], pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())],
                ["id", "h", "n_removed", "n_spans", "kept_sha256"],
            )

    return held.select("id", "h", "text", "spans").mapInArrow(
        work, "id long, h long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` per document."""
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(body).alias("h"), body.alias("text"))
    scan = stage(
        _scanned(source, length, gram).withColumn("doc", F.monotonically_increasing_id()), "anchors"
    )
    every = scan.select("doc", F.explode(F.arrays_zip("grams", "contexts", "places")).alias("a")).select(
        F.col("a.grams").alias("gram"), F.col("a.contexts").alias("context"), "doc", F.col("a.places").alias("place")
    )
    often = every.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    hits = stage(every.join(often, "gram"), "repeated")
    contexts = stage(
        hits.groupBy("gram", "context").agg(
            F.count("*").alias("n"), F.min(F.struct("doc", "place")).alias("owner")
        ),
        "contexts",
    )
    # Contexts without a twin, and one of each of the others of their gram.
    open_grams = (
        contexts.groupBy("gram")
        .agg(F.count("*").alias("m"), F.min("n").alias("least"))
        .where("m > 1 and least = 1")
        .select("gram", F.ceil(F.col("m") / BLOCK).cast("int").alias("parts"))
    )
    wanted = (
        contexts.join(open_grams, "gram")
        .select(
            "owner.doc",
            F.struct(
                "gram",
                "context",
                "owner.place",
                (F.col("n") == 1).alias("lone"),
                F.pmod(F.xxhash64("context"), F.col("parts")).cast("int").alias("part"),
                "parts",
            ).alias("w"),
        )
        .groupBy("doc")
        .agg(F.collect_list("w").alias("wanted"))
    )
    keys = scan.select("doc", "id", "h")
    wanted = stage(wanted.join(keys, "doc").drop("doc"), "wanted")
    texts_of = lambda rows: source.join(
        rows.withColumnRenamed("id", "i").withColumnRenamed("h", "hh"),
        F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("hh")),
    )
    pieces = _cut_out(texts_of(wanted), length, gram)
    blocks = stage(
        pieces.groupBy("gram", "part", "parts").agg(
            F.collect_list(F.struct("context", "lone", "before", "body")).alias("xs")
        ),
        "blocks",
    )
    single = blocks.where("parts = 1").select("gram", "xs", F.lit(None).cast(blocks.schema["xs"].dataType).alias("ys"))
    many = blocks.where("parts > 1")
    pairs = many.alias("x").join(
        many.alias("y"), (F.col("x.gram") == F.col("y.gram")) & (F.col("x.part") < F.col("y.part"))
    )
    pairs = pairs.select("x.gram", F.col("x.xs").alias("xs"), F.col("y.xs").alias("ys"))
    agree = (
        _covered(single.unionByName(pairs), length, gram)
        .groupBy("gram", "context")
        .agg(F.max("before").alias("before"), F.max("after").alias("after"))
    )
    twins = contexts.where("n > 1").select(
        "gram", "context", F.lit(length - gram).alias("before"), F.lit(length).alias("after")
    )
    reach = stage(agree.unionByName(twins), "reach")
    spans = (
        hits.join(reach, ["gram", "context"])
        .groupBy("doc")
        .agg(
            F.collect_list(
                F.struct(
                    (F.col("place") - F.col("before")).alias("lo"), (F.col("place") + F.col("after")).alias("hi")
                )
            ).alias("spans")
        )
    )
    spans = stage(spans.join(keys, "doc").drop("doc").dropDuplicates(["id", "h"]), "spans")
    cut = _shortened(texts_of(spans)).dropDuplicates(["id", "h"])
    found = scan.alias("s").join(
        cut.alias("c"), F.col("s.id").eqNullSafe(F.col("c.id")) & (F.col("s.h") == F.col("c.h")), "left"
    )
    return found.select(
        F.col("s.id").alias(id),
        F.col("n").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"),
    )
