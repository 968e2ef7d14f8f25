"""Prefix trie of conversations: a z-fast trie, built in batches by Spark joins.

A conversation is the sequence of its turns (role, text). Every prefix has a key: its
depth and a 128-bit hash, the exclusive-or of a hash of each turn with its place. The
compacted trie keeps the nodes where sequences part or end; a node stands for the prefixes
on the edge above it, of depth ``lo + 1`` to ``hi``. Its handle is the prefix whose depth
is the two-fattest number of that interval, the one that divides by the largest power of
two. So the handles make one table, and the node where a conversation leaves the trie is
found by fat binary search: in each of about ``log2(turns)`` rounds, an equi-join of the
two-fattest depths still possible with the handles.

1. ``prefixes``: keys of all prefixes. Turns are sorted over all tasks by conversation and
   place; each task sums up its own rows, and what a conversation has in earlier tasks is
   added from a table of one row per task border. No conversation has to fit in one task.
2. Conversations that end with the same key are one sequence.
3. ``insert``, batch by batch, each of about as many sequences as all before it: locate
   exits, add the points where sequences leave an edge and those where new ones part or
   end, and give the edges that were cut their new intervals and handles.
4. ``summed``: counts and sums over subtrees, by pointer doubling over compacted nodes.
5. ``nodes``: edges are expanded to a row per distinct prefix.

Nulls: a null conversation id is no conversation; null roles and texts are empty; null
turns come first. Turns of the same number stand in the order of role and text, equal rows
one after the other. Two prefixes share a key by chance with 2**-128. No rows: the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.scratch import discard, stage, temporaries

BATCHES = 3
KEY = ("depth", "h1", "h2")
# A node: its last prefix, a sequence it lies on, the depth of the node above, its handle, and
# the first prefix of its edge.
TRIE = ("hi", "h1", "h2", "rep", "lo", "f", "f1", "f2", "s1", "s2")
# Depths that an edge is expanded by at a time.
STRETCH = 4096


def running(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (``conv, h1, h2, bytes`` and what else they have) with running values.

    Sorted by ``conv`` and ``order``, ``place`` counts from 1, ``h1`` and ``h2`` are
    exclusive-ors and ``sum`` the sum of ``bytes``, up to and with the row itself.
    """
    others = [c for c in rows.columns if c not in ("conv", "h1", "h2", "bytes")]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    # Not order alone: equal rows in great number may be split, too.
    ordered = rows.repartitionByRange("conv", *order).sortWithinPartitions("conv", *order)
    ordered = ordered.select("conv", "h1", "h2", "bytes", *others, F.spark_partition_id().alias("task"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place, h1, h2, total = None, 0, np.int64(0), np.int64(0), 0
        for batch in batches:
            if not len(batch):
                continue
            conv = batch.column(0).to_numpy(zero_copy_only=False)
            new = np.append(conv[0] != last, conv[1:] != conv[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -1))
            # Rows that go on with the last one of the batch before have start -1.
            goes_on = start < 0
            at = np.where(goes_on, 0, start)
            xors, sums = [], None
            for column, carried in ((1, h1), (2, h2)):
                own = batch.column(column).to_numpy(zero_copy_only=False)
                acc = np.bitwise_xor.accumulate(own)
                before = np.append(np.int64(0), acc[:-1])
                xors.append(np.where(goes_on, acc ^ carried, acc ^ before[at]))
            own = batch.column(3).to_numpy(zero_copy_only=False)
            acc = np.cumsum(own)
            before = np.append(0, acc[:-1])
            sums = np.where(goes_on, acc + total, acc - before[at])
            places = np.arange(len(conv)) + 1 + np.where(goes_on, place, -at)
            last, place, h1, h2, total = conv[-1], places[-1], xors[0][-1], xors[1][-1], sums[-1]
            yield pa.record_batch(
                [
                    batch.column(0),
                    *[pa.array(x) for x in xors],
                    batch.column(3),
                    *[batch.column(i) for i in range(4, 4 + len(others) + 1)],
                    pa.array(places, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["conv", "h1", "h2", "bytes", *others, "task", "place", "sum"],
            )

    columns = "".join(f", {c} {kinds[c]}" for c in others)
    kind = f"conv long, h1 long, h2 long, bytes long{columns}, task int, place long, sum long"
    with temporaries() as passing:
        parts = passing(ordered.mapInArrow(work, kind), "parts")
        ends = parts.groupBy("conv", "task").agg(
            *[F.max_by(c, "place").alias(f"e{c}") for c in ("h1", "h2", "place", "sum")]
        )
        # Two rows at most for each border of two tasks.
        several = ends.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
        split = ends.join(F.broadcast(several), "conv")
        earlier = split.alias("a").join(split.alias("b"), "conv").where("b.task < a.task")
        carried = earlier.groupBy("conv", F.col("a.task").alias("task")).agg(
            F.bit_xor("b.eh1").alias("c1"),
            F.bit_xor("b.eh2").alias("c2"),
            F.sum("b.eplace").alias("cplace"),
            F.sum("b.esum").alias("csum"),
        )
        none = F.lit(0).cast("long")
        whole = parts.join(F.broadcast(carried), ["conv", "task"], "left").select(
            "conv",
            F.col("h1").bitwiseXOR(F.coalesce("c1", none)).alias("h1"),
            F.col("h2").bitwiseXOR(F.coalesce("c2", none)).alias("h2"),
            "bytes",
            *others,
            (F.col("place") + F.coalesce("cplace", none)).alias("place"),
            (F.col("sum") + F.coalesce("csum", none)).alias("sum"),
        )
        return stage(whole, "running")


def placed(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, place, t1, t2, bytes``: a row per turn, numbered from 1; texts as hashes."""
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    both = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = rows.select(
        "*",
        F.xxhash64(F.lit(1), both).alias("t1"),
        F.xxhash64(F.lit(2), F.reverse(both)).alias("t2"),
        F.octet_length("text").cast("long").alias("bytes"),
        F.lit(0).cast("long").alias("h1"),
        F.lit(0).cast("long").alias("h2"),
    )
    found = running(rows, ["turn", "role", "text"])
    return found.select("conv", "place", "t1", "t2", "bytes")


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv, depth, h1, h2, p1, p2, bytes, sum``: the key of each prefix and that before it.

    ``rows`` are ``conv, place, t1, t2, bytes``, places without gaps.
    """
    keyed = rows.select(
        "conv",
        "bytes",
        F.col("place").alias("at"),
        F.xxhash64("place", "t1").alias("x1"),
        F.xxhash64("t2", "place").alias("x2"),
    )
    found = running(keyed.withColumns({"h1": F.col("x1"), "h2": F.col("x2")}), ["at"])
    return found.select(
        "conv",
        F.col("place").alias("depth"),
        "h1",
        "h2",
        F.col("h1").bitwiseXOR(F.col("x1")).alias("p1"),
        F.col("h2").bitwiseXOR(F.col("x2")).alias("p2"),
        "bytes",
        "sum",
    )


def two_fattest(lo: Column, hi: Column) -> Column:
    """The number in ``lo + 1 .. hi`` that divides by the largest power of two; 0 for ``hi`` 0."""
    low = F.greatest(lo, F.lit(0).cast("long"))
    top = F.length(F.bin(low.bitwiseXOR(hi))) - 1
    power = F.pow(F.lit(2.0), top).cast("long")
    return F.when(hi > low, hi - F.pmod(hi, power)).otherwise(hi)


def _at(paths: DataFrame, **names: str) -> DataFrame:
    """The prefixes of ``paths`` for a join on ``conv`` and a depth."""
    return paths.select(*[F.col(c).alias(name) for c, name in names.items()])


def exits(trie: DataFrame, own: DataFrame, paths: DataFrame, ends: DataFrame, most: int) -> DataFrame:
    """Where sequences leave the trie: ``conv, n, full, edge, cut``.

    ``own`` are the prefixes of the sequences, ``ends`` (``conv, n``) their lengths, at most
    ``most``, and ``paths`` the prefixes of what the trie's nodes are named by. ``full`` is
    the depth of the deepest node that lies on the sequence as a whole, ``edge`` the node
    (``hi, h1, h2``) on whose edge the sequence goes on, null if none, and ``cut`` the depth
    of the last prefix that the trie has.
    """
    handles = trie.select(
        F.col("f").alias("probe"),
        F.col("f1").alias("h1"),
        F.col("f2").alias("h2"),
        F.struct("lo", "hi", F.col("h1").alias("e1"), F.col("h2").alias("e2")).alias("hit"),
    )
    zero = F.lit(0).cast("long")
    root = F.struct(zero.alias("lo"), zero.alias("hi"), zero.alias("e1"), zero.alias("e2"))
    state = ends.select("conv", "n", zero.alias("a"), F.col("n").alias("b"), root.alias("node"))
    keys = _at(own, conv="conv", depth="probe", h1="h1", h2="h2")
    # The power of two that divides the probe falls from round to round.
    for _ in range(int(most).bit_length()):
        hit = F.col("hit").isNotNull()
        probe = F.when(F.col("a") < F.col("b"), two_fattest(F.col("a"), F.col("b")))
        state = (
            state.withColumn("probe", probe)
            .join(keys, ["conv", "probe"], "left")
            .join(handles, ["probe", "h1", "h2"], "left")
            .select(
                "conv",
                "n",
                F.when(hit, F.col("hit.hi")).otherwise(F.col("a")).alias("a"),
                F.when(F.col("probe").isNull() | hit, F.col("b")).otherwise(F.col("probe") - 1).alias("b"),
                F.coalesce("hit", "node").alias("node"),
            )
        )
    whole = (F.col("node.hi") == 0) | (
        F.col("h1").eqNullSafe(F.col("node.e1")) & F.col("h2").eqNullSafe(F.col("node.e2"))
    )
    state = (
        state.withColumn("probe", F.col("node.hi"))
        .join(keys, ["conv", "probe"], "left")
        .select("conv", "n", F.when(whole, F.col("node.hi")).otherwise(F.col("node.lo")).alias("full"))
    )
    edges = trie.select(
        (F.col("lo") + 1).alias("probe"),
        F.col("s1").alias("h1"),
        F.col("s2").alias("h2"),
        F.struct("hi", F.col("h1").alias("h1"), F.col("h2").alias("h2")).alias("edge"),
        "rep",
    )
    state = (
        state.withColumn("probe", F.col("full") + 1)
        .join(keys, ["conv", "probe"], "left")
        .join(edges, ["probe", "h1", "h2"], "left")
        .select("conv", "n", "full", "edge", "rep")
    )
    on_edge = (
        state.where("edge is not null")
        .join(own.select("conv", *KEY), "conv")
        .where("depth > full and depth <= edge.hi")
        .join(_at(paths, conv="rep", depth="depth", h1="h1", h2="h2"), ["rep", "depth", "h1", "h2"])
        .groupBy("conv")
        .agg(F.max("depth").alias("cut"))
    )
    return state.join(on_edge, "conv", "left").select(
        "conv", "n", "full", "edge", F.coalesce("cut", "full").alias("cut")
    )


def insert(trie: DataFrame | None, paths: DataFrame, ends: DataFrame, most: int) -> DataFrame:
    """``trie`` with the sequences ``ends`` (``conv, n``); ``paths`` holds theirs and its own.

    From a trie that is its root (None) every sequence leaves at once.
    """
    with temporaries() as passing:
        own = passing(paths.join(ends.select("conv"), "conv", "left_semi"), "own")
        if trie is None:
            zero = F.lit(0).cast("long")
            state = ends.select("conv", "n", zero.alias("full"), zero.alias("cut"))
        else:
            state = passing(exits(trie, own, paths, ends, most), "exits")
        after = own.join(state.select("conv", "n", "cut"), "conv").where("depth >= cut")
        # Where a sequence ends, where it leaves the trie, and where new sequences part.
        points = after.where("depth = n or depth = cut").select("conv", *KEY)
        # The keys of two children differ in their hashes.
        child = F.struct("h1", "h2")
        parted = (
            after.where("depth > cut + 1")
            .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"))
            .agg(F.min("conv").alias("conv"), F.min(child).alias("x"), F.max(child).alias("y"))
            .where("x <> y")
            .select("conv", *KEY)
        )
        new = (
            points.unionByName(parted)
            .groupBy(*KEY)
            .agg(F.min("conv").alias("rep"))
        )
        if trie is not None:
            new = new.join(trie.select(F.col("hi").alias("depth"), "h1", "h2"), list(KEY), "left_anti")
        new = passing(new, "points")
        # The node above: of the new ones on the path of a sequence, and else its last old one.
        above = Window.partitionBy("conv").orderBy("depth")
        lows = (
            own.join(state.select("conv", "full"), "conv")
            .where("depth > full")
            .join(new.select(*KEY), list(KEY))
            .select(*KEY, F.coalesce(F.lag("depth").over(above), "full").alias("lo"))
            .groupBy(*KEY)
            .agg(F.max("lo").alias("lo"))
        )
        added = new.join(lows, list(KEY)).select(F.col("depth").alias("hi"), "h1", "h2", "rep", "lo")
        if trie is None:
            return stage(_with_handles(added, paths), "trie")
        shorter = (
            state.where("edge is not null and cut < edge.hi")
            .groupBy("edge.hi", "edge.h1", "edge.h2")
            .agg(F.max("cut").alias("low"))
        )
        kept = trie.join(shorter, ["hi", "h1", "h2"], "left")
        changed = kept.where("low is not null").select("hi", "h1", "h2", "rep", F.col("low").alias("lo"))
        same = kept.where("low is null").drop("low")
        return stage(same.unionByName(_with_handles(added.unionByName(changed), paths)), "trie")


def _with_handles(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """``nodes`` with the keys of their handle and of the first prefix of their edge."""
    fat = nodes.withColumns({"f": two_fattest(F.col("lo"), F.col("hi")), "s": F.col("lo") + 1})
    handle = _at(paths, conv="rep", depth="f", h1="f1", h2="f2")
    first = _at(paths, conv="rep", depth="s", h1="s1", h2="s2")
    return fat.join(handle, ["rep", "f"]).join(first, ["rep", "s"]).select(*TRIE)


def built(paths: DataFrame, ends: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The compacted trie of all sequences, without its root; each batch doubles it."""
    most = ends.agg(F.max("n")).first()[0] or 0
    trie = None
    # Of 2 ** (batches - 1) lots, one, one, two, four and so on.
    lot = F.pmod(F.xxhash64("conv", F.lit(3)), F.lit(1 << (batches - 1)))
    for i in range(batches):
        low, high = (1 << i) >> 1, 1 << i
        before, trie = trie, insert(trie, paths, ends.where((lot >= low) & (lot < high)), most)
        if before is not None:
            discard(before)
    return trie


def end_lists(ends: DataFrame) -> DataFrame:
    """``n, h1, h2, n_ends, conv, ends_sha256`` for the sequences of ``ends``.

    A digest of ids in order has to be taken in order: the ids of one sequence, 32 bytes
    each, stream through one task, which holds one batch of them.
    """
    ordered = ends.select("n", "h1", "h2", "conv").repartition("n", "h1", "h2")
    ordered = ordered.sortWithinPartitions("n", "h1", "h2", "conv")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, least, digest, done = None, 0, None, None, []
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            convs = batch.column(3).to_numpy()
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            for lo, hi in zip(starts, np.append(starts[1:], len(convs))):
                own = ",".join(map(str, convs[lo:hi].tolist()))
                if tuple(keys[lo]) == key:
                    digest.update(f",{own}".encode())
                    count += int(hi - lo)
                    continue
                if key is not None:
                    done.append((*key, count, least, digest.hexdigest()))
                key, count, least = tuple(keys[lo].tolist()), int(hi - lo), int(convs[lo])
                digest = hashlib.sha256(own.encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done])
                done = []
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, count, least, digest.hexdigest())))])

    names = ("n", "h1", "h2", "n_ends", "conv", "ends_sha256")
    return ordered.mapInArrow(work, "n long, h1 long, h2 long, n_ends long, conv long, ends_sha256 string")


def summed(nodes: DataFrame, adding: list[str], least: list[str]) -> DataFrame:
    """Sums and minima over the subtree of each node (``k``, ``up``: key, and that above).

    In each round a node takes what the nodes 1, 2, 4, ... steps below it have, and looks
    twice as far up: about as many rounds as the depth has binary digits.
    """
    nodes = stage(nodes, "subtrees")
    while not nodes.where("up is not null").isEmpty():
        below = (
            nodes.where("up is not null")
            .groupBy("up")
            .agg(*[F.sum(c).alias(f"b_{c}") for c in adding], *[F.min(c).alias(f"b_{c}") for c in least])
            .withColumnRenamed("up", "k")
        )
        further = nodes.select(F.col("k").alias("up"), F.col("up").alias("further"))
        none = F.lit(0).cast("long")
        found = (
            nodes.join(below, "k", "left")
            .join(further, "up", "left")
            .select(
                "k",
                F.col("further").alias("up"),
                *[(F.col(c) + F.coalesce(f"b_{c}", none)).alias(c) for c in adding],
                *[F.least(c, f"b_{c}").alias(c) for c in least],
            )
        )
        before, nodes = nodes, stage(found, "subtrees")
        discard(before)
    return nodes


def nodes(rows: DataFrame, members: DataFrame, batches: int = BATCHES) -> DataFrame:
    """A row per distinct prefix of the conversations ``members`` (``conv``).

    ``rows`` are ``conv, place, t1, t2, bytes``. Columns: ``conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    zero = F.lit(0).cast("long")
    with temporaries() as passing:
        every = prefixes(rows)
        last = every.groupBy("conv").agg(F.max_by(F.struct(F.col("depth").alias("n"), "h1", "h2", "sum"), "depth").alias("e"))
        ends = members.select("conv").distinct().join(last, "conv", "left").select(
            "conv", *[F.coalesce(f"e.{c}", zero).alias(c) for c in ("n", "h1", "h2", "sum")]
        )
        ends = passing(ends, "ends")
        distinct = ends.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("conv").alias("conv"))
        distinct = passing(distinct.select("conv", "n"), "sequences")
        paths = passing(every.join(distinct.select("conv"), "conv", "left_semi"), "paths")
        trie = built(paths, distinct, batches)

        # The root, and of each node the key of the one above and the bytes down to both.
        top = trie.sparkSession.range(1).select(
            *[zero.alias(c) for c in ("hi", "h1", "h2")],
            zero.alias("rep"),
            zero.alias("lo"),
            F.lit(None).cast("struct<hi:bigint,h1:bigint,h2:bigint>").alias("up"),
            zero.alias("sum_lo"),
            zero.alias("sum_hi"),
        )
        high = _at(paths, conv="rep", depth="hi", sum="sum_hi")
        low = _at(paths, conv="rep", depth="lo", h1="l1", h2="l2", sum="sum_lo")
        above = F.struct(
            F.col("lo").alias("hi"), F.coalesce("l1", zero).alias("h1"), F.coalesce("l2", zero).alias("h2")
        )
        compact = (
            trie.select("hi", "h1", "h2", "rep", "lo")
            .join(high, ["rep", "hi"])
            .join(low, ["rep", "lo"], "left")
            .select("hi", "h1", "h2", "rep", "lo", above.alias("up"), F.coalesce("sum_lo", zero).alias("sum_lo"), "sum_hi")
        )
        listed = end_lists(ends).withColumnRenamed("n", "hi")
        compact = top.unionByName(compact).join(listed, ["hi", "h1", "h2"], "left")
        compact = passing(
            compact.withColumn("k", F.struct("hi", "h1", "h2")).select(
                "k", "up", "rep", "lo", "hi", "sum_lo", "sum_hi", "conv", F.coalesce("n_ends", zero).alias("n_ends"), "ends_sha256"
            ),
            "compact",
        )
        children = compact.where("up is not null").groupBy(F.col("up").alias("k")).agg(F.count("*").alias("n_children"))
        compact = passing(compact.join(children, "k", "left").withColumn("n_children", F.coalesce("n_children", zero)), "parents")
        totals = summed(
            compact.select(
                "k",
                "up",
                F.col("n_ends").alias("n_convs"),
                (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                (F.col("n_ends") * F.col("sum_hi")).alias("all_bytes"),
                (F.col("sum_hi") - F.col("sum_lo")).alias("own_bytes"),
                "conv",
            ),
            ["n_convs", "n_leaves", "all_bytes", "own_bytes"],
            ["conv"],
        )
        compact = compact.drop("conv").join(totals.drop("up"), "k")
        parent = totals.select(F.col("k").alias("up"), F.col("conv").alias("parent"))
        compact = compact.join(parent, "up", "left")
        # Every depth of an edge, a stretch at a time.
        first = F.least(F.col("lo") + 1, F.col("hi"))
        starts = F.explode(F.sequence(first, F.col("hi"), F.lit(STRETCH).cast("long"))).alias("start")
        depths = F.explode(F.sequence("start", F.least(F.col("start") + STRETCH - 1, "hi"))).alias("depth")
        edges = compact.select("*", starts).select("*", depths)
        own = _at(paths, conv="rep", depth="depth", bytes="bytes", sum="sum")
        before = F.col("sum") - F.col("bytes")
        saved = (
            F.col("all_bytes")
            - F.col("n_convs") * before
            - (F.col("own_bytes") - (before - F.col("sum_lo")))
        )
        root_saved = F.col("all_bytes") - F.col("own_bytes")
        at_end = F.col("depth") == F.col("hi")
        found = edges.join(own, ["rep", "depth"], "left").select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.when(F.col("depth") > F.col("lo") + 1, F.col("conv")).otherwise(F.col("parent")).alias("parent_conv_id"),
            "n_convs",
            F.when(at_end, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
            "n_leaves",
            F.when(F.col("depth") > 0, saved).otherwise(root_saved).alias("saved_tokens"),
            F.when(at_end & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
        found = stage(found, "nodes")
        discard(trie, totals)
        return found
