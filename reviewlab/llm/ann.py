"""Approximate nearest neighbours by inner product: robust-pruned graphs over shards.

Equal vectors are one node (with their smallest ids), so very common vectors neither
crowd a graph nor a task. Nodes are dealt into shards by length, one power of two to a
shard, so that a few long vectors don't make all others alike, and then by hash; each
shard's graph is built in one task: greedy searches propose neighbours, and relaxed distance pruning
keeps those that no closer neighbour stands in for, so edges point in all directions.
Queries come in blocks; each block is searched in each shard with a beam, and the
nearest of all shards are kept.

Every vector gets one more component so that all have the same length; then the nearest
by distance are those of largest inner product. Scores are computed again on the given
vectors in double precision; one beyond its range is infinite, and ties with its like.

Vectors that are null, zero, or hold a null or non-finite component take no part, nor do
rows without an id; vectors of different sizes are not compared. Rows of one id and
different vectors are separate candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.scratch import stage

DEGREE, BEAM, ALPHA = 32, 96, 1.2
SHARD_ROWS, QUERY_ROWS = 8192, 1024
# Candidates expanded at once, nodes a search starts from, most insertions at once.
WIDE, ENTRIES, BATCH = 4, 16, 512
# Lists pruned at once.
LISTS = 128


def beam_search(
    queries: np.ndarray, vectors: np.ndarray, graph: np.ndarray, entries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``beam`` best nodes seen and their products, best first (-1: none)."""
    n = len(queries)
    seen = np.zeros((n, len(vectors)), bool)
    seen[:, entries] = True
    node = np.full((n, beam), -1)
    value = np.full((n, beam), -np.inf)
    done = np.zeros((n, beam), bool)
    start = entries[:beam]
    node[:, : len(start)], value[:, : len(start)] = start, queries @ vectors[start].T
    active = np.arange(n)
    while len(active):
        open_value = np.where(done[active] | (node[active] < 0), -np.inf, value[active])
        picks = np.argsort(-open_value, axis=1)[:, :WIDE]
        usable = np.take_along_axis(open_value, picks, 1) > -np.inf
        active, picks, usable = active[usable[:, 0]], picks[usable[:, 0]], usable[usable[:, 0]]
        if not len(active):
            break
        rows = active[:, None]
        done[rows, picks] |= usable
        near, product = [], []
        for w in range(picks.shape[1]):
            found = graph[np.where(usable[:, w], node[active, picks[:, w]], 0)].copy()
            found[~usable[:, w]] = -1
            found[(found >= 0) & seen[rows, found]] = -1
            at, col = np.nonzero(found >= 0)
            seen[active[at], found[at, col]] = True
            near.append(found)
            product.append(np.einsum("ard,ad->ar", vectors[found], queries[active], optimize=True))
        near, product = np.concatenate(near, axis=1), np.concatenate(product, axis=1)
        product[near < 0] = -np.inf
        nodes = np.concatenate((node[active], near), axis=1)
        values = np.concatenate((value[active], product), axis=1)
        dones = np.concatenate((done[active], np.zeros(near.shape, bool)), axis=1)
        best = np.argpartition(-values, beam - 1, axis=1)[:, :beam]
        node[active] = np.take_along_axis(nodes, best, 1)
        value[active] = np.take_along_axis(values, best, 1)
        done[active] = np.take_along_axis(dones, best, 1)
    order = np.argsort(-value, axis=1, kind="stable")
    node, value = np.take_along_axis(node, order, 1), np.take_along_axis(value, order, 1)
    node[~np.isfinite(value)] = -1
    return node, value


def robust_prune(centre: np.ndarray, near: np.ndarray, vectors: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Per row the neighbours kept of ``near`` (-1: none): the closest one, then the closest
    of those that are not ``alpha`` times closer to a kept one than to the centre."""
    parts = [
        _pruned(centre[lo : lo + LISTS], near[lo : lo + LISTS], vectors, degree, alpha)
        for lo in range(0, len(centre), LISTS)
    ]
    return np.concatenate(parts)


def _apart(body: np.ndarray, from_: np.ndarray) -> np.ndarray:
    """Squared distances, from differences: those of close vectors keep their digits."""
    gap = body - from_[:, None]
    return np.einsum("bcd,bcd->bc", gap, gap)


def _pruned(centre: np.ndarray, near: np.ndarray, vectors: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    body = vectors[near]
    apart = _apart(body, vectors[centre])
    apart[(near < 0) | (near == centre[:, None])] = np.inf
    kept = np.full((len(centre), degree), -1, np.int32)
    rows = np.arange(len(centre))
    for r in range(degree):
        pick = apart.argmin(axis=1)
        usable = np.isfinite(apart[rows, pick])
        if not usable.any():
            break
        kept[:, r] = np.where(usable, near[rows, pick], -1)
        between = _apart(body, body[rows, pick])
        apart[(alpha**2 * between <= apart) & usable[:, None]] = np.inf
        apart[rows, pick] = np.inf
    return kept


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """The graph of vectors of one length, and the nodes that searches start from."""
    n = len(vectors)
    order = np.random.Generator(np.random.PCG64(10)).permutation(n)
    entries = order[:ENTRIES]
    graph = np.full((n, degree), -1, np.int32)
    first = order[: 4 * ENTRIES]
    graph[first] = robust_prune(first, np.tile(first, (len(first), 1)), vectors, degree, alpha)
    at = len(first)
    while at < n:
        new = order[at : at + min(at, BATCH)]
        found, _ = beam_search(vectors[new], vectors, graph, entries, beam)
        graph[new] = robust_prune(new, found, vectors, degree, alpha)
        _add_reverse(new, graph, vectors, degree, alpha)
        at += len(new)
    return graph, entries


def _add_reverse(new: np.ndarray, graph: np.ndarray, vectors: np.ndarray, degree: int, alpha: float) -> None:
    """Edges back from the neighbours of new nodes; lists that grow too long are pruned."""
    at, col = np.nonzero(graph[new] >= 0)
    target, source = graph[new][at, col], new[at]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    nodes, begin, count = np.unique(target, return_index=True, return_counts=True)
    full, lists = [], []
    for node, lo, n in zip(nodes, begin, count, strict=True):
        has = graph[node][graph[node] >= 0]
        both = np.union1d(has, source[lo : lo + n])
        if len(both) <= degree:
            graph[node, : len(both)] = both
        else:
            full.append(node)
            lists.append(both)
    for lo in range(0, len(full), BATCH):
        part = lists[lo : lo + BATCH]
        near = np.full((len(part), max(map(len, part))), -1)
        for i, both in enumerate(part):
            near[i, : len(both)] = both
        centre = np.array(full[lo : lo + BATCH])
        graph[centre] = robust_prune(centre, near, vectors, degree, alpha)


def one_length(vectors: np.ndarray) -> np.ndarray:
    """The vectors with one more component that makes all of them equally long."""
    vectors = vectors / np.abs(vectors).max()  # squares of the largest components overflow
    square = (vectors**2).sum(axis=1)
    most = float(square.max())
    last = np.sqrt(np.maximum(most - square, 0))
    return np.concatenate((vectors, last[:, None]), axis=1) / np.sqrt(most)


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with components below 1, and the powers of two they were divided by."""
    power = np.frexp(np.abs(vectors).max(axis=1))[1]
    return np.ldexp(vectors, -power[:, None]), power


def octave(vector: str) -> Column:
    """The power of two below the length of a vector, which itself may be out of range."""
    most = F.array_max(F.transform(vector, F.abs))
    square = F.aggregate(vector, F.lit(0.0), lambda s, x: s + (x / most) * (x / most))
    return F.floor(F.log2(most) + F.log2(square) / 2).cast("long")


def usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """``id, v`` (doubles) and ``size`` of the vectors that take part."""
    rows = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & sound).where(
        F.exists("v", lambda x: x != 0)
    ).withColumn("size", F.size("v"))


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    *,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    beam: int = BEAM,
) -> DataFrame:
    """``query_id, rank, id, score`` of the ``k`` nearest found of all rows but the query's own."""
    least = Window.partitionBy("v").orderBy("id")
    nodes = stage(
        usable(rows, id, vector)
        .select("id", "v", "size", F.row_number().over(least).alias("place"))
        # Of equal vectors a query wants k at most besides its own.
        .where(F.col("place") <= k + 1)
        .groupBy("v", "size")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .withColumn("octave", octave("v")),
        "vectors",
    )
    shards = nodes.groupBy("size", "octave").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    asked = usable(queries, id, vector)
    blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def make_graph(table: pa.Table) -> pa.Table:
        table = table.sort_by("first")
        size = table.column("size")[0].as_py()
        v = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, size)
        graph, entries = build(one_length(v))
        return pa.table(
            {
                "size": pa.array([size], pa.int32()),
                "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
                "ids": pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
                "vectors": [v.tobytes()],
                "graph": [graph.tobytes()],
                "entries": [entries.astype(np.int64).tobytes()],
            }
        )

    graphs = stage(
        nodes.join(F.broadcast(shards), ["size", "octave"])
        .withColumn("first", F.col("ids")[0])
        .withColumn("shard", F.col("octave") * (1 << 40) + F.pmod(F.xxhash64("first"), "shards"))
        .groupBy("size", "shard")
        .applyInArrow(
            make_graph,
            "size int, shard long, ids array<array<bigint>>, vectors binary, graph binary, entries binary",
        ),
        "graphs",
    )

    def pack(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        v = table.column("v").combine_chunks().flatten().to_numpy()
        return pa.table(
            {
                "size": pa.array([size], pa.int32()),
                "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                "asked": [table.column("id").combine_chunks().to_numpy().tobytes()],
                "wanted": [v.tobytes()],
            }
        )

    packed = stage(
        asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        .groupBy("size", "block")
        .applyInArrow(pack, "size int, block int, asked binary, wanted binary"),
        "queries",
    )

    def search(table: pa.Table) -> pa.Table:
        row = {c: table.column(c)[0].as_py() for c in table.column_names}
        d = row["size"]
        v = np.frombuffer(row["vectors"]).reshape(-1, d)
        q = np.frombuffer(row["wanted"]).reshape(-1, d)
        asked = np.frombuffer(row["asked"], np.int64)
        graph = np.frombuffer(row["graph"], np.int32).reshape(len(v), -1)
        (v1, v_power), (q1, q_power) = scaled(v), scaled(q)
        length = np.sqrt((q1**2).sum(axis=1, keepdims=True))
        level = np.concatenate((q1 / length, np.zeros((len(q), 1))), axis=1)
        found, _ = beam_search(level, one_length(v), graph, np.frombuffer(row["entries"], np.int64), max(beam, k + 1))
        out: tuple[list, list, list] = ([], [], [])
        for i in range(len(q)):
            near = found[i][found[i] >= 0]
            with np.errstate(over="ignore"):
                scores = np.ldexp(v1[near] @ q1[i], v_power[near] + q_power[i])
            hits = [
                (-s, x) for s, node in zip(scores.tolist(), near, strict=True) for x in row["ids"][node] if x != asked[i]
            ]
            hits = sorted(hits)[:k]
            out[0].extend([asked[i]] * len(hits))
            out[1].extend(x for _, x in hits)
            out[2].extend(-s for s, _ in hits)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    tasks = packed.join(graphs.select("size", "shard"), "size").join(graphs, ["size", "shard"])
    found = tasks.groupBy("size", "shard", "block").applyInArrow(search, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )
