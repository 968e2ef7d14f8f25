"""SentencePiece encoding and decoding of whole texts with a given model file.

A text is cut into words, which no piece crosses: runs of blanks with what follows them,
and signs that no piece holds. The lattice of a word has an edge for each stretch of
bounded length that is in the piece table. A unigram model takes the best path through
the lattice (Viterbi); a BPE model, whose scores are ranks of merges, takes the path that
its merges lead to. Either gives the ids of the published library.

``with_pieces`` builds the lattices inside tasks, for the distinct words of a batch at once,
and remembers a bounded number of words; nothing is exchanged. ``encode_words`` is the
same for unigram models in DataFrame functions: stretches exploded, equi-joined to the
piece table, grouped by word, and folded by ``aggregate``.

Null texts have null pieces (number 0), empty texts none. Signs that the table lacks become bytes if
the model has byte pieces, else the unknown piece. Only models that do not rewrite texts
(identity normalizer, blanks kept, a blank put in front) are taken.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlab.llm.words import mix, span_hashes, texts

BLANK = "▁"
# Words remembered by a task; words of more signs are folded one by one.
REMEMBERED, LONG = 400_000, 40
# Bytes of texts whose words are looked up together; words in a table of edges.
TOGETHER, TABLE = 1_500_000, 4096
LOOKUP_BITS = 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


@dataclass
class Model:
    """Pieces by id; ``kind`` is ``bpe`` or ``unigram``; ``usable`` pieces are matched."""

    kind: str
    pieces: list[str]
    scores: list[float]
    usable: list[bool]
    byte_ids: list[int]
    unknown: int


def read_model(path: str) -> Model:
    """A model file, read on the driver; its size is that of its vocabulary."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    kind = {1: "unigram", 2: "bpe"}.get(proto.trainer_spec.model_type)
    norm = proto.normalizer_spec
    plain = norm.name == "identity" and not norm.precompiled_charsmap and norm.add_dummy_prefix
    if not kind or not plain or norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError(f"{path}: not a plain bpe or unigram model")
    # Types of pieces, 1 normal, 2 unknown, 4 user-defined, 6 byte.
    types = [p.type for p in proto.pieces]
    if 4 in types or any(BLANK in p.piece.lstrip(BLANK) for p in proto.pieces):
        raise ValueError(f"{path}: pieces that cross words")
    return Model(
        kind,
        [p.piece for p in proto.pieces],
        [p.score for p in proto.pieces],
        [t == 1 for t in types],
        [i for i, t in enumerate(types) if t == 6],
        types.index(2),
    )


class Lattice:
    """The piece table of a model, and the paths of words through it."""

    def __init__(self, model: Model) -> None:
        self.model = model
        kept = [i for i, u in enumerate(model.usable) if u]
        words = [model.pieces[i] for i in kept]
        self.longest = max(map(len, words), default=1)
        up = np.ones(LONG + self.longest + 1, np.uint64)
        up[1:] = np.cumprod(np.full(len(up) - 1, _BASE, np.uint64))
        down = np.ones_like(up)
        down[1:] = np.cumprod(np.full(len(up) - 1, _INVERSE, np.uint64))
        self.up, self.down = up, down
        key = np.array([self._hash(w) for w in words], np.uint64)
        order = np.argsort(key)
        self.key = key[order]
        self.id = np.array(kept, np.int32)[order]
        self.score = np.array([model.scores[i] for i in kept], np.float32)[order]
        prefix = (self.key >> np.uint64(64 - LOOKUP_BITS)).astype(np.int64)
        self.first = np.searchsorted(prefix, np.arange(1 << LOOKUP_BITS))
        self.probes = int(np.bincount(prefix).max())
        self.single = {model.pieces[i]: i for i in kept if len(model.pieces[i]) == 1}
        self.table = {w: i for w, i in zip(words, kept, strict=True)}
        self.lowest = min((model.scores[i] for i in kept), default=0.0) - 10
        signs = set("".join(words))
        # Signs that no piece holds stand alone; control signs are the frequent ones.
        self.lone = np.array([i < 32 and chr(i) not in signs for i in range(256)])

    def _hash(self, word: str) -> np.uint64:
        code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
        total = (mix(code + np.uint64(1)) * self.up[: len(code)]).sum(dtype=np.uint64)
        return mix(np.array([total + np.uint64(len(code))], np.uint64))[0]

    def words(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts in a row, each with a blank put in front, where words start in it, and
        how many words each text has."""
        bodies = [b" " + b.replace(BLANK.encode(), b" ") if b else b"" for b in bodies]
        line = np.frombuffer(b"".join(bodies), np.uint8)
        sizes = np.array([len(b) for b in bodies])
        blank, lone = line == 32, self.lone[line]
        start = lone | blank
        start[1:] = lone[1:] | lone[:-1] | (blank[1:] & ~blank[:-1])
        first = np.cumsum(sizes) - sizes
        start[first[sizes > 0]] = True
        at = np.flatnonzero(start)
        return line, at, np.diff(np.searchsorted(at, np.append(first, len(line))))

    def edges(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores (-inf: no piece) and ids by word, start and length, of words of ``n`` signs."""
        code = np.frombuffer("".join(words).replace(" ", BLANK).encode("utf-32-le"), np.uint32)
        code = mix(code.astype(np.uint64) + np.uint64(1)).reshape(len(words), n)
        sums = np.zeros((len(words), n + 1), np.uint64)
        np.cumsum(code * self.up[:n], axis=1, out=sums[:, 1:])
        score = np.full((len(words), n, self.longest + 1), -np.inf, np.float32)
        ids = np.full((len(words), n, self.longest + 1), -1, np.int32)
        for size in range(1, min(self.longest, n) + 1):
            starts = n - size + 1
            h = mix((sums[:, size:] - sums[:, :starts]) * self.down[:starts] + np.uint64(size))
            low = self.first[(h >> np.uint64(64 - LOOKUP_BITS)).astype(np.int64)]
            for probe in range(self.probes):
                at = np.minimum(low + probe, len(self.key) - 1)
                hit = self.key[at] == h
                row, col = np.nonzero(hit)
                score[row, col, size] = self.score[at[hit]]
                ids[row, col, size] = self.id[at[hit]]
        return score, ids

    def paths(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids in turn."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        parts: list[tuple] = []
        for n in np.unique(sizes):
            group = np.flatnonzero(sizes == n)
            for at in np.array_split(group, -(-len(group) // TABLE)):
                parts.append((at, *self._paths([words[i] for i in at], int(n))))
        count = np.zeros(len(words), np.int64)
        for at, n, _ in parts:
            count[at] = n
        end = np.cumsum(count)
        ids = np.zeros(int(end[-1]) if len(end) else 0, np.int32)
        for at, n, chosen in parts:
            ids[stretches(end[at] - n, n)] = chosen
        return count, ids

    def _paths(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of ``n`` signs."""
        if n > LONG:
            found = [self._long(w) for w in words]
            return np.array([len(f) for f in found]), np.array([i for f in found for i in f], np.int32)
        score, ids = self.edges(words, n)
        ends = _merged(score) if self.model.kind == "bpe" else _viterbi(score, self.lowest)
        row, start = np.nonzero(ends)
        chosen = ids[row, start, ends[row, start] - start]
        missing = np.flatnonzero(chosen < 0)
        if len(missing):
            spelled = [self.spelled(words[row[i]][start[i]]) for i in missing]
            more = np.ones(len(chosen), np.int64)
            more[missing] = [len(s) for s in spelled]
            row, chosen = np.repeat(row, more), np.repeat(chosen, more)
            chosen[chosen < 0] = [x for s in spelled for x in s]
        return np.bincount(row, minlength=len(words)), chosen

    def spelled(self, sign: str) -> list[int]:
        """A sign that the table lacks."""
        if self.model.byte_ids:
            return [self.model.byte_ids[b] for b in sign.encode()]
        return [self.model.unknown]

    def _long(self, word: str) -> list[int]:
        word = word.replace(" ", BLANK)
        stops = _merged_long(word, self) if self.model.kind == "bpe" else _viterbi_long(word, self)
        out, start = [], 0
        for stop in stops:
            piece = self.table.get(word[start:stop])
            out += [piece] if piece is not None else self.spelled(word[start:stop])
            start = stop
        return out


def _merged(score: np.ndarray) -> np.ndarray:
    """Where the piece that starts at a sign ends (0: none starts), after all merges.

    In each round the best pair of neighbours of every word is joined, the leftmost of
    equal ones, as long as a joined pair is a piece.
    """
    words, n, wide = score.shape
    after = np.tile(np.arange(1, n + 1), (words, 1))
    ends = after.copy()
    rows = np.arange(words)
    column = np.arange(n)[None]
    while len(rows) and n > 1:
        nxt = ends[rows]
        second = np.where((nxt > 0) & (nxt < n), nxt, 0)
        third = np.take_along_axis(nxt, second, 1)
        size = third - column
        usable = (second > 0) & (size < wide)
        value = np.where(usable, score[rows[:, None], column, np.where(usable, size, 0)], -np.inf)
        best = value.argmax(axis=1)
        going = value[np.arange(len(rows)), best] > -np.inf
        rows, best, nxt, third = rows[going], best[going], nxt[going], third[going]
        line = np.arange(len(rows))
        ends[rows, nxt[line, best]] = 0
        ends[rows, best] = third[line, best]
    return ends


def _viterbi(score: np.ndarray, lowest: float) -> np.ndarray:
    """Where the piece that starts at a sign ends (0: none starts), on the best path."""
    words, n, wide = score.shape
    first = score[:, :, 1]
    score[:, :, 1] = np.where(np.isfinite(first), first, lowest)
    best = np.full((words, n + 1), -np.inf, np.float32)
    best[:, 0] = 0
    back = np.zeros((words, n + 1), int)
    for stop in range(1, n + 1):
        starts = np.arange(max(0, stop - wide + 1), stop)
        value = best[:, starts] + score[:, starts, stop - starts]
        pick = value.argmax(axis=1)
        best[:, stop] = value[np.arange(words), pick]
        back[:, stop] = starts[pick]
    ends = np.zeros((words, n), int)
    at = np.full(words, n)
    while (at > 0).any():
        live = np.flatnonzero(at > 0)
        start = back[live, at[live]]
        ends[live, start] = at[live]
        at[live] = start
    return ends


def _merged_long(word: str, lattice: Lattice) -> list[int]:
    """The same merges with a heap, for one long word: stops of its pieces."""
    scores, n = lattice.model.scores, len(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    heap: list = []

    def offer(start: int) -> None:
        middle = after[start]
        if middle < n:
            piece = lattice.table.get(word[start : after[middle]])
            if piece is not None:
                heapq.heappush(heap, (-scores[piece], start, middle, after[middle]))

    for i in range(n):
        offer(i)
    gone = [False] * (n + 1)
    while heap:
        _, start, middle, stop = heapq.heappop(heap)
        if gone[start] or gone[middle] or after[start] != middle or after[middle] != stop:
            continue
        gone[middle] = True
        after[start] = stop
        before[stop if stop < n else n] = start
        offer(start)
        if start > 0:
            offer(before[start])
    stops, at = [], 0
    while at < n:
        at = after[at]
        stops.append(at)
    return stops


def _viterbi_long(word: str, lattice: Lattice) -> list[int]:
    best, back = [np.float32(0)], [0]
    for stop in range(1, len(word) + 1):
        found = []
        for start in range(max(0, stop - lattice.longest), stop):
            piece = lattice.table.get(word[start:stop])
            if piece is not None or stop - start == 1:
                score = lattice.model.scores[piece] if piece is not None else lattice.lowest
                found.append((best[start] + np.float32(score), -start))
        value, start = max(found)
        best.append(value)
        back.append(-start)
    stops, at = [], len(word)
    while at:
        stops.append(at)
        at = back[at]
    return stops[::-1]


def stretches(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of stretches, one after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class Known:
    """Paths of the words met so far, by hash, at most about REMEMBERED."""

    def __init__(self, lattice: Lattice) -> None:
        self.lattice = lattice
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.start, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, key: np.ndarray, words: list[str]) -> None:
        count, ids = self.lattice.paths(words)
        start = len(self.ids) + np.cumsum(count) - count
        order = np.argsort(np.concatenate((self.key, key)), kind="stable")
        self.key = np.concatenate((self.key, key))[order]
        self.start = np.concatenate((self.start, start))[order]
        self.count = np.concatenate((self.count, count))[order]
        self.ids = np.concatenate((self.ids, ids))

    def encode(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and all ids in turn."""
        line, at, words = self.lattice.words(bodies)
        if not len(at):
            return np.zeros(len(bodies), np.int64), np.zeros(0, np.int32)
        stop = np.append(at[1:], len(line))
        key, first, which = np.unique(span_hashes(line, at, stop), return_index=True, return_inverse=True)
        if len(self.key) > REMEMBERED:
            self.clear()
        place = np.searchsorted(self.key, key)
        fresh = np.ones(len(key), bool)
        inside = place < len(self.key)
        fresh[inside] = self.key[place[inside]] != key[inside]
        if fresh.any():
            text = line.tobytes()
            new = [text[at[i] : stop[i]].decode() for i in first[fresh]]
            self.add(key[fresh], new)
        place = np.searchsorted(self.key, key)[which]
        count = self.count[place]
        ids = self.ids[stretches(self.start[place], count)]
        ends = np.append(0, np.cumsum(count))
        last = np.cumsum(words)
        return ends[last] - ends[last - words], ids


class Spelling:
    """The bytes of each piece."""

    def __init__(self, m: Model) -> None:
        body = [p.replace(BLANK, " ").encode() if u else b"" for p, u in zip(m.pieces, m.usable, strict=True)]
        body[m.unknown] = " ⁇ ".encode()
        for value, i in enumerate(m.byte_ids):
            body[i] = bytes([value])
        self.table = np.frombuffer(b"".join(body), np.uint8)
        self.size = np.array([len(b) for b in body])
        self.start = np.cumsum(self.size) - self.size

    def decode(self, count: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """The texts of lists of ids, without the blank that was put in front."""
        size = self.size[ids]
        line = self.table[stretches(self.start[ids], size)].tobytes()
        stops = np.append(0, np.cumsum(size))[np.cumsum(count)].tolist()
        return [line[a:b].removeprefix(b" ") for a, b in zip([0, *stops[:-1]], stops, strict=True)]


ADDED = "pieces array<int>, n_pieces int, round_trip boolean"


def with_pieces(docs: DataFrame, model: Model, *, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the ids of the pieces, their number, and whether they decode to the text.

    Columns of these names are replaced. Texts are taken a few megabytes at a time.
    """
    added = StructType.fromDDL(ADDED)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added.names])
    place = docs.columns.index(text)
    out = StructType([f for f in docs.schema if keep_text or f.name != text] + added.fields)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        known, spelling = Known(Lattice(m)), Spelling(m)
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy())
            cuts = np.flatnonzero(np.diff(sizes // TOGETHER)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                column = part.column(place)
                bodies = [b"" if b is None else b.tobytes() for b in texts(column)]
                count, ids = known.encode(bodies)
                same = [a == b for a, b in zip(spelling.decode(count, ids), bodies, strict=True)]
                offsets = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
                kept = [part.column(i) for i in range(part.num_columns) if keep_text or i != place]
                yield pa.record_batch(
                    [
                        *kept,
                        pa.ListArray.from_arrays(offsets, pa.array(ids), mask=column.is_null()),
                        pa.array(count, pa.int32()),
                        pa.array(same, pa.bool_()),
                    ],
                    out.names,
                )

    return docs.mapInArrow(work, out)


def encoded(spark: SparkSession, text: Column, model: Model) -> Column:
    """The ids of the pieces of each text."""
    shared = spark.sparkContext.broadcast(vars(model))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Known(Lattice(Model(**shared.value)))
        for column in batches:
            count, ids = known.encode([b"" if b is None else b.tobytes() for b in texts(column)])
            offsets = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
            yield pa.ListArray.from_arrays(offsets, pa.array(ids), mask=column.is_null())

    return encode(text)


def decoded(spark: SparkSession, ids: Column, model: Model) -> Column:
    """The text of each list of ids; bytes that are no UTF-8 become replacement signs."""
    shared = spark.sparkContext.broadcast(vars(model))

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spelling = Spelling(Model(**shared.value))
        for column in batches:
            count = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            found = spelling.decode(count, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            missing = column.is_null().to_pylist()
            yield pa.array(
                [None if gone else t.decode("utf-8", "replace") for t, gone in zip(found, missing, strict=True)],
                pa.string(),
            )

    return decode(ids)


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """``piece, id, score`` of the pieces that are matched."""
    rows = [(p, i, float(s)) for i, (p, s, u) in enumerate(zip(model.pieces, model.scores, model.usable, strict=True)) if u]
    return spark.createDataFrame(rows, "piece string, id int, score double")


def encode_words(words: DataFrame, pieces: DataFrame, longest: int, lowest: float) -> DataFrame:
    """``word, ids`` of distinct words under a unigram model, in DataFrame functions.

    Stretches of at most ``longest`` signs are joined to ``pieces``; a sign that is no
    piece costs ``lowest`` and has id null. The fold keeps the best score and path of
    every place of a word.
    """
    n = F.length("word")
    stretches = F.flatten(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda stop: F.transform(
                F.sequence(F.greatest(F.lit(1), stop - longest + 1), stop),
                lambda start: F.struct(
                    start.alias("start"),
                    stop.alias("stop"),
                    F.col("word").substr(start, stop - start + 1).alias("piece"),
                ),
            ),
        )
    )
    edges = (
        words.select("word", F.explode(stretches).alias("e"))
        .select("word", "e.*")
        .join(pieces, "piece", "left")
        .where(F.col("id").isNotNull() | (F.col("start") == F.col("stop")))
        .groupBy("word")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("stop", "start", F.coalesce("score", F.lit(lowest)).alias("score"), "id"))
            ).alias("edges")
        )
    )
    node = "struct<score:double,ids:array<int>>"
    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")).cast(node))

    def step(best: Column, edge: Column) -> Column:
        origin = F.element_at(best, edge["start"])
        way = F.struct(
            (origin["score"] + edge["score"]).alias("score"), F.concat(origin["ids"], F.array(edge["id"])).alias("ids")
        ).cast(node)
        last = F.element_at(best, -1)
        return F.when(F.size(best) <= edge["stop"], F.concat(best, F.array(way))).otherwise(
            F.when(
                last["score"] < way["score"],
                F.concat(F.slice(best, F.lit(1), F.size(best) - 1), F.array(way)),
            ).otherwise(best)
        )

    return edges.select(
        "word", F.aggregate("edges", begin, step, lambda best: F.element_at(best, -1)["ids"]).alias("ids")
    )
