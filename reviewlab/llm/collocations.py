"""Phrases whose words stand together more often than apart, mined best first.

Texts are cut into pieces at signs and lines, pieces into words. A phrase of 2 to ``longest``
words that occurs ``least`` times or more is a candidate; each way to cut it in two parts
scores ``1000 * a * n / (l * r)``, and its weakest cut counts.

A phrase that starts with a prefix p can't occur more often than what follows the first
word of p, so no phrase that grows from p scores more than ``1000 * n / f(first word)``.
That bound orders the frontier. In each round, per language, the part of the frontier with
the best bounds is grown a word at a time, as long as prefixes occur ``least`` times; what
grew is scored exactly and dropped if a longer phrase stands for it. Once ``top`` phrases
survive, everything whose bound reaches the score of the last of them is expanded; what is
left then is below that score, so the result is settled, ties included. Frequent words,
which make most of the pairs of a corpus, are never grown.

Texts are read once. Words are stored as 64-bit hashes of language and word, in chunks that
overlap, so a piece of any length is cut without losing a phrase; each later pass reads these
numbers only, starts at words of the frontier, counts within its chunk and exchanges a row
per chunk and phrase. Frontiers go to the tasks as bit tables of fixed size; what a shared
bit lets through falls away in the exact join with the frontier. A phrase is dropped if the
same word always stands before it, or always after it, in the piece: then, and only then,
is a phrase one word longer as frequent.

Nulls: a null text has no words, a null language is ``und``. No candidates: no rows. Equal
phrases of two languages are two. Two words share a number by chance with 2**-64.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.words import LOWER, mix, span_hashes, texts, word_bounds
from reviewlab.scratch import discard, stage, temporaries

UNKNOWN = "und"
LEAST, LONGEST, TOP = 100, 5, 2000
# Words expanded in the first round, per language; the next ones are so many times more.
FIRST, MORE = 8000, 4
# Words of a stored chunk, entries of vocabulary beside it, bytes of text hashed together, and
# bytes before a task writes chunks. Rows of a quarter of a megabyte are light for Spark.
CHUNK, ENTRIES, SLICE, TOGETHER = 1 << 15, 1 << 13, 1 << 18, 1 << 20
# Bytes of numbers that a task reads into memory together.
ROW_GROUP = 4 << 20
# Bits of a table that says which numbers are wanted: 1 MB, whatever the input.
BITS, PART = 1 << 23, 8 * 4096

IS_SEPARATOR = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
IS_GAP = IS_SEPARATOR | np.isin(np.arange(256), np.frombuffer(b" \t", np.uint8))
STEP = np.uint64(0x9E3779B97F4A7C15)

WORDS_DDL = (
    "lang string, words binary, n_words long, vocab_h array<long>, vocab_n array<long>, vocab_w array<string>"
)
SIDES_DDL = "g long, before_lo long, before_hi long, after_lo long, after_hi long"


def slices(text: np.ndarray) -> Iterator[np.ndarray]:
    """``text`` in parts of about SLICE bytes that do not cut a word."""
    start = 0
    while start < len(text):
        end = start + SLICE
        while end < len(text):
            gap = np.flatnonzero(IS_GAP[text[end : end + SLICE]])
            if len(gap):
                end += int(gap[0])
                break
            end += SLICE
        yield text[start:end]
        start = end


class Bag:
    """The words of one language in a batch: their numbers in order, 0 where a piece starts."""

    def __init__(self, lang: str):
        name = np.frombuffer(lang.encode(), np.uint8)
        self.seed = span_hashes(name, np.array([0]), np.array([len(name)]))
        self.numbers: list[np.ndarray] = []
        self.spans: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, text: np.ndarray) -> None:
        broken = True
        for part in slices(text):
            starts, ends = word_bounds(part, IS_GAP)
            if not len(starts):
                broken = broken or bool(IS_SEPARATOR[part].any())
                continue
            lower = LOWER[part]
            # Language first: a word that is the name of a language is no other word in that language.
            h = np.maximum(joined(self.seed, span_hashes(lower, starts, ends)), np.uint64(1))
            seen = np.cumsum(IS_SEPARATOR[part])[starts]
            new = np.append(broken or seen[0] > 0, seen[1:] != seen[:-1])
            numbers = np.zeros(len(h) + int(new.sum()), np.uint64)
            numbers[np.arange(len(h)) + np.cumsum(new)] = h
            self.numbers.append(numbers)
            self.spans.append((h, lower, starts, ends))
            broken = bool(IS_SEPARATOR[part[ends[-1] :]].any())

    def vocabulary(self) -> tuple[np.ndarray, np.ndarray, list[str]]:
        h = np.concatenate([s[0] for s in self.spans])
        found, first, n = np.unique(h, return_index=True, return_counts=True)
        sizes = np.cumsum([len(s[0]) for s in self.spans])
        of = np.searchsorted(sizes, first, side="right")
        at = first - np.append(0, sizes)[of]
        names = []
        for i, k in zip(of.tolist(), at.tolist()):
            _, lower, starts, ends = self.spans[i]
            names.append(lower[starts[k] : ends[k]].tobytes().decode())
        return found.view(np.int64), n, names

    def chunks(self, longest: int) -> Iterator[bytes]:
        """Pieces of the numbers, each with one before and ``longest`` after its own."""
        every = np.concatenate([np.zeros(1, np.uint64), *self.numbers, np.zeros(longest, np.uint64)])
        for start in range(1, len(every) - longest, CHUNK):
            end = min(start + CHUNK, len(every) - longest)
            yield every[start - 1 : end + longest].tobytes()


def hashed_words(docs: DataFrame, text: str, lang: str, longest: int) -> DataFrame:
    """Chunks of word numbers, and beside them the vocabulary of some megabytes of text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags: dict[str, Bag] = {}
        size = 0
        for batch in batches:
            for i, body in enumerate(texts(batch.column(1))):
                name = batch.column(0)[i].as_py()
                if name not in bags:
                    bags[name] = Bag(name)
                bags[name].add(body)
                size += len(body)
                if size >= TOGETHER:
                    yield from written(bags)
                    bags, size = {}, 0
        yield from written(bags)

    def written(bags: dict[str, Bag]) -> Iterator[pa.RecordBatch]:
        for name, bag in bags.items():
            if not bag.numbers:
                continue
            h, n, names = bag.vocabulary()
            entries = [slice(i, i + ENTRIES) for i in range(0, len(h), ENTRIES)]
            for chunk, part in zip_longest(bag.chunks(longest), entries, fillvalue=None):
                part = part or slice(0, 0)
                yield pa.record_batch(
                    [
                        pa.array([name]),
                        pa.array([chunk or b""], pa.binary()),
                        pa.array([int(n[part].sum())], pa.int64()),
                        *[pa.array([x[part]], pa.list_(pa.int64())) for x in (h, n)],
                        pa.array([names[part]], pa.list_(pa.string())),
                    ],
                    ["lang", "words", "n_words", "vocab_h", "vocab_n", "vocab_w"],
                )

    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(work, WORDS_DDL)


def bits_of(rows: DataFrame, column: str = "g") -> np.ndarray:
    """A table of BITS bits with those of the numbers in ``column`` set."""
    place = F.pmod(F.col(column), F.lit(BITS))
    found = (
        rows.select(F.floor(place / PART).alias("part"), (place % PART).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    table = np.zeros((BITS // PART, PART // 8), np.uint8)
    for r in found.collect():
        table[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return table.reshape(-1)


def among(numbers: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = numbers & np.uint64(BITS - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def joined(g: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The number of a phrase and one more word."""
    return mix(g * STEP + w)


def _mapped(words: DataFrame, longest: int, count: Callable[[np.ndarray, np.ndarray], list], kind: str) -> DataFrame:
    """``count`` gets the numbers of a chunk and where its own words stand."""
    names = [c.split()[0] for c in kind.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0):
                a = np.frombuffer(chunk.as_buffer(), np.uint64)
                columns = count(a, np.arange(1, len(a) - longest))
                if len(columns[0]):
                    arrays = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, pa.int64()) for c in columns]
                    yield pa.record_batch(arrays, names)

    return words.where(F.octet_length("words") > 0).select("words").mapInArrow(work, kind)


def _walk(a: np.ndarray, at: np.ndarray, frontiers: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where phrases of each frontier may start, by length from 1 on, and their numbers."""
    at = at[(a[at] != 0) & among(a[at], frontiers[0])]
    g = a[at]
    yield at, g
    for j, bits in enumerate(frontiers[1:], 1):
        w = a[at + j]
        g = joined(g, w)
        keep = (w != 0) & among(g, bits)
        at, g = at[keep], g[keep]
        yield at, g


def grown(words: DataFrame, longest: int, frontiers: list[np.ndarray], frequent: np.ndarray) -> DataFrame:
    """``p, w, n``: counts of the phrases of the last frontier with one more word."""

    def count(a: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        *_, (at, p) = _walk(a, at, frontiers)
        w = a[at + len(frontiers)]
        keep = (w != 0) & among(w, frequent)
        p, w = p[keep], w[keep]
        _, first, n = np.unique(joined(p, w), return_index=True, return_counts=True)
        return [p[first], w[first], n]

    counts = _mapped(words, longest, count, "p long, w long, n long")
    return counts.groupBy("p", "w").agg(F.sum("n").alias("n"))


def surroundings(words: DataFrame, longest: int, frontiers: list[np.ndarray]) -> DataFrame:
    """For the phrases of ``frontiers``, the least and the largest number on either side; 0 is a break."""

    def count(a: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        found = []
        for size, (own, g) in enumerate(_walk(a, at, frontiers), 1):
            if size == 1 or not len(g):
                continue
            order = np.argsort(g, kind="stable")
            own, g = own[order], g[order]
            first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            # As the signed numbers that Spark compares.
            sides = a[own - 1].view(np.int64), a[own + size].view(np.int64)
            found.append([g[first], *[f.reduceat(x, first) for x in sides for f in (np.minimum, np.maximum)]])
        return [np.concatenate(c) for c in zip(*found)] if found else [at[:0]] * 5

    return (
        _mapped(words, longest, count, SIDES_DDL)
        .groupBy("g")
        .agg(
            *[F.min(c).alias(c) for c in ("before_lo", "after_lo")],
            *[F.max(c).alias(c) for c in ("before_hi", "after_hi")],
        )
    )


def number_of(p: str, w: str) -> Column:
    """The number of a phrase and one more word, as a column."""

    @F.arrow_udf("long")
    def number(p: pa.Array, w: pa.Array) -> pa.Array:
        found = joined(p.to_numpy().view(np.uint64), w.to_numpy().view(np.uint64))
        return pa.array(found.view(np.int64))

    return number(p, w)


def counted(words: DataFrame, longest: int, starts: np.ndarray, wanted: dict[int, np.ndarray]) -> DataFrame:
    """``g, n`` of the phrases that ``wanted`` may have; by length, from 2 on."""

    def count(a: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        at = at[(a[at] != 0) & among(a[at], starts)]
        g, found = a[at], []
        for j in range(1, max(wanted)):
            w = a[at + j]
            at, g = at[w != 0], joined(g[w != 0], w[w != 0])
            if j + 1 in wanted:
                found.append(g[among(g, wanted[j + 1])])
        return list(np.unique(np.concatenate(found), return_counts=True))

    return _mapped(words, longest, count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))


def _suffixes(phrases: DataFrame) -> DataFrame:
    """``g, k, s, size, start``: the number of what follows the first ``k`` words, and its first word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for g, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.array(words, np.int64).view(np.uint64)
                for k in range(1, len(own)):
                    s = own[k : k + 1]
                    for i in range(k + 1, len(own)):
                        s = joined(s, own[i : i + 1])
                    rows.append((g, k, int(s.view(np.int64)[0]), len(own) - k, words[k]))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["g", "k", "s", "size", "start"])

    return phrases.select("g", "words").mapInArrow(work, "g long, k long, s long, size long, start long")


def _grown_round(
    words: DataFrame, vocabulary: DataFrame, band: DataFrame, frequent: np.ndarray, least: int, longest: int
) -> DataFrame | None:
    """All candidates that start with a word of ``band``, scored; None without any.

    ``lang, g, words, a, l, r, n, score, survives``.
    """
    with temporaries() as passing:
        frontier = passing(
            band.select("lang", "total", "g", F.array("g").alias("words"), F.array("f").alias("counts")), "frontier"
        )
        frontiers, found = [], []
        for size in range(2, longest + 1):
            frontiers.append(bits_of(frontier))
            counts = grown(words, longest, frontiers, frequent).where(F.col("n") >= least)
            prefix = frontier.select("lang", "total", F.col("g").alias("p"), "words", "counts")
            frontier = passing(
                counts.join(prefix, "p").select(
                    "lang",
                    "total",
                    number_of("p", "w").alias("g"),
                    F.array_append("words", F.col("w")).alias("words"),
                    F.array_append("counts", F.col("n")).alias("counts"),
                ),
                "frontier",
            )
            if frontier.isEmpty():
                break
            found.append(frontier)
        if not found:
            return None
        phrases = found[0]
        for more in found[1:]:
            phrases = phrases.unionByName(more)
        # The longest phrases have nothing longer to stand for them.
        inner = min(len(found) + 1, longest - 1)
        if inner > 1:
            while len(frontiers) < inner:
                frontiers.append(bits_of(found[len(frontiers) - 1]))
            same = [
                (F.col(f"{c}_lo") == F.col(f"{c}_hi")) & (F.col(f"{c}_lo") != 0) for c in ("before", "after")
            ]
            sides = surroundings(words, longest, frontiers[:inner])
            sides = sides.select("g", (~(same[0] | same[1])).alias("alone"))
            longer = F.size("words") == longest
            phrases = phrases.join(sides, "g", "left").withColumn("survives", longer | F.col("alone"))
        else:
            phrases = phrases.withColumn("survives", F.lit(True))
        phrases = passing(phrases, "phrases")
        parts = passing(_suffixes(phrases), "suffixes")
        rest = [vocabulary.select(F.col("g").alias("s"), F.col("f").alias("r"))]
        wanted = {}
        for size in range(2, len(found) + 1):
            own = parts.where(F.col("size") == size)
            wanted[size] = bits_of(own, "s")
        if wanted:
            starts = bits_of(parts.where("size > 1"), "start")
            several = parts.where("size > 1").select("s").distinct()
            more = counted(words, longest, starts, wanted).join(several.withColumnRenamed("s", "g"), "g", "left_semi")
            rest.append(more.select(F.col("g").alias("s"), F.col("n").alias("r")))
        rests = rest[0] if len(rest) == 1 else rest[0].unionByName(rest[1])
        cuts = (
            parts.join(rests, "s")
            .join(phrases, "g")
            .select(
                *("lang", "total", "g", "words", "survives", "k", "r"),
                F.element_at("counts", F.col("k").cast("int")).alias("l"),
                F.element_at("counts", -1).alias("a"),
            )
        )
        # Products pass 64 bits.
        score = F.expr(
            "cast(1000 * cast(a as decimal(18,0)) * cast(total as decimal(16,0)) as decimal(38,0))"
            " div cast(cast(l as decimal(18,0)) * cast(r as decimal(18,0)) as decimal(38,0))"
        )
        weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c")
        scored = cuts.groupBy("g").agg(
            F.first("lang").alias("lang"),
            F.first("total").alias("n"),
            F.first("words").alias("words"),
            F.first("survives").alias("survives"),
            F.first("a").alias("a"),
            weakest,
        )
        return stage(scored.where("survives").select("lang", "g", "words", "a", "c.l", "c.r", "n", "c.score"), "scored")


def mined(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    first: int = FIRST,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language."""
    with temporaries() as passing:
        chunks = hashed_words(docs, text, lang, longest)
        words = passing(chunks, "words", **{"parquet.block.size": ROW_GROUP})
        totals = words.groupBy("lang").agg(F.sum("n_words").alias("total"))
        counts = words.select("lang", F.explode(F.arrays_zip("vocab_h", "vocab_n")).alias("v")).groupBy(
            "lang", F.col("v.vocab_h").alias("g")
        )
        counts = counts.agg(F.sum("v.vocab_n").alias("f")).where(F.col("f") >= least)
        vocabulary = passing(counts.join(totals, "lang"), "vocabulary")
        frequent = bits_of(vocabulary)
        # How many words of a language occur so often or less.
        so_far = Window.partitionBy("lang").orderBy("f").rowsBetween(Window.unboundedPreceding, 0)
        ladder = vocabulary.groupBy("lang", "total", "f").agg(F.count("*").alias("words"))
        ladder = passing(ladder.select("lang", "total", "f", F.sum("words").over(so_far).alias("words")), "ladder")

        # Words that occur ``done`` times or less are expanded; those up to ``high`` come next.
        steps = ladder.groupBy("lang", "total").agg(
            F.lit(0).cast("long").alias("done"),
            F.coalesce(F.min(F.when(F.col("words") >= first, F.col("f"))), F.max("f")).alias("high"),
            F.max("f").alias("top_f"),
        )
        steps = passing(steps, "steps")
        scored: DataFrame | None = None
        while not steps.isEmpty():
            band = vocabulary.join(steps.select("lang", "done", "high"), "lang").where("f > done and f <= high")
            now = _grown_round(words, vocabulary, band, frequent, least, longest)
            if now is not None:
                both = now if scored is None else stage(scored.unionByName(now), "scored")
                if scored is not None:
                    discard(now, scored)
                scored = both
            steps = passing(_next_steps(steps, ladder, scored, top), "steps")
        if scored is None:
            return _none(docs)
        return _named(words, scored, top)


def _next_steps(steps: DataFrame, ladder: DataFrame, scored: DataFrame | None, top: int) -> DataFrame:
    """The languages that are not settled, and how far to expand them.

    With ``top`` survivors, all words whose bound reaches the score of the last one; else
    some times as many words as before.
    """
    rest = steps.where("high < top_f")
    if scored is None:
        last = rest.select("lang", F.lit(None).cast("long").alias("last"))
    else:
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))
        last = scored.select("lang", "score", place.alias("place")).where(F.col("place") <= top)
        last = last.groupBy("lang").agg(F.max(F.when(F.col("place") == top, F.col("score"))).alias("last"))
    reached = ladder.select("lang", F.col("f").alias("high"), F.col("words").alias("so_many"))
    rest = rest.join(last, "lang", "left").join(reached, ["lang", "high"], "left")
    more = ladder.select("lang", "f", "words").join(rest.select("lang", "so_many"), "lang")
    more = more.where(F.col("words") >= MORE * F.col("so_many")).groupBy("lang").agg(F.min("f").alias("more"))
    # 1000 * total / f reaches the score up to this f.
    enough = F.expr("cast(1000 * cast(total as decimal(35,0)) as decimal(38,0)) div cast(last as decimal(38,0))")
    further = F.when(F.col("last") > 0, enough).otherwise(F.coalesce("more", "top_f"))
    found = rest.join(more, "lang", "left").select(
        "lang", "total", F.col("high").alias("done"), F.least(further, "top_f").alias("high"), "top_f"
    )
    return found.where("high > done")


def _named(words: DataFrame, scored: DataFrame, top: int) -> DataFrame:
    """The best phrases of each language by name."""
    with temporaries() as passing:
        place = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score")))
        best = passing(scored.withColumn("place", place).where(F.col("place") <= top).drop("place"), "best")
        letters = best.select("g", F.posexplode("words").alias("i", "h"))
        wanted = letters.select("h").distinct()
        bits = bits_of(wanted, "h")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for h, names in zip(batch.column(0), batch.column(1)):
                    own = h.values.to_numpy(zero_copy_only=False)
                    keep = pa.array(among(own.view(np.uint64), bits))
                    yield pa.record_batch([h.values.filter(keep), names.values.filter(keep)], ["h", "word"])

        known = words.where(F.size("vocab_h") > 0).select("vocab_h", "vocab_w").mapInArrow(work, "h long, word string")
        known = known.groupBy("h").agg(F.min("word").alias("word"))
        spelled = (
            letters.join(known, "h")
            .groupBy("g")
            .agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("parts"))
            .select("g", F.array_join(F.transform("parts", lambda p: p["word"]), " ").alias("phrase"))
        )
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = best.join(spelled, "g").withColumn("rank", F.row_number().over(order).cast("long"))
        found = stage(ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases")
    discard(scored)
    return found


def _none(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame(
        [], "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
    )
