"""Benchmark decontamination: BM25 over an inverted index of test items, block-max WAND.

The test items are indexed; the passages of every training text are the queries. A
passage is two neighbouring stretches of as many words as the longest item has, so that
an item that was copied lies within one passage. Scores are BM25 shares: 1 for a passage
with all of an item's words.

1. Per passage, the block maxima of its words are summed for each block of items; if no
   block can reach the threshold, no item can.
2. The other passages are run through block-max WAND, which returns every item at or
   above the threshold.
3. A hit counts if enough of the item is found: shingles of five words (an item of fewer
   words is one shingle), those of both the question and the answer where items have an
   answer, else those of the whole text.

Of an item given as one text the last sentence is reported as the answer (its last third,
if there is one sentence); no decision hangs on where it begins. Signs and case don't
count. Null and empty texts and items match nothing; equal items are each reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.words import IS_SIGN, shingle_hashes, texts, word_hashes

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, SHINGLE = 0.5, 0.6, 5
BLOCK = 2
# Terms are looked up by so many leading bits of their hash.
LOOKUP_BITS = 18
# Text of the items of one index, which is broadcast; more items make more indexes.
INDEX_BYTES = 32 << 20
HIT = "array<struct<item:bigint,score:double,question:double,answer:double,word:bigint>>"


def _words(text: str) -> np.ndarray:
    return word_hashes(np.frombuffer(text.encode(), np.uint8), IS_SIGN)


def parts_of(text: str) -> tuple[str, str]:
    """Question and answer of an item given as one text."""
    cut = [m.end() for m in re.finditer(r"[.?!:\n]+\s+(?=\S)", text)]
    if not cut:
        words = list(re.finditer(r"\S+", text))
        cut = [words[-(-2 * len(words) // 3)].start()] if len(words) > 2 else [len(text)]
    return text[: cut[-1]], text[cut[-1] :]


@dataclass
class Index:
    """Postings by term: ``start[t]`` to ``start[t + 1]`` of ``item`` and ``impact``."""

    ids: list[int]
    longest: int
    terms: np.ndarray
    lookup: np.ndarray
    probes: int
    start: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    most: np.ndarray
    block_start: np.ndarray
    block: np.ndarray
    block_most: np.ndarray
    sizes: list[int]
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    one_text: bool

    def passages(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (passage, term) of the words that are terms, in order."""
        low = self.lookup[(words >> np.uint64(64 - LOOKUP_BITS)).astype(np.int64)]
        at = np.full(len(words), -1)
        for probe in range(self.probes):
            tried = np.minimum(low + probe, len(self.terms) - 1)
            np.copyto(at, tried, where=self.terms[tried] == words)
        known = np.flatnonzero(at >= 0)
        stretch = known // self.longest
        pair = np.unique(stretch * len(self.terms) + at[known])
        before = pair[pair >= len(self.terms)] - len(self.terms)
        pair = np.unique(np.concatenate((pair, before)))
        return pair // len(self.terms), pair % len(self.terms)

    def possible(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> np.ndarray:
        """The passages in which some block of items can reach the threshold."""
        blocks = (len(self.ids) - 1) // BLOCK + 1
        n = self.block_start[term + 1] - self.block_start[term]
        entry = np.repeat(self.block_start[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        bound = np.bincount(
            np.repeat(passage, n) * blocks + self.block[entry],
            self.block_most[entry],
            (int(passage[-1]) + 1) * blocks,
        ).reshape(-1, blocks)
        return np.flatnonzero((bound >= threshold).any(axis=1))

    def wand(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Every item with a score of the threshold or more for a query of distinct terms."""
        item, impact, found = self.item, self.impact, []
        at = {int(t): int(self.start[t]) for t in terms}
        end = {t: int(self.start[t + 1]) for t in at}

        def block_most(t: int, block: int) -> float:
            lo, hi = self.block_start[t], self.block_start[t + 1]
            i = lo + np.searchsorted(self.block[lo:hi], block)
            return self.block_most[i] if i < hi and self.block[i] == block else 0.0

        def move(t: int, to: int) -> None:
            at[t] += int(np.searchsorted(item[at[t] : end[t]], to))

        while True:
            order = sorted((int(item[i]), t) for t, i in at.items() if i < end[t])
            total, pivot = 0.0, None
            for here, t in order:
                total += self.most[t]
                if total >= threshold:
                    pivot = here
                    break
            if pivot is None:
                return found
            upto = [t for here, t in order if here <= pivot]
            if sum(block_most(t, pivot // BLOCK) for t in upto) < threshold:
                beyond = min((here for here, _ in order if here > pivot), default=1 << 60)
                for t in upto:
                    move(t, min((pivot // BLOCK + 1) * BLOCK, beyond))
            elif order[0][0] == pivot:
                score = float(sum(impact[at[t]] for t in upto))
                if score >= threshold:
                    found.append((pivot, score))
                for t in upto:
                    at[t] += 1
            else:
                for t in upto:
                    move(t, pivot)

    def hits(self, body: np.ndarray, threshold: float, overlap: float) -> list[dict]:
        words = word_hashes(body, IS_SIGN)
        passage, term = self.passages(words)
        if not len(passage):
            return []
        best: dict[int, dict] = {}
        for p in self.possible(passage, term, threshold - 1e-6):
            for item, score in self.wand(term[passage == p], threshold - 1e-6):
                first = int(p) * self.longest
                size = min(SHINGLE, self.sizes[item])
                found = np.unique(shingle_hashes(words[first : first + 2 * self.longest], size))
                shares = [
                    float(np.isin(part[item], found).mean()) if len(part[item]) else 1.0
                    for part in (self.questions, self.answers)
                ]
                if self.one_text:
                    both = np.concatenate((self.questions[item], self.answers[item]))
                    enough = float(np.isin(both, found).mean())
                else:
                    enough = min(shares)
                if enough < overlap:
                    continue
                if item not in best or score > best[item]["score"]:
                    best[item] = {
                        "item": self.ids[item],
                        "score": min(score, 1.0),
                        "question": shares[0],
                        "answer": shares[1],
                        "word": first,
                    }
        return [best[i] for i in sorted(best)]


def index_of(items: list[tuple[int, str, str]], *, one_text: bool = False) -> Index | None:
    """An index of (id, question, answer), or of texts in two parts; None without words."""
    kept = [(i, _words(q), _words(a)) for i, q, a in items]
    kept = [(i, q, a) for i, q, a in kept if len(q) + len(a)]
    if not kept:
        return None
    rows = [np.concatenate((q, a)) for _, q, a in kept]
    size = np.array([len(r) for r in rows])
    terms, at = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), size)
    pair, tf = np.unique(at * len(rows) + owner, return_counts=True)
    term, item = pair // len(rows), pair % len(rows)
    df = np.bincount(term, minlength=len(terms))
    idf = np.log(1 + (len(rows) - df + 0.5) / (df + 0.5))
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / size.mean()))
    impact /= np.bincount(item, impact)[item]
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    prefix = (terms >> np.uint64(64 - LOOKUP_BITS)).astype(np.int64)
    key = term * len(rows) + item // BLOCK
    blocks = np.flatnonzero(np.diff(key, prepend=-1))
    questions, answers = [], []
    for (_, q, _), words in zip(kept, rows, strict=True):
        shingles = shingle_hashes(words, SHINGLE)
        # A shingle belongs to the part in which it ends.
        cut = max(len(q) - min(SHINGLE, len(words)) + 1, 0)
        questions.append(shingles[:cut])
        answers.append(shingles[cut:])
    return Index(
        ids=[i for i, _, _ in kept],
        longest=int(size.max()),
        terms=terms,
        lookup=np.searchsorted(prefix, np.arange(1 << LOOKUP_BITS)),
        probes=int(np.bincount(prefix).max()),
        start=np.append(starts, len(term)),
        item=item,
        impact=impact,
        most=np.maximum.reduceat(impact, starts),
        block_start=np.append(np.searchsorted(term[blocks], np.arange(len(terms))), len(blocks)),
        block=item[blocks] // BLOCK,
        block_most=np.maximum.reduceat(impact, blocks),
        sizes=size.tolist(),
        questions=questions,
        answers=answers,
        one_text=one_text,
    )


def hits(
    text: Column,
    items: DataFrame,
    *,
    id: str = "item_id",
    question: str = "text",
    answer: str | None = None,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    index_bytes: int = INDEX_BYTES,
) -> Column:
    """The items found in each text, as an array of structs (see HIT).

    Items are dealt into as many indexes of about ``index_bytes`` of text as they need;
    each is broadcast, and each passage is matched with all of them.
    """
    items = items.select(
        F.col(id).cast("long").alias("id"),
        F.coalesce(F.col(question), F.lit("")).alias("q"),
        (F.coalesce(F.col(answer), F.lit("")) if answer else F.lit(None).cast("string")).alias("a"),
    )
    size = items.agg(F.sum(F.octet_length("q") + F.coalesce(F.octet_length("a"), F.lit(0)))).first()[0]
    parts = max(1, -(-(size or 0) // index_bytes))
    columns = []
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("id", "q"), F.lit(parts)) == part).collect()
        rows = sorted((r["id"] or 0, *(parts_of(r["q"]) if r["a"] is None else (r["q"], r["a"]))) for r in rows)
        index = index_of(rows, one_text=answer is None)
        if index:
            columns.append(_matcher(items.sparkSession.sparkContext.broadcast(vars(index)), threshold, overlap)(text))
    none = F.array().cast(HIT)
    return F.coalesce(F.concat(*columns), none) if columns else none


def _matcher(shared, threshold: float, overlap: float):
    @F.arrow_udf(HIT)
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(**shared.value)
        kind = pa.struct(
            [("item", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64()), ("word", pa.int64())]
        )
        for column in batches:
            found = [
                index.hits(body, threshold, overlap) if body is not None else [] for body in texts(column)
            ]
            yield pa.array(found, pa.list_(kind))

    return match
