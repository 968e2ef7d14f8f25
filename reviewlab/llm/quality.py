"""Quality of documents by multiple-instance learning with gated attention.

A document is a bag of passages, windows of about ``PASSAGE`` bytes that cover the whole
text. Each passage is encoded: shares of hashed trigrams of its bytes (letters in lower
case, and their shapes: capital, digit, blank, sign), then a learned layer. Only whole
documents have labels. A gated attention says how much each passage counts, the weighted
sum of the encodings is the document, and a logistic unit scores it; all layers are
learned together from the labels.

Learning takes about ``sample_rows`` labelled texts and ``sample_bytes`` of them, at most,
drawn by a hash of the text, so the sample depends neither on files nor on tasks; it is
encoded where it lies and learned from in one task. Equal texts are one, with the mean of
their labels. Scoring reads every whole text in place, without a shuffle, some hundred
passages at a time, so a text of any length fits.

Nulls and empty texts are one passage without content; they get a score too. Labels
without an id or a value are not learned from; one label repeated counts as often. With
no label at all every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.words import texts

SAMPLE_ROWS = 2000
SAMPLE_BYTES = 16 << 20
PASSAGE = 512
BINS = 2048
HIDDEN, GATE = 32, 16
# Passages encoded together.
TOGETHER = 512

# What a letter trigram sees: letters in lower case, other scripts as they are.
LETTERS = np.full(256, 32, np.uint32)
LETTERS[97:123] = LETTERS[65:91] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)
# What a shape trigram sees: one sign for each kind of letter, signs as they are.
SHAPES = np.arange(256, dtype=np.uint32)
SHAPES[97:123], SHAPES[65:91], SHAPES[48:58], SHAPES[128:] = ord("a"), ord("A"), ord("0"), ord("a")


def counts(text: np.ndarray, first: int, last: int, n: int) -> np.ndarray:
    """Hashed trigrams of passages ``first`` to ``last`` (exclusive) of the ``n`` of a text."""
    size = len(text)
    lo, hi = first * size // n, last * size // n
    b = np.full(hi - lo + 2, 32, np.uint8)
    before, after = max(lo - 1, 0), min(hi + 1, size)
    b[before - lo + 1 : after - lo + 1] = text[before:after]
    cuts = np.arange(first, last + 1) * size // n - lo
    passage = np.repeat(np.arange(last - first), np.diff(cuts)) * BINS
    found = np.zeros((last - first) * BINS, np.int64)
    for kind, table in enumerate((LETTERS, SHAPES)):
        c = table[b]
        h = (c[:-2] * np.uint32(65537) + c[1:-1] * np.uint32(257) + c[2:]) * np.uint32(2654435761)
        at = (h >> np.uint32(22)).astype(np.int64) + kind * (BINS // 2) + passage
        found += np.bincount(at, minlength=len(found))
    return found.reshape(-1, BINS)


def passages(text: np.ndarray | None) -> int:
    return 1 if text is None else max(1, -(-len(text) // PASSAGE))


def blocks(text: np.ndarray | None, together: int = TOGETHER) -> Iterator[np.ndarray]:
    """The counts of all passages of a text, a bounded number at a time."""
    n = passages(text)
    if text is None or not len(text):
        yield np.zeros((1, BINS), np.int64)
        return
    for first in range(0, n, together):
        yield counts(text, first, min(first + together, n), n)


def encoded(found: np.ndarray) -> np.ndarray:
    """Square roots of shares: rows of length one, or zero."""
    x = found.astype(np.float32)
    return np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Model:
    """Encoder ``e, e0``; gated attention ``v, u, w``; logistic unit ``c, b``."""

    e: np.ndarray
    e0: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    c: np.ndarray
    b: np.ndarray

    @classmethod
    def drawn(cls, seed: int) -> Model:
        rng = np.random.Generator(np.random.PCG64(seed))
        shapes = ((BINS, HIDDEN), (HIDDEN,), (HIDDEN, GATE), (HIDDEN, GATE), (GATE,), (HIDDEN,), (1,))
        spread = (1.0, 0.0, HIDDEN**-0.5, HIDDEN**-0.5, GATE**-0.5, HIDDEN**-0.5, 0.0)
        return cls(*[(s * rng.standard_normal(n)).astype(np.float32) for n, s in zip(shapes, spread)])

    def parts(self) -> list[np.ndarray]:
        return [self.e, self.e0, self.v, self.u, self.w, self.c, self.b]

    def passage(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Encoding, both sides of the gate, and the attention before it is normed."""
        h = np.tanh(x @ self.e + self.e0)
        t, g = np.tanh(h @ self.v), sigmoid(h @ self.u)
        return h, t, g, (t * g) @ self.w

    def score(self, text: np.ndarray | None) -> tuple[float, int, float]:
        """Score of a text, its passage that counts most, and the share of that passage."""
        total, weight, best, at, seen = np.zeros(HIDDEN), 0.0, -np.inf, 0, 0
        for found in blocks(text):
            h, _, _, s = self.passage(encoded(found))
            # The gate keeps |s| below the sum of |w|, so it needs no shift.
            a = np.exp(s.astype(float))
            total, weight = total + a @ h, weight + a.sum()
            if s.max() > best:
                best, at = float(s.max()), seen + int(s.argmax())
            seen += len(s)
        score = sigmoid(total / weight @ self.c + self.b[0])
        return float(score), at, float(np.exp(best) / weight)


def slopes(model: Model, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradient of the mean log loss; passages from ``first[i]`` on are those of document i."""
    sizes = np.diff(np.append(first, len(x)))
    of = np.repeat(np.arange(len(first)), sizes)
    h, t, g, s = model.passage(x)
    a = np.exp(s)
    a /= np.add.reduceat(a, first)[of]
    z = np.add.reduceat(a[:, None] * h, first)
    off = ((sigmoid(z @ model.c + model.b) - y) / len(y)).astype(np.float32)
    toward = (off[:, None] * model.c)[of]
    da = (h * toward).sum(axis=1)
    ds = a * (da - np.add.reduceat(a * da, first)[of])
    gate = ds[:, None] * model.w
    dt, dg = gate * g * (1 - t * t), gate * t * g * (1 - g)
    dh = (a[:, None] * toward + dt @ model.v.T + dg @ model.u.T) * (1 - h * h)
    return [x.T @ dh, dh.sum(axis=0), h.T @ dt, h.T @ dg, (t * g).T @ ds, z.T @ off, off.sum(keepdims=True)]


def learned(bags: list[np.ndarray], y: np.ndarray, *, rounds: int = 12, batch: int = 32, seed: int = 11) -> Model:
    """Adam over batches of documents; ``bags`` hold the counts of their passages."""
    model = Model.drawn(seed)
    rng = np.random.Generator(np.random.PCG64(seed))
    m = [np.zeros_like(p) for p in model.parts()]
    v = [np.zeros_like(p) for p in model.parts()]
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(bags))
        for chosen in np.array_split(order, -(-len(bags) // batch)):
            own = [bags[i] for i in chosen]
            first = np.cumsum([0, *map(len, own[:-1])])
            step += 1
            grads = slopes(model, encoded(np.concatenate(own)), first, y[chosen])
            for i, (p, grad) in enumerate(zip(model.parts(), grads)):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                p -= 0.005 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model | None:
    """Learn from the documents that ``labels`` marks; None without any."""
    docs = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    labels = labels.select(F.col(id).alias("id"), F.col(label).cast("double").alias("y")).dropna()
    marked = labels.count()
    size = docs.agg(F.avg(F.octet_length("text"))).first()[0]
    if not marked or size is None:
        return None
    share = min(1.0, sample_rows / marked, sample_bytes / (marked * max(size, 1.0)))
    h = F.xxhash64("text")
    # Drawn before the join, so that only the texts of the sample are exchanged.
    drawn = docs.where(F.pmod(h, F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    bags = (
        drawn.join(labels, "id")
        .groupBy(h.alias("h"))
        .agg(F.first("text").alias("text"), F.avg("y").alias("y"))
    )

    @F.arrow_udf("binary")
    def bag(column: pa.Array) -> pa.Array:
        found = [np.minimum(np.concatenate(list(blocks(t))), 255).astype(np.uint8) for t in texts(column)]
        return pa.array([x.tobytes() for x in found], pa.binary())

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h")
        own = [np.frombuffer(x, np.uint8).reshape(-1, BINS) for x in pdf["x"]]
        model = learned(own, pdf["y"].to_numpy())
        return pd.DataFrame({"part": [p.astype(np.float32).tobytes() for p in model.parts()]}).reset_index()

    # The one group is the sample, whose size is bounded.
    found = (
        bags.select("h", "y", bag("text").alias("x"), F.lit(0).alias("sample"))
        .groupBy("sample")
        .applyInPandas(learn, "index int, part binary")
        .collect()
    )
    if not found:
        return None
    like = Model.drawn(0).parts()
    parts = {r["index"]: np.frombuffer(r["part"], np.float32) for r in found}
    return Model(*[parts[i].reshape(p.shape) for i, p in enumerate(like)])


def scored(text: Column, model: Model | None) -> Column:
    """Struct of ``score, passage, weight``: the score, and the passage that counts most."""
    kind = "struct<score double, passage long, weight double>"

    @F.arrow_udf(kind)
    def work(column: pa.Array) -> pa.Array:
        rows = [model.score(t) for t in texts(column)] if model else [(0.5, 0, 1.0)] * len(column)
        score, passage, weight = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(score, pa.float64()), pa.array(passage, pa.int64()), pa.array(weight, pa.float64())],
            ["score", "passage", "weight"],
        )

    return work(text)
