"""Language identification with error-correcting output codes.

Each language has a codeword. For each bit of it a binary classifier over hashed letter
trigrams (logistic regression) says how far a text lies on either side; the language
whose codeword costs least, each bit weighed by how well it was learned, is chosen. A
text is ambiguous if its bits are further from the codeword than the code corrects, or
if two languages cost nearly the same.

Learning takes about ``sample_rows`` labelled rows, as many of each language (``EACH`` at
least), drawn by a hash of the text, so the same rows on any layout of the files and after
a lost task; copies of a drawn text count once. Each bit is learned in a task of its own. Prediction
reads whole texts where they lie, without a shuffle. There may be any number of labels: the
driver and each task hold one codeword for each. Texts that are null or have no
letter are ``und`` with score 0, and so is everything if nothing was learned. Null
labels are not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.words import texts

UNKNOWN = "und"
BINS = 4096
SAMPLE_ROWS = 2000
# Rows of each language that are drawn at least, however many languages there are.
EACH = 4
# Codewords are the best of as many draws as compare about this many pairs.
PAIRS = 50_000_000
# Labels up to this size are sent to every task.
LABEL_BYTES = 1 << 23
# Losses held at a time, in numbers.
LOSSES = 1 << 22
# Under this share of the best language a text is ambiguous.
CLEAR = 0.6

# Letters in lower case, bytes of other scripts as they are, all else a space.
FOLDED = np.full(256, 32, np.uint32)
FOLDED[97:123] = np.arange(97, 123)
FOLDED[65:91] = np.arange(97, 123)
FOLDED[128:] = np.arange(128, 256)


def trigrams(text: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed trigrams: a vector of length one, or zero."""
    b = FOLDED[np.concatenate((np.array([32], np.uint8), text, np.array([32], np.uint8)))]
    h = (b[:-2] * np.uint32(65537) + b[1:-1] * np.uint32(257) + b[2:]) * np.uint32(2654435761)
    spaces = (b[:-2] == 32) & (b[1:-1] == 32)
    count = np.bincount((h >> np.uint32(20))[~spaces], minlength=BINS)
    return np.sqrt(count / max(count.sum(), 1)).astype(np.float32)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """``n`` rows of -1 and 1. All ways to part up to seven languages; random ones beyond,
    the best of up to a hundred draws by the smallest distance of two rows."""
    if n <= 7:
        parts = range(1, 2 ** max(n - 1, 0))
        return np.array([[1 if p >> i & 1 else -1 for p in parts] for i in range(n)]).reshape(n, len(parts))
    rng = np.random.Generator(np.random.PCG64(seed))
    width = 10 * int(np.ceil(np.log2(n)))
    draws = [rng.choice([-1, 1], (n, width)) for _ in range(max(1, min(100, PAIRS // n**2)))]
    return max(draws, key=_distance) if len(draws) > 1 else draws[0]


def _distance(codes: np.ndarray) -> int:
    """The smallest distance of two rows, found for some rows at a time."""
    n, width = codes.shape
    if n < 2:
        return 0
    signs = codes.astype(np.float32)
    step = max(1, LOSSES // n)
    least = width
    for at in range(0, n, step):
        same = signs[at : at + step] @ signs.T
        same[np.arange(len(same)), np.arange(at, at + len(same))] = -width
        least = min(least, int(width - same.max()) // 2)
    return least


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    @cached_property
    def corrects(self) -> int:
        """How many wrong bits the code corrects."""
        return (_distance(self.codes) - 1) // 2

    def decode(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row of bits: number of the language, its share, and whether it is ambiguous."""
        step = max(1, LOSSES // len(self.languages))
        parts = [self._decode(z[at : at + step]) for at in range(0, max(len(z), 1), step)]
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _decode(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ones = (self.codes > 0).astype(float)
        # The loss of a bit is one of two numbers, by its sign in the codeword.
        loss = (self.trust * np.logaddexp(0, -z)) @ ones.T + (self.trust * np.logaddexp(0, z)) @ (1 - ones).T
        best = loss.argmin(axis=1)
        share = 1 / np.exp(loss.min(axis=1, keepdims=True) - loss).sum(axis=1)
        wrong = (np.sign(z) != self.codes[best]).sum(axis=1)
        return best, share, (wrong > self.corrects) | (share < CLEAR)


def _learn(x: np.ndarray, y: np.ndarray, steps: int = 150, penalty: float = 1e-4) -> tuple:
    """Weights, bias and trust of one bit, by full-batch gradient steps (Adam)."""
    w = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    share = max((y > 0).mean(), 1e-9), max((y < 0).mean(), 1e-9)
    importance = np.where(y > 0, 0.5 / share[0], 0.5 / share[1]) / len(y)
    for t in range(1, steps + 1):
        z = x @ w[:-1].astype(np.float32) + w[-1]
        slope = -y * importance / (1 + np.exp(np.clip(y * z, -30, 30)))
        g = np.append(slope.astype(np.float32) @ x + penalty * w[:-1], slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    right = importance[np.sign(x @ w[:-1].astype(np.float32) + w[-1]) == y].sum()
    return w[:-1], w[-1], float(np.clip(2 * right - 1, 0.05, 1))


def fit(rows: DataFrame, *, text: str, label: str, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the labelled rows."""
    rows = rows.select(F.col(text).alias("text"), F.col(label).alias("label"))
    rows = rows.where("text is not null and label is not null").where(has_letter(F.col("text")))
    counts = rows.groupBy("label").count().orderBy("label").collect()
    languages = [r["label"] for r in counts]
    codes = codewords(len(languages))
    width = codes.shape[1] if languages else 0
    if not width:
        return Model(languages, np.ones((len(languages), 0)), np.zeros((0, BINS)), np.zeros(0), np.zeros(0))
    each = max(sample_rows / len(languages), EACH)
    shares = [(r["label"], i, min(1.0, each / r["count"])) for i, r in enumerate(counts)]
    known = rows.sparkSession.createDataFrame(shares, "label string, language int, share double")
    drawn = F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(1 << 40)) < F.col("share") * (1 << 40)
    # Only what is drawn is exchanged, unless the labels themselves are too many to broadcast.
    if sum(len(name) + 16 for name in languages) < LABEL_BYTES:
        known = F.broadcast(known)
    sample = rows.join(known, "label").where(drawn).withColumn("key", F.xxhash64("text")).dropDuplicates(["language", "key"])

    @F.arrow_udf("binary")
    def features(column: pa.Array) -> pa.Array:
        return pa.array([trigrams(t).tobytes() for t in texts(column)], pa.binary())

    sample = sample.select("language", "key", features("text").alias("x"))
    bits = sample.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        bit = int(pdf["bit"].iloc[0])
        pdf = pdf.sort_values(["language", "key"])
        x = np.frombuffer(b"".join(pdf["x"]), np.float32).reshape(-1, BINS)
        w, bias, trust = _learn(x, codes[pdf["language"].to_numpy(), bit].astype(float))
        return pd.DataFrame({"bit": [bit], "w": [w.tolist()], "bias": [bias], "trust": [trust]})

    learned = bits.groupBy("bit").applyInPandas(
        learn, "bit int, w array<double>, bias double, trust double"
    )
    learned = sorted(learned.collect())
    return Model(
        languages,
        codes,
        np.array([r["w"] for r in learned]).reshape(width, BINS),
        np.array([r["bias"] for r in learned]),
        np.array([r["trust"] for r in learned]),
    )


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identified(text: Column, model: Model) -> Column:
    """Struct of ``lang, score, ambiguous``."""

    @F.arrow_udf("struct<lang string, score double, ambiguous boolean>")
    def predict(column: pa.Array) -> pa.Array:
        if not model.languages:
            n = len(column)
            found = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        else:
            weights = model.weights.T.astype(np.float32)
            z = [trigrams(t) @ weights if t is not None else weights[0] for t in texts(column)]
            z = np.array(z, float).reshape(len(column), -1)
            best, score, unsure = model.decode(z + model.bias)
            found = [model.languages[i] for i in best], score, unsure
        return pa.StructArray.from_arrays(
            [pa.array(found[0], pa.string()), pa.array(found[1]), pa.array(found[2])],
            ["lang", "score", "ambiguous"],
        )

    none = F.struct(
        F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous")
    )
    return F.when(has_letter(text), predict(text)).otherwise(none)
