"""Words and shingles of UTF-8 texts as 64-bit hashes, for use inside tasks.

All functions take one text as a ``uint8`` array, straight from the Arrow buffer, and
work on whole texts. Blanks are the ASCII blanks; only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_BLANK = np.isin(np.arange(256), BLANKS)
# Signs of ASCII count as blanks too.
IS_SIGN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.Generator(np.random.PCG64(20)).integers(0, 2**64, 256, np.uint64)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def texts(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each text of an Arrow string or binary column as bytes; None for null."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    missing = column.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield None if missing[i] else body[ends[i] : ends[i + 1]]


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[k] = np.cumprod(step, dtype=np.uint64)
    return _powers[0], _powers[1]


def word_bounds(text: np.ndarray, is_blank: np.ndarray = IS_BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end (exclusive), in bytes."""
    blank = np.ones(len(text) + 2, np.int8)
    blank[1:-1] = is_blank[text]
    edges = np.flatnonzero(np.diff(blank))
    return edges[0::2], edges[1::2]


def span_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each span of bytes; equal bytes have equal hashes wherever they lie."""
    up, down = powers(len(text) + 1)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTES[text] * up[: len(text)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: np.ndarray, is_blank: np.ndarray = IS_BLANK) -> np.ndarray:
    """A hash for each word, in order."""
    starts, ends = word_bounds(text, is_blank)
    return span_hashes(LOWER[text], starts, ends)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; fewer words make one run; none make none."""
    size = min(size, len(words))
    if not size:
        return words
    last = len(words) - size + 1
    found = np.full(last, size, np.uint64)
    for i in range(size):
        found = mix(found * _STEP + words[i : i + last])
    return found


def normal_form(text: np.ndarray) -> bytes:
    """The words in lower case with one space between them."""
    blank = IS_BLANK[text]
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return np.where(blank, np.uint8(32), LOWER[text])[keep].tobytes().strip(b" ")
