"""Keyed tokens that keep the format of what they stand for.

The digits of a text are replaced by other digits, as many, by an alternating Feistel network: in
each round one half is shifted by a keyed SHA-256 of the other half, so a token can be
turned back with the key and equal texts have equal tokens. All other signs stay where they are. Joins on
tokens are joins on values, and no table of tokens has to be kept.

Null stays null; a text without digits stays as it is. A text of more than ``MOST`` digits
raises. Short numbers can be guessed by whoever may ask for tokens, and signs that are not
digits are not hidden. A key stands in the query plan, so plans must not be shown to those who may not know it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 10
# Each half is a long.
MOST = 36


def protected(text: Column, key: str) -> Column:
    """The token of each text."""
    return _replaced(text, key, 1)


def revealed(token: Column, key: str) -> Column:
    """The text of each token."""
    return _replaced(token, key, -1)


def rotated(token: Column, old: str, new: str) -> Column:
    """The token under another key, without the source."""
    return protected(revealed(token, old), new)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _replaced(text: Column, key: str, sign: int) -> Column:
    return _bound(text, lambda t: _bound(F.regexp_replace(t, "[^0-9]", ""), lambda d: _of_digits(t, d, key, sign)))


def _of_digits(text: Column, digits: Column, key: str, sign: int) -> Column:
    n = F.length(digits)
    checked = F.when(n <= MOST, _shifted(digits, key, sign)).otherwise(F.raise_error(F.lit(f"more than {MOST} digits")))

    def among_signs(new: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            before = F.length(F.regexp_replace(F.substr(text, F.lit(1), i), "[^0-9]", ""))
            return F.when(c.rlike("^[0-9]$"), F.substr(new, before + 1, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(F.split(text, ""), one), "")

    return F.when(text.isNull() | (n == 0), text).otherwise(_bound(checked, among_signs))


def _shifted(digits: Column, key: str, sign: int) -> Column:
    """The rounds forwards, or backwards with shifts undone."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    right = n - left
    secret = hashlib.sha256(key.encode()).hexdigest()

    def size(width: Column) -> Column:
        return F.rpad(F.lit("1"), width + 1, F.lit("0")).cast("long")

    def value(part: Column) -> Column:
        return F.coalesce(F.nullif(part, F.lit("")).cast("long"), F.lit(0).cast("long"))

    def step(halves: Column, i: Column) -> Column:
        def shift(other: Column) -> Column:
            told = F.sha2(F.concat_ws(":", F.lit(secret), i.cast("string"), n.cast("string"), other.cast("string")), 256)
            return F.conv(F.substr(told, F.lit(1), F.lit(14)), 16, 10).cast("long") * sign

        a, b = halves["a"], halves["b"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(a + shift(b), size(left))).otherwise(a).alias("a"),
            F.when(even, b).otherwise(F.pmod(b + shift(a), size(right))).alias("b"),
        )

    start = F.struct(
        value(F.substr(digits, F.lit(1), left)).alias("a"), value(F.substr(digits, left + 1, right)).alias("b")
    )
    rounds = range(ROUNDS)[::sign]

    def text(halves: Column) -> Column:
        first = F.when(left > 0, F.lpad(halves["a"].cast("string"), left, F.lit("0"))).otherwise("")
        return F.concat(first, F.lpad(halves["b"].cast("string"), right, F.lit("0")))

    return F.aggregate(F.array(*map(F.lit, rounds)), start, step, text)
