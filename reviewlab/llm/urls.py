"""URL filters: allow and block entries in a trie of reversed host labels and path segments.

A rule (verdict, host, path) fits its host and all subdomains if the path of the url
starts with the rule's path. Of all rules that fit, the longest (host and path together)
decides; if the same entry is both allowed and blocked, it is blocked. Urls that no rule
fits get the default, and so do null and broken ones (empty host and path).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Rules that are broadcast as a trie at most, about 300 MB; more rules are joined.
MAX_TRIE = 1_000_000


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def segments(path: str) -> list[str]:
    """Parts of a path that end with a slash, and what is left."""
    return re.findall(r"[^/]*/|[^/]+", path)


def trie_of(rules: list[tuple[str, str, str]]) -> dict:
    """Nested dictionaries: by host label from the right, then under ``/`` by path segment.

    ``=`` holds the number of the rule that ends at a node, ``*`` those that end inside
    a segment. Keys of labels and segments never collide with these: labels hold no
    slash, and each level has one kind of key.
    """
    root: dict = {}
    for number, (_, host, path) in enumerate(rules):
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault("labels", {}).setdefault(label, {})
        node = node.setdefault("path", {})
        for part in segments(path):
            if part.endswith("/"):
                node = node.setdefault("next", {}).setdefault(part, {})
            else:
                node.setdefault("tails", []).append((part, number))
                break
        else:
            node.setdefault("rules", []).append(number)
    return root


def fitting(trie: dict, host: str, path: str) -> Iterator[int]:
    """Numbers of all rules that fit."""
    parts = segments(path)
    node = trie
    for label in reversed(host.split(".")):
        node = node.get("labels", {}).get(label)
        if node is None:
            return
        below = node.get("path")
        for part in [*parts, ""]:
            if below is None:
                break
            yield from below.get("rules", ())
            yield from (n for tail, n in below.get("tails", ()) if part.startswith(tail))
            below = below.get("next", {}).get(part)


def judged(
    urls: DataFrame,
    rules: DataFrame,
    *,
    url: str = "url",
    default: str = "allow",
    max_trie: int = MAX_TRIE,
) -> DataFrame:
    """``urls`` as a struct ``row`` with ``host, path, rule, verdict``.

    ``rules`` has ``verdict, host, path``. Up to ``max_trie`` of them are broadcast as a
    trie; more are joined by host suffix and path prefix, with the same result.
    """
    parsed = urls.select(
        F.struct(*[F.col(f"`{c}`") for c in urls.columns]).alias("row"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    rules = rules.select("verdict", "host", "path").where("host is not null and path is not null")
    known = [tuple(r) for r in rules.distinct().limit(max_trie + 1).collect()]
    if len(known) > max_trie:
        return _joined(parsed, rules, default)
    known.sort(key=lambda r: (r[1], r[2], r[0]))
    shared = urls.sparkSession.sparkContext.broadcast((trie_of(known), known))

    @F.pandas_udf("struct<rule string, verdict string>")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie, entries = shared.value

        def one(host: str, path: str) -> tuple:
            rank = lambda n: (len(entries[n][1] + entries[n][2]), entries[n][0] == "block", n)
            best = max(fitting(trie, host, path), key=rank, default=None)
            return (None, default) if best is None else (entries[best][1] + entries[best][2], entries[best][0])

        for hosts, paths in batches:
            yield pd.DataFrame(
                [one(h, p) for h, p in zip(hosts, paths, strict=True)], columns=["rule", "verdict"]
            )

    return parsed.withColumn("found", judge("host", "path")).select(
        "row", "host", "path", "found.rule", "found.verdict"
    )


def _joined(parsed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same by an equi-join of distinct (host, path) with the rules."""
    lengths = rules.agg(F.collect_set(F.length("path"))).first()[0]
    labels = F.split("host", r"\.", -1)
    suffixes = F.expr(
        "transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))"
    )
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")),
        lambda n: F.substring("path", F.lit(1), n),
    )
    tried = (
        parsed.select("host", "path")
        .distinct()
        .withColumn("labels", labels)
        .select("host", "path", F.explode(suffixes).alias("rh"), prefixes.alias("prefixes"))
        .select("host", "path", "rh", F.explode("prefixes").alias("rp"))
    )
    entries = rules.select(
        F.col("host").alias("rh"),
        F.col("path").alias("rp"),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("entry"),
    )
    best = (
        tried.join(entries, ["rh", "rp"])
        .groupBy("host", "path")
        .agg(F.max("entry").alias("entry"))
    )
    return parsed.join(best, ["host", "path"], "left").select(
        "row",
        "host",
        "path",
        F.col("entry.rule").alias("rule"),
        F.coalesce("entry.verdict", F.lit(default)).alias("verdict"),
    )
