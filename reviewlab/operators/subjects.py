"""All rows about one subject, over all tables, from any one of its identifiers.

A ``Source`` says which identifiers a table's rows carry: a column, or every match of a pattern
in a text. Two identifiers in one row belong to one subject, so from the identifier of a
request the rows that carry it are found, then the other identifiers in those rows, and so on
until nothing new comes. A kind that many subjects share, such as a shop's own number, must
be left out or declared as ``ends``: it is found in rows but not followed.

``mentions`` has one row per row and identifier. ``closure`` has one row per request and
identifier: how many rows away it is, and a shortest path to it, of those the first in order. ``rows_of``
has one row per request and row found.

Nulls and empty texts carry no identifier; a row without any is found by nobody. Equal identifiers of two
kinds are two. Repeated rows of one key are one row, repeated requests one request. A
request that nothing carries has its own identifier alone, and no rows.

Each round is an equi-join of the identifiers that are new with the mentions, so it does not matter how many
requests there are, and a row with k identifiers makes at most k links from each. Rounds are as many as
the longest of the shortest paths. Rows with one identifier lead nowhere and are found by one only, so they take
no part in rounds and are not grouped at the end; ``mentions`` can mark the others.

Sorts compare the first eight bytes of their first column at once. So what differs soonest comes first in
joins and groups: the identifier before its kind, the row before its table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from reviewlab.scratch import discard, stage

STEP = " > "


@dataclass(frozen=True)
class InColumn:
    """The value of a column identifies somebody."""

    kind: str
    column: str
    ends: bool = False

    def named(self) -> Column:
        value = F.col(self.column).cast("string")
        return F.array(F.when(value != "", _mention(self, value)))


@dataclass(frozen=True)
class InText:
    """Every match of a pattern in a text does; ``drop`` takes signs out that do not count, ``fold`` case."""

    kind: str
    column: str
    pattern: str
    drop: str = ""
    fold: bool = False
    ends: bool = False

    def named(self) -> Column:
        every = F.regexp_extract_all(F.col(self.column), F.lit(self.pattern), F.lit(0))

        def plain(match: Column) -> Column:
            match = F.lower(match) if self.fold else match
            return F.regexp_replace(match, self.drop, "") if self.drop else match

        found = F.array_distinct(F.filter(F.transform(every, plain), lambda m: m != ""))
        none = F.array().cast("array<string>")
        return F.transform(F.coalesce(found, none), lambda v: _mention(self, v))


@dataclass(frozen=True)
class Source:
    """A table's name, the columns that name a row, and what identifies somebody in it."""

    table: str
    key: tuple[str, ...]
    identifiers: tuple[InColumn | InText, ...]


def _mention(one: InColumn | InText, value: Column) -> Column:
    return F.struct(F.lit(one.kind).alias("kind"), value.alias("identifier"), F.lit(one.ends).alias("ends"))


def _is_alone(source: Source, sources: Sequence[Source], df: DataFrame) -> bool:
    """Whether a row's one identifier is part of its key, so that repeated rows can't have another."""
    if sum(s.table == source.table for s in sources) > 1 or len(source.identifiers) > 1:
        return False
    (one,) = source.identifiers
    whole = all(isinstance(df.schema[k].dataType, IntegralType) for k in source.key)
    return isinstance(one, InColumn) and one.column in source.key and whole


def _marked(said: DataFrame) -> DataFrame:
    return said.withColumn("several", F.count(F.lit(1)).over(Window.partitionBy("row", "table")) > 1)


def mentions(tables: Mapping[str, DataFrame], sources: Sequence[Source], *, mark: bool = False) -> DataFrame:
    """``table, row, kind, identifier, ends``: each table is read once, and only the columns named.

    ``mark`` adds ``several``, whether the row has other identifiers, too.
    """

    def one(source: Source, df: DataFrame) -> DataFrame:
        row = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in source.key])
        found = F.concat(*[i.named() for i in source.identifiers])
        rows = df.select(row.alias("row"), F.explode(found).alias("i")).where("i is not null")
        return rows.select(F.lit(source.table).alias("table"), "row", "i.*")

    alone = [s for s in sources if _is_alone(s, sources, tables[s.table])]
    others = [one(s, tables[s.table]) for s in sources if s not in alone]
    # Whole numbers are as different as their texts, and sooner compared.
    parts = [one(s, tables[s.table].select(*s.key).distinct()) for s in alone]
    if mark:
        parts = [part.withColumn("several", F.lit(False)) for part in parts]
    if others:
        rest = reduce(DataFrame.unionByName, others)
        # Dealt by row, so that they can be marked where they are.
        parts.append(_marked(rest.repartition("row", "table").distinct()) if mark else rest.distinct())
    return reduce(DataFrame.unionByName, parts)


def closure(said: DataFrame, requests: DataFrame) -> DataFrame:
    """``request, kind, identifier, depth, path`` for ``requests`` (``request, kind, identifier``).

    ``said`` comes from ``mentions``; it is read once a round, so give it stored, and marked.
    """
    identity = ["identifier", "kind"]
    start = requests.select("request", *identity).distinct()
    name = F.concat_ws(":", "kind", "identifier")
    new = stage(start.select("*", F.lit(0).alias("depth"), name.alias("path"), F.lit(False).alias("ends")), "reached")
    rounds = [new]
    # Only rows with two identifiers and more lead anywhere.
    own = [] if "several" in said.columns else [stage(_marked(said).where("several"), "leading")]
    leading = own[0] if own else said.where("several")
    depth = 0
    while not new.isEmpty():
        depth += 1
        from_here = new.where("not ends").select("request", *identity, "path")
        rows = leading.join(from_here, identity).groupBy("row", "table", "request").agg(
            F.min(F.concat_ws(STEP, "path", F.concat_ws(":", "table", "row"))).alias("path")
        )
        others = rows.join(leading, ["row", "table"]).groupBy(*identity, "request").agg(
            F.min(F.concat_ws(STEP, "path", name)).alias("path"), F.min("ends").alias("ends")
        )
        known = reduce(DataFrame.unionByName, rounds).select("request", *identity)
        fresh = others.join(known, [*identity, "request"], "left_anti")
        new = stage(fresh.select("request", *identity, F.lit(depth).alias("depth"), "path", "ends"), "reached")
        rounds.append(new)
    every = stage(reduce(DataFrame.unionByName, rounds), "closure")
    discard(*rounds, *own)
    return every


def rows_of(said: DataFrame, reached: DataFrame) -> DataFrame:
    """``request, table, row, depth, path``: every row that carries a followed identifier of the closure."""
    follows = reached.where("not ends").select("request", "kind", "identifier", "depth", "path")
    path = F.concat_ws(STEP, "path", F.concat_ws(":", "table", "row"))
    nearest = F.min(F.struct("depth", path.alias("path"))).alias("nearest")
    said = said if "several" in said.columns else _marked(said)
    identity = ["identifier", "kind"]
    # Distinct already: an identifier is in the closure of a request once.
    alone = said.where("not several").join(follows, identity).select("request", "table", "row", "depth", path.alias("path"))
    found = said.where("several").join(follows, identity).groupBy("row", "table", "request").agg(nearest)
    return alone.unionByName(found.select("request", "table", "row", "nearest.depth", "nearest.path"))
