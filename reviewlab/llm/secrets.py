"""Secret scans with an incremental ledger of blobs.

A blob is the content of a version of a document, named by its SHA-256. The ledger is a
table of (blob, rule, version of the rule) and the spans found. An update scans only the
blobs and rule versions the ledger lacks, each blob once however many paths hold it, and
findings are joined back to all paths by blob. All steps are DataFrame functions.

A span counts code points from 0, its end is exclusive. Null texts are empty texts, equal
rows each get all findings of their blob, an empty table adds nothing to the ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"
# Marks the parts of a match; where a text has it, another sign of no class stands in.
MARK, STAND_IN = "\x01", "\x02"


@dataclass(frozen=True)
class Rule:
    """``pattern`` has two groups, what leads to the secret and the secret.

    Matches whose secret is shorter than ``least`` are dropped. A text without any of
    ``hints`` (in lower case) has no match.
    """

    name: str
    pattern: str
    least: int
    hints: tuple[str, ...] = ()
    version: int = 1


# The kinds of secrets, in the order in which equal starts are listed.
RULES = (
    Rule(
        "assign",
        r"""(?i)((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""",
        6,
        ("password", "passwd", "secret", "token", "api"),
    ),
    Rule("access", "()(AKIA[A-Z0-9]+)", 20, ("akia",)),
    # The least length stands in the pattern too: a run is matched from its start or not at all.
    Rule("hex", "()([0-9a-f]{24,})", 24),
)


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def spans_of(text: Column, rule: Rule) -> Column:
    """All spans of a rule: leftmost matches that do not overlap, the short ones dropped."""
    marked = F.regexp_replace(
        F.translate(text, MARK, STAND_IN), rule.pattern, f"{MARK}$1{MARK}$2{MARK}"
    )
    # Outside, lead, secret, outside, lead, secret, ..., outside.
    sizes = F.transform(F.split(marked, MARK, -1), F.length)
    none = F.array().cast("array<struct<start:int,end:int>>")
    begin = F.struct(
        F.lit(0).alias("i"), F.lit(0).alias("at"), F.lit(0).alias("start"), none.alias("spans")
    )

    def step(acc: Column, size: Column) -> Column:
        part = acc["i"] % 3
        end = acc["at"] + size
        span = F.struct(acc["start"].alias("start"), end.alias("end"))
        ends = (part == 2) & (size >= rule.least)
        return F.struct(
            (acc["i"] + 1).alias("i"),
            end.alias("at"),
            F.when(part == 1, acc["at"]).otherwise(acc["start"]).alias("start"),
            F.when(ends, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    found = F.aggregate(sizes, begin, step, lambda acc: acc["spans"])
    if not rule.hints:
        return found
    low = F.lower(text)
    hinted = F.lit(False)
    for hint in rule.hints:
        hinted = hinted | F.contains(low, F.lit(hint))
    return F.when(hinted, found).otherwise(none)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; an empty one is made where there is none."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def update(texts: DataFrame, path: str, *, text: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger at ``path`` lacks of ``texts`` and append it.

    An update that fails adds nothing and can be repeated.
    """
    key = lambda name, version: F.concat_ws("@", name, version)
    seen = (
        read_ledger(texts.sparkSession, path)
        .groupBy("blob")
        .agg(F.collect_set(key(F.col("rule"), F.col("version").cast("string"))).alias("seen"))
    )
    wanted = F.array(*[F.lit(f"{r.name}@{r.version}") for r in rules])
    body = F.coalesce(F.col(text), F.lit(""))
    todo = (
        texts.select(blob_of(body).alias("blob"), body.alias("body"))
        .join(seen, "blob", "left")
        .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
        .where(F.size("todo") > 0)
        .select("blob", "todo", "body")
        .dropDuplicates(["blob"])
    )
    entry = [
        F.when(
            F.array_contains("todo", f"{r.name}@{r.version}"),
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.version).alias("version"),
                spans_of(F.col("body"), r).alias("spans"),
            ),
        )
        for r in rules
    ]
    found = todo.select("blob", F.explode(F.filter(F.array(*entry), F.isnotnull)).alias("e"))
    found.select("blob", "e.rule", "e.version", "e.spans").write.mode("append").parquet(path)


def findings(
    docs: DataFrame, path: str, *, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``docs`` as a struct ``row`` with ``found``: (start, order, end, rule), sorted.

    Only blobs with findings are joined, one row each.
    """
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    now = F.array(*[F.lit(f"{r.name}@{r.version}") for r in rules])
    by_blob = (
        read_ledger(docs.sparkSession, path)
        .where(F.size("spans") > 0)
        .where(F.array_contains(now, F.concat_ws("@", "rule", F.col("version").cast("string"))))
        .select(
            "blob",
            F.transform(
                "spans",
                lambda s: F.struct(
                    s["start"].alias("start"),
                    order[F.col("rule")].alias("order"),
                    s["end"].alias("end"),
                    F.col("rule").alias("rule"),
                ),
            ).alias("spans"),
        )
        .groupBy("blob")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("found"))
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        blob_of(F.coalesce(F.col(text), F.lit(""))).alias("blob"),
    )
    none = F.array().cast("array<struct<start:int,order:int,end:int,rule:string>>")
    return rows.join(by_blob, "blob", "left").select("row", F.coalesce("found", none).alias("found"))


def listed(found: Column) -> Column:
    """``rule:start:end`` of all spans, comma-joined."""
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redacted(text: Column, found: Column, put: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, span: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, span["start"] - acc["at"])
        apart = (span["start"] >= acc["at"]) & ((span["start"] > acc["at"]) | (acc["at"] == 0))
        return F.struct(
            F.greatest(acc["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(acc["out"], kept, F.lit(put))).otherwise(acc["out"]).alias("out"),
        )

    return F.when(F.size(found) == 0, text).otherwise(
        F.aggregate(
            found,
            begin,
            step,
            lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
        )
    )
