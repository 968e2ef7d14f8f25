"""Operators on tables that change or arrive, as queries over the given tables, whole.

Changes, second reports and arriving files are made from the tables by rule, so that SQL
can make them, too.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.config import under
from reviewlab.functions import tokens
from reviewlab.operators import deltas, erasure, history, models, reconcile, rules, significance, subjects
from reviewlab.plans.compare import training_rows
from reviewlab.plans.featurize import hashed_counts, tokens_of
from reviewlab.scratch import discard, fresh_path, stage
from reviewlab.sources import evolution
from reviewlab.sources.tables import labelled_reviews, table
from reviewlab.streaming import scoring

ATTRIBUTES = ("segment", "nation")
PLACES = 6
DELIVERY_FILES = 12
# Lines that are reconciled at once, on average: bounds what their pairs take on disk.
SLICE_LINES = 16_000_000


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five changes per customer: first known, moved, a late correction, a repeat, removed or back."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")
    )
    start = F.lit("1992-01-01").cast("timestamp_ntz")
    n = F.col("custkey")

    def told(order: int, days, where, removed=False, segment=None, nation=None) -> DataFrame:  # noqa: ANN001
        return customer.where(where).select(
            "custkey",
            (start + F.make_dt_interval(days.cast("int"))).alias("at"),
            F.lit(order).cast("long").alias("order"),
            F.lit(removed).alias("removed"),
            (F.lit(segment) if segment else F.col("segment")).alias("segment"),
            (F.col("nation") if nation is None else nation).cast("int").alias("nation"),
        )

    parts = [
        told(1, F.lit(0), n >= 0),
        told(2, 300 + n % 1500, n % 2 == 0, nation=(F.col("nation") + 1) % 25),
        told(3, 200 + n % 900, n % 3 == 0, segment="CORRECTED"),
        told(4, 300 + n % 1500, n % 5 == 0, segment="CORRECTED", nation=(F.col("nation") + 2) % 25),
        told(5, 1000 + n % 1200, n % 7 == 0, removed=True),
        told(6, 1400 + n % 1300, n % 14 == 0),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built from half of the changes, then the others applied, though they lie before and between."""
    changes = customer_changes(spark, sf_dir)
    late = (F.col("order") + F.col("custkey")) % 2 == 0
    first = stage(history.intervals(changes.where(~late), "custkey", ATTRIBUTES), "history")
    return history.applied(first, changes.where(late), "custkey", ATTRIBUTES)


def orders_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with what was known of its customer on its day."""
    known = history.intervals(customer_changes(spark, sf_dir), "custkey", ATTRIBUTES)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return history.as_of(orders, known, "o_custkey", "o_orderdate", "custkey").select(
        "o_orderkey", "segment", "nation"
    )


def _in_slices(lines: DataFrame, named: Column, parts: tuple[str, ...]) -> list[DataFrame]:
    """Lines in groups without a part or an id in common, so each can be reconciled on its own.

    An id is the name of a line, with ``parts`` of it left out where they are null. So lines of different
    parts may have one name only if something is null; all lines of such parts are in one group.
    """
    n_slices = -(-lines.count() // SLICE_LINES)
    if n_slices < 2:
        return [lines]
    part = F.col("l_partkey")
    holes = lines.where(reduce(Column.__or__, (F.col(c).isNull() for c in parts))).select("l_partkey", named.alias("line"))
    # A null part is a part of its own here.
    key = F.coalesce(part.cast("string"), F.lit(""))
    twice = holes.groupBy("line").agg(F.min(key).alias("one"), F.max(key).alias("other")).where("one <> other")
    tied = stage(holes.join(twice, "line").select("l_partkey").distinct(), "tied")
    slices = lines.withColumn("slice", F.pmod(F.xxhash64("l_partkey"), F.lit(n_slices)).cast("int"))
    if not tied.isEmpty():
        tied = tied.select(F.col("l_partkey").alias("tied"), F.lit(0).alias("zero"))
        slices = slices.join(tied, part.eqNullSafe(F.col("tied")), "left").withColumn("slice", F.coalesce("zero", "slice")).drop("tied", "zero")
    stored = stage(slices, "sliced", ["slice"], compression="zstd")
    return [stored.where(F.col("slice") == i).drop("slice") for i in range(n_slices)]


def reconcile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines against a second report of them: later days, rounded amounts, some lost, some added."""
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
    line = F.concat_ws("-", *columns[:4], F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_quantity").cast("int"))
    given = table(spark, sf_dir, "lineitem").select(*columns)
    found = []
    for some in _in_slices(given, line, (*columns[:5], "l_quantity")):
        lines = some.select(
            line.alias("line"), "l_orderkey", F.col("l_partkey").alias("part"), F.col("l_shipdate").cast("date").alias("day"), F.col("l_extendedprice").alias("amount")
        )
        # Stored once: both reports are made from it.
        lines = stage(lines.groupBy("line", "l_orderkey", "part", "day").agg(F.max("amount").alias("amount")), "lines", compression="zstd")
        told = reconcile.reconciled(*_two_reports(lines), ["part"], days=3, share=0.02)
        # Most lines are matched with themselves: their name is stored once.
        same = F.col("left_id").eqNullSafe(F.col("right_id"))
        gap = F.round("amount_gap", 2).alias("amount_gap")
        slim = told.select("left_id", same.alias("same"), F.when(~same, F.col("right_id")).alias("right_id"), "status", "day_gap", gap, F.round("residual", 6).alias("residual"))
        found.append(stage(slim, "reconciled", compression="zstd"))
        discard(lines, *told.made_from)
    every = spark.read.schema(found[0].schema).parquet(*(one.staged_at for one in found))
    right = F.when(F.col("same"), F.col("left_id")).otherwise(F.col("right_id")).alias("right_id")
    return every.select("left_id", right, "status", "day_gap", "amount_gap", "residual")


def _two_reports(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    ours = lines.select(F.col("line").alias("id"), "part", "day", "amount")
    n = F.col("l_orderkey")
    shifted = F.date_add("day", (n % 4).cast("int"))
    rounded = F.floor(F.col("amount") / 100) * 100.0
    kept = lines.where(n % 11 != 0).select(F.col("line").alias("id"), "part", shifted.alias("day"), rounded.alias("amount"))
    again = lines.where(n % 13 == 0).select(
        F.concat("line", F.lit("-again")).alias("id"), "part", F.date_add("day", 1).alias("day"), F.col("amount")
    )
    return ours, kept.unionByName(again)


def deliver(rows: DataFrame, path: str) -> None:
    """All rows in a bounded number of files: batches take files, and each batch costs all state partitions a commit."""
    rows.coalesce(DELIVERY_FILES).write.parquet(path)


def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that arrive in three deliveries, some of them twice, scored by a stored model.

    Each document once, by the run of its delivery, with the score of a batch job.
    """
    counted = hashed_counts(tokens_of(labelled_reviews(spark, sf_dir)))
    rows = training_rows(counted.table).select("label", "features")
    path = fresh_path(spark, "model")
    PipelineModel([*counted.stages, models.LogisticRegressionAlone(maxIter=10).fit(rows)]).write().save(path)
    model = PipelineModel.load(path)

    source, sink, checkpoint = (fresh_path(spark, x) for x in ("arriving", "scores", "progress"))
    n = F.col("review_id")
    at = (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(n.cast("int") % 1000)).alias("at")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("review_id"), F.col("text").alias("review"))
    docs = docs.where("review_id is not null").select("review_id", "review", F.lit("positive").alias("sentiment"), at)
    for run in range(3):
        delivered = docs.where((n % 3 == run) | ((n % 3 < run) & (n % 5 == 0)))
        deliver(delivered, f"{source}/run{run}")
        scoring.score_available(
            spark, source, docs.schema, model, sink, checkpoint, key="review_id", at="at", late="3650 days", files_per_batch=3
        )
    batch = model.transform(docs).select("review_id", F.unwrap_udt("probability").alias("expected"))
    same = F.unwrap_udt("probability") == F.col("expected")
    stored = spark.read.parquet(sink)
    return stored.join(batch, "review_id").groupBy("review_id").agg(
        F.count(F.lit(1)).alias("stored"), F.bool_and(same).alias("same_score")
    )


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive out of order in four deliveries: rows and sums per day and type."""
    source, sink, checkpoint = (fresh_path(spark, x) for x in ("arriving", "windows", "progress"))
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"
    )
    for run in range(4):
        events.where(F.col("event_id") % 4 == run).write.parquet(f"{source}/run{run}")
        scoring.count_available(
            spark, source, events.schema, sink, checkpoint, at="ts", by="event_type", value="value", width="1 day", late="3650 days"
        )
    found = scoring.latest(spark, sink, ["window_start", "event_type"])
    return found.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "event_type",
        "row_count",
        F.col("total").cast("double").alias("total"),
    )


def layered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by segment and status, kept up to date through two rounds of changes.

    First orders go, come and change their price; then customers change their segment.
    """
    cents = F.round(F.col("o_totalprice") * 100).cast("decimal(20,0)").alias("cents")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"), cents)
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    n = F.col("o_orderkey")
    changed = orders.where(n % 7 != 3).withColumn("cents", F.when(n % 5 == 0, F.col("cents") + n).otherwise(F.col("cents")).cast("decimal(20,0)"))
    added = orders.where(n % 11 == 1).withColumn("o_orderkey", -n)
    after = changed.unionByName(added)
    moved = people.withColumn("segment", F.when(F.col("custkey") % 9 == 0, "MOVED").otherwise(F.col("segment")))

    path, keys = fresh_path(spark, "layer"), ["segment", "status"]
    none = deltas.weighted(orders).where("false")
    nobody = deltas.weighted(people).where("false")
    # What was, and what changes, of orders and of customers.
    rounds = (
        (none, deltas.weighted(orders), nobody, deltas.weighted(people)),
        (deltas.weighted(orders), deltas.difference(orders, after), deltas.weighted(people), nobody),
        (deltas.weighted(after), none, deltas.weighted(people), deltas.difference(people, moved)),
    )
    for left, left_change, right, right_change in rounds:
        change = deltas.joined(left, left_change, right, right_change, ["custkey"])
        deltas.update_layer(spark, path, change, keys, "cents")
    found = deltas.summary(deltas.layer(spark, path), keys, "cents")
    return found.select(*keys, "row_count", *[F.col(c).cast("long").alias(c) for c in ("total", "least", "largest")])


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """All events in files of four schemas: columns renamed, widened, added, and one turned to text."""
    path = fresh_path(spark, "versions")
    n = F.col("event_id")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    made = (
        {"id": (1, n.cast("int")), "who": (2, F.col("user_id").cast("int")), "what": (3, F.col("event_type")), "amount": (4, F.floor("value").cast("int"))},
        {"id": (1, n), "who": (2, F.col("user_id").cast("int")), "kind": (3, F.col("event_type")), "amount": (4, F.floor("value").cast("int")), "at": (5, F.col("ts"))},
        {"event": (1, n), "user": (2, F.col("user_id")), "kind": (3, F.col("event_type")), "amount": (4, F.col("value")), "at": (5, F.to_date("ts")), "note": (6, n)},
        {"event": (1, n), "user": (2, F.col("user_id")), "kind": (3, F.col("event_type")), "amount": (4, F.col("value")), "at": (5, F.col("ts")), "note": (6, F.col("props"))},
    )
    for version, fields in enumerate(made):
        columns = [c.alias(name, metadata={evolution.FIELD_ID: number}) for name, (number, c) in fields.items()]
        events.where(n % 4 == version).select(*columns).write.parquet(f"{path}/v{version}")
    return path


def evolved_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of four schemas as one table, under the newest names and the least common types."""
    return evolution.read_evolved(spark, _event_files(spark, sf_dir)).select("event", "user", "kind", "amount", "at", "note")


def schema_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of those files that no exact type holds: each type with its rows."""
    return evolution.conflicts(spark, _event_files(spark, sf_dir)).select("column", "type", "row_count")


def recoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types of code lists 1 to 3 in list 4, splits by weight: rows and weights per day and code."""
    mapping = spark.createDataFrame(
        [
            (1, "click", "tap", 1.0),
            (2, "tap", "press", 0.75),
            (2, "tap", "swipe", 0.25),
            (2, "view", "look", 1.0),
            (3, "swipe", "press", 0.5),
            (3, "swipe", "drag", 0.5),
            (3, "error", "fault", 1.0),
        ],
        "version int, old string, new string, weight double",
    )
    listed = (F.col("event_id") % 4 + 1).cast("int").alias("list")
    events = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("code"), listed)
    found = evolution.recoded(events, mapping, "code", "list", 4)
    return found.groupBy("day", "code").agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum("weight"), 4).alias("weight"))


ORDER_RULES = (
    rules.Unique("orders.key", ("o_orderkey",)),
    rules.Unique("orders.customer_day", ("o_custkey", "o_orderdate")),
    rules.ForeignKey("orders.customer", ("o_custkey",), "customer", ("c_custkey",)),
    rules.Range("orders.price", "o_totalprice", 1000.0, 400000.0),
    rules.Condition("orders.status", "o_orderstatus in ('O', 'F')"),
    rules.Share("orders.urgent", "o_orderpriority = '1-URGENT'", 0.15),
    rules.Fresh("orders.fresh", "o_orderdate", datetime(2024, 1, 1)),
)
LINE_RULES = (
    rules.Unique("lines.key", ("l_orderkey", "l_linenumber")),
    rules.ForeignKey("lines.order", ("l_orderkey",), "orders", ("o_orderkey",)),
    rules.Range("lines.quantity", "l_quantity", 1.0, 45.0),
    rules.Condition("lines.price", "l_extendedprice * (1 - l_discount) > 1500"),
)
EVENT_RULES = (
    rules.NotNull("events.user", "user_id"),
    rules.ForeignKey("events.customer", ("user_id",), "customer", ("c_custkey",)),
    rules.Condition("events.type", "event_type <> 'error'"),
    rules.Share("events.small", "value < 20", 0.5),
)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules declared on orders, lines and events: a verdict for each."""
    tables = {name: table(spark, sf_dir, name) for name in ("orders", "lineitem", "events", "customer")}
    return rules.verdicts(tables, {"orders": ORDER_RULES, "lineitem": LINE_RULES, "events": EVENT_RULES})


def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that break a rule, counted by order and by what they break."""
    found = rules.quarantined(table(spark, sf_dir, "lineitem"), LINE_RULES)
    return found.groupBy(F.col("l_orderkey").alias("orderkey"), F.array_join("broken", ",").alias("broken")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def tokenised_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined to customers by the tokens of both: tokens, what they stand for, and under a new key."""
    number = lambda key: F.lpad(F.col(key).cast("string"), 9, "0")
    people = table(spark, sf_dir, "customer").select(
        tokens.protected(F.concat(F.lit("C-"), number("c_custkey")), "first key").alias("token")
    )
    orders = table(spark, sf_dir, "orders").select(
        tokens.protected(F.concat(F.lit("C-"), number("o_custkey")), "first key").alias("token")
    )
    counted = orders.groupBy("token").agg(F.count(F.lit(1)).alias("row_count"))
    return people.join(counted, "token", "left").select(
        "token",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        tokens.revealed(F.col("token"), "first key").alias("customer"),
        tokens.rotated(F.col("token"), "first key", "second key").alias("rotated"),
    )


# Who may be named where; a line names its order only, and a nation or a shop nobody.
SUBJECT_SOURCES = (
    subjects.Source("customer", ("c_custkey",), (subjects.InColumn("customer", "c_custkey"),)),
    subjects.Source(
        "orders", ("o_orderkey",), (subjects.InColumn("customer", "o_custkey"), subjects.InColumn("order", "o_orderkey"))
    ),
    subjects.Source("lineitem", ("l_orderkey", "l_linenumber"), (subjects.InColumn("order", "l_orderkey"),)),
    subjects.Source("events", ("event_id",), (subjects.InColumn("customer", "user_id"),)),
    subjects.Source(
        "documents",
        ("doc_id",),
        (
            subjects.InText("mail", "text", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", fold=True),
            subjects.InText("phone", "text", r"\+[0-9][0-9 ()-]{7,}[0-9]", drop="[^0-9+]"),
        ),
    ),
)


def subject_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is held about every customer and every e-mail address in the texts, by table."""
    tables = {s.table: table(spark, sf_dir, s.table) for s in SUBJECT_SOURCES}
    said = stage(subjects.mentions(tables, SUBJECT_SOURCES, mark=True), "mentions")
    name = F.concat_ws(":", "kind", "identifier").alias("request")
    asked = said.where(F.col("kind").isin("customer", "mail")).select(name, "kind", "identifier")
    rows = subjects.rows_of(said, subjects.closure(said, asked))
    # Requests begin alike, which makes sorts slow; their hashes do not.
    return rows.groupBy(F.xxhash64("request").alias("hash"), "request", "table").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("depth").cast("long").alias("nearest"),
        F.max("depth").cast("long").alias("furthest"),
        F.min("path").alias("first_path"),
        F.max("path").alias("last_path"),
    ).drop("hash")


def erased_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files by customer, two runs of erasure, and orders that arrive again: by customer."""
    path, log = fresh_path(spark, "orders"), fresh_path(spark, "erasure-log")
    orders = table(spark, sf_dir, "orders")
    orders.repartitionByRange("o_custkey").write.parquet(path)
    customer = table(spark, sf_dir, "customer")
    runs = {"poor": "c_acctbal < -900", "one nation": "c_nationkey = 7 and c_mktsegment = 'BUILDING'"}
    for run, where in runs.items():
        erasure.erase(spark, path, "o_custkey", customer.where(where).select("c_custkey"), log, run, salt="salt")
    stones = erasure.tombstones(spark, log)
    again = erasure.without_erased(orders.where("o_orderkey % 10 = 0"), "o_custkey", stones, salt="salt")
    removed = spark.read.parquet(under(log, "removed")).groupBy("subject").agg(F.sum("rows_removed").alias("removed"))

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias(name)).withColumnRenamed("o_custkey", "custkey")

    people = customer.select(F.col("c_custkey").alias("custkey"), erasure.digest(F.col("c_custkey"), "salt").alias("subject"))
    told = stones.groupBy("subject").agg(F.count(F.lit(1)).alias("runs"))
    every = (
        people.join(counted(erasure.read(spark, path), "kept"), "custkey", "left")
        .join(counted(again, "arrived"), "custkey", "left")
        .join(removed, "subject", "left")
        .join(told, "subject", "left")
    )
    return every.select("custkey", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("kept", "arrived", "removed", "runs")])


def classifier_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rules that judge labelled texts by their look: accuracies with intervals, and their difference."""
    documents = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    judged = documents.select(
        F.col("doc_id").alias("key"),
        (F.col("quality") == 1 - F.col("toxic")).alias("polite"),
        (F.col("quality") == (F.col("n_chars") >= 300).cast("int")).alias("long"),
    )
    return significance.compared(judged, "key", "polite", "long", replicates=200, places=PLACES)


QUERIES = (subject_access, erased_orders, classifier_intervals, tokenised_orders, quality_rules, quarantined_lines, evolved_events, schema_conflicts, recoded_events, customer_history, orders_as_of, reconcile_lines, stream_scores, stream_windows, layered_orders)
