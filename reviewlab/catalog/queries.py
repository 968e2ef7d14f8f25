"""Every operator as a query over the given tables, whole.

Vectors come out as rows of coordinates and learned or computed doubles are
rounded, so that results can be compared by value.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab import sinks
from reviewlab.catalog import data_queries
from reviewlab.config import RunConfig
from reviewlab.contracts import REVIEWS
from reviewlab.functions import text, vectors
from reviewlab.functions.keys import in_train
from reviewlab.operators import audit, features, hygiene, models
from reviewlab.plans import job
from reviewlab.plans.compare import compare_feature_sets, training_rows
from reviewlab.plans.featurize import COMMON, Tokens, feature_sets, hashed_counts, tokens_of
from reviewlab.scratch import fresh_path, stage
from reviewlab.sources import delimited, manifest
from reviewlab.sources.tables import labelled_reviews, table, unchecked_reviews

Query = Callable[[SparkSession, str], DataFrame]

RUN_ID = "run-of-the-catalog"
REVIEW_TABLE_DDL = "review_id bigint, review string, sentiment string"
PLACES = 6
# A fit whose slopes, per standard deviation and row, are below this is an optimum.
NO_SLOPE = 1e-3
# Words, with a number each, that are sent to all executors at once.
SENT_WORDS = 500_000
GERMAN_LETTERS = "äöüßÄÖÜ"
GERMAN_WORDS = (r"ein(e|er|es)?", r"nicht", r"und", r"für", r"d(er|ie|as)\s+(sich|auch)")


# --- sources and sinks -------------------------------------------------------------------------


def _scanned(df: DataFrame) -> DataFrame:
    return df.select(
        "review_id",
        "sentiment",
        F.length("review").cast("bigint").alias("n_chars"),
        manifest.text_digest(F.col("review")).alias("digest"),
    )


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the shape of reviews; a scan does not need labels."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("text").alias("review"), F.col("lang").alias("sentiment")
    )


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quoted newlines are unchanged after a round trip."""
    path = fresh_path(spark, "reviews-csv")
    delimited.write_reviews(_texts(spark, sf_dir), path)
    return _scanned(
        delimited.read_reviews(spark, path, schema=REVIEW_TABLE_DDL, multi_line=True)
    )


def scan_csv_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per line, so that any file can be split over tasks."""
    path = fresh_path(spark, "reviews-csv")
    one_line = F.regexp_replace("review", r"[\r\n]+", " ")
    delimited.write_reviews(_texts(spark, sf_dir).withColumn("review", one_line), path)
    return _scanned(delimited.read_reviews(spark, path, schema=REVIEW_TABLE_DDL))


def features_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed counts stored by label and read back."""
    config = RunConfig(sf_dir, fresh_path(spark, "output"), RUN_ID, persist=True)
    _, counted = _hashed_reviews(spark, sf_dir)
    path = sinks.write_features(counted, sinks.HASHED_COUNTS, config)
    return (
        spark.read.parquet(path)
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(vectors.nonzeros("features")).alias("nonzeros"),
        )
    )


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored model scores raw text exactly as the live one does, whatever the cleaning."""
    rows = [
        _roundtrip(spark, sf_dir, name, **options)
        for name, options in (
            ("default", {}),
            ("space", {"replacement": " "}),
            ("own stop words", {"stop_words": ["the", "de", "les"]}),
        )
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _roundtrip(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """Scored from the stored tokens, as in training, and from raw text by the stored model."""
    config = RunConfig(sf_dir, fresh_path(spark, "output"), RUN_ID, persist=True)
    reviews = labelled_reviews(spark, sf_dir)
    tokens = tokens_of(reviews, **options)
    counted = hashed_counts(tokens)
    rows = training_rows(counted.table)
    fitted = models.LogisticRegressionAlone(maxIter=10).fit(rows.select("label", "features"))
    live = PipelineModel([*counted.stages, fitted])
    stored = PipelineModel.load(
        sinks.write_model(live, sinks.model_name("LogisticRegression", counted.name), config)
    )
    scored = fitted.transform(rows).select("review_id", F.col("probability").alias("live_probability"))
    same = F.unwrap_udt("probability") == F.unwrap_udt("live_probability")
    return stored.transform(reviews).join(scored, "review_id").agg(
        F.lit(name).alias("cleaning"),
        F.count(F.lit(1)).alias("scored"),
        F.count_if(same).alias("same_score"),
    )


def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.record_manifest(
        table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text")
    )


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the table files themselves."""
    listed = manifest.file_manifest(spark, sf_dir, pattern="*.parquet")
    return listed.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "digest"
    )


def manifest_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was announced against what arrived.

    Spanish texts did not arrive, German ones arrived in upper case, and French
    ones were announced without a digest.
    """
    documents = table(spark, sf_dir, "documents")
    key, content = F.col("doc_id"), F.col("text")
    expected = manifest.record_manifest(documents, key, F.when(F.col("lang") != "fr", content))
    arrived = documents.where(F.col("lang") != "es")
    changed = F.when(F.col("lang") == "de", F.upper(content)).otherwise(content)
    actual = manifest.record_manifest(arrived, key, changed)
    return manifest.verify(expected, actual).select("path", "expected_digest", "status")


def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents still to load, when the labelled ones are loaded already."""
    key, content = F.col("doc_id"), F.col("text")
    offered = manifest.record_manifest(table(spark, sf_dir, "documents"), key, content)
    loaded = manifest.record_manifest(
        labelled_reviews(spark, sf_dir), F.col("review_id"), F.col("review")
    )
    return manifest.pending(offered, loaded).select("path", "length", "digest")


def manifest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on all documents as they are, and with the German ones changed."""
    documents = table(spark, sf_dir, "documents")
    key, content = F.col("doc_id"), F.col("text")
    expected = manifest.record_manifest(documents, key, content)
    changed = F.when(F.col("lang") == "de", F.concat(content, F.lit("!"))).otherwise(content)
    actual = manifest.record_manifest(documents, key, changed)
    verdicts = [
        ("same", manifest.all_valid(expected, expected)),
        ("changed", manifest.all_valid(expected, actual)),
    ]
    return spark.createDataFrame(verdicts, "offered string, valid boolean")


def load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, one folder per source, loaded; one source changed, loaded again."""
    source, target = fresh_path(spark, "offered"), fresh_path(spark, "loaded")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("src"))
    documents.write.partitionBy("src").parquet(source)

    def load() -> DataFrame:
        offered = manifest.file_manifest(spark, source, pattern="*.parquet")
        manifest.load_pending(spark, lambda paths: spark.read.parquet(*paths), offered, target)
        return offered

    load()
    changed = documents.where("src = 'src0'").select("doc_id", F.concat("text", F.lit("!")).alias("text"))
    changed.write.mode("overwrite").parquet(f"{source}/src=src0")
    current = manifest.current_rows(spark, target, load())
    return current.select("doc_id", manifest.text_digest(F.col("text")).alias("text_digest"))


# --- contract and audit ------------------------------------------------------------------------


def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REVIEWS.domain_violations(unchecked_reviews(spark, sf_dir), "sentiment")


def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.null_report(unchecked_reviews(spark, sf_dir))
    return found.withColumn("null_pct", F.round("null_pct", PLACES))


def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.drop_nulls(unchecked_reviews(spark, sf_dir))


def row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.row_counts(unchecked_reviews(spark, sf_dir))


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.class_balance(labelled_reviews(spark, sf_dir))


def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = {c: sorted(v) for c, v in REVIEWS.allowed.items()}
    named = audit.counts(["review", "sentiment"], domains)
    return audit.audit_rows(unchecked_reviews(spark, sf_dir), named, RUN_ID)


def audit_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = RunConfig(sf_dir, fresh_path(spark, "output"), RUN_ID, persist=True)
    return audit.read_audit(spark, sinks.append_audit(run_audit(spark, sf_dir), config))


def job_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over all labelled reviews: what it counted."""
    raw = fresh_path(spark, "reviews-csv")
    delimited.write_reviews(labelled_reviews(spark, sf_dir).select("review", "sentiment"), f"{raw}/dataset.csv")
    config = RunConfig(raw, fresh_path(spark, "output"), RUN_ID, persist=True)
    code = job.run(spark, config, multi_line=True, word2vec=_in_parallel(spark))
    found = audit.read_audit(spark, config.audit_path)
    return found.select("event", "subject", F.when(F.col("event") != "accuracy", F.col("value")).alias("value")).withColumn(
        "exit_code", F.lit(code).cast("bigint")
    )


# --- text --------------------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str, **columns) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", *(c.alias(name) for name, c in columns.items())
    )


def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = text.strip_tags(F.col("html")).alias("stripped")
    return table(spark, sf_dir, "pages").select("page_id", stripped)


def letters_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, letters=text.letters_only(F.col("text")))


def collapse_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, collapsed=text.collapse_spaces(F.col("text")))


def lowercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, lowered=F.lower("text"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages alike."""
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("raw")
    )
    documents = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("raw")
    )
    return documents.union(pages).select(
        "kind", "id", text.clean_text(F.col("raw")).alias("cleaned")
    )


def _word_list(df: DataFrame, words: str) -> DataFrame:
    return df.select(
        "doc_id",
        F.size(words).cast("bigint").alias("n_words"),
        F.array_join(words, " ").alias("words"),
    )


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_list(_documents(spark, sf_dir, found=text.tokenize(F.col("text"))), "found")


def remove_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = text.remove_stop_words(text.tokenize(F.col("text")))
    return _word_list(_documents(spark, sf_dir, kept=kept), "kept")


def _content_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.content_words(text.clean_text(F.col("text")))
    return _documents(spark, sf_dir, filtered=words)


def clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_list(_content_words(spark, sf_dir), "filtered")


# --- features ----------------------------------------------------------------------------------


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = labelled_reviews(spark, sf_dir).select("review_id", "sentiment")
    return features.fit_label_index(reviews).transform(reviews)


def hashing_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = features.hashing_tf().transform(_content_words(spark, sf_dir))
    return vectors.to_rows(counted, ["doc_id"], "rawfeatures", index="bucket", value="tf")


def _counted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = features.hashing_tf().transform(_content_words(spark, sf_dir))
    return stage(counted.select("doc_id", "rawfeatures"), "counts")


def idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = features.hashing_tf().transform(_content_words(spark, sf_dir).select("filtered"))
    fitted = features.idf_rows(counted, features.fit_idf(counted))
    return fitted.withColumn("idf", F.round("idf", PLACES))


def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitting and weighting read the same stored counts: texts are cleaned and hashed once."""
    counted = _counted_documents(spark, sf_dir)
    weighted = features.fit_idf(counted).transform(counted)
    cells = vectors.to_rows(weighted, ["doc_id"], "features", index="bucket", value="tf_idf")
    return cells.where(F.col("tf_idf") != 0).withColumn("tf_idf", F.round("tf_idf", PLACES))


def _in_parallel(spark: SparkSession) -> dict:
    """Word vectors are learned by as many tasks as the cluster runs at once."""
    return {"tasks": spark.sparkContext.defaultParallelism}


def w2v_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.vocabulary(_content_words(spark, sf_dir))


def w2v_doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each document's vector is the sum of its known words' vectors over all its words.

    Vectors are compared along one direction: one number per word and document.
    """
    listed = F.coalesce("filtered", F.array().cast("array<string>"))
    words = _content_words(spark, sf_dir).withColumn("filtered", listed).withColumn("n_words", F.size("filtered").cast("bigint"))
    words = stage(words, "words", compression="zstd")
    model = features.fit_word2vec(words.select("filtered"), **_in_parallel(spark))
    direction = F.array(*[F.lit(math.cos(i)) for i in range(features.VECTOR_SIZE)])

    def along(vector: str) -> Column:
        return F.aggregate(
            F.zip_with(vector_to_array(vector), direction, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b
        )

    known = stage(model.getVectors().select("word", along("vector").alias("part")), "known")
    # Known words are sent to where the texts are, some at a time: a row per word of all texts would be exchanged else.
    blocks = max(1, -(-known.count() // SENT_WORDS))
    block = F.pmod(F.xxhash64("word"), F.lit(blocks))
    of_texts = words.select("doc_id", F.explode("filtered").alias("word"))
    told = [of_texts.join(F.broadcast(known.where(block == i)), "word") for i in range(blocks)]
    sums = (
        reduce(DataFrame.unionByName, told)
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n_known"), F.sum("part").alias("total"))
    )
    found = model.transform(words).select("doc_id", "n_words", along("features").alias("mean"))
    gap = F.col("mean") * F.col("n_words") - F.coalesce("total", F.lit(0.0))
    return found.join(sums, "doc_id", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_known", F.lit(0)).alias("n_known"),
        (F.abs(gap) < 1e-4 * (F.col("n_words") + 1)).alias("is_mean"),
    )


def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    scaled = features.fit_min_max(points.select("features")).transform(points)
    cells = vectors.to_rows(scaled, ["vec_id"], "scaledFeatures")
    return cells.withColumn("value", F.round("value", PLACES))


def feature_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three tables in one shape: the same columns, rows and dimensions."""
    built = feature_sets(tokens_of(labelled_reviews(spark, sf_dir)), word2vec=_in_parallel(spark))
    shaped = [
        one.table.select(F.lit(name).alias("feature_set"), *COMMON) for name, one in built.items()
    ]
    together = shaped[0].unionByName(shaped[1]).unionByName(shaped[2])
    return together.groupBy("feature_set", "sentiment", "label").agg(
        F.count("features").alias("row_count"),
        F.min(vectors.dimensions("features")).cast("bigint").alias("min_dims"),
        F.max(vectors.dimensions("features")).cast("bigint").alias("max_dims"),
        F.sum(F.length("review")).alias("cleaned_chars"),
    )


def featurize_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and non-zero cells per feature set; scaled word vectors are dense, so no cell count."""
    parts = []
    tokens = tokens_of(labelled_reviews(spark, sf_dir))
    for name, one in feature_sets(tokens, word2vec=_in_parallel(spark)).items():
        dense = name == sinks.WORD_VECTORS
        cells = F.lit(None).cast("bigint") if dense else F.sum(vectors.nonzeros("features"))
        parts.append(
            one.table.agg(
                F.lit(name).alias("feature_set"),
                F.count("features").alias("row_count"),
                cells.alias("nonzeros"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- models ------------------------------------------------------------------------------------


def _hashed_reviews(spark: SparkSession, sf_dir: str) -> tuple[Tokens, DataFrame]:
    """Key, label and hashed counts of the labelled reviews, from stored words."""
    tokens = tokens_of(labelled_reviews(spark, sf_dir))
    return tokens, training_rows(hashed_counts(tokens).table)


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", in_train(F.col("doc_id")).alias("is_train")
    )


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides have rows, and every label is on one of them."""
    train, test = models.split_at_random(table(spark, sf_dir, "labels").select("doc_id"))
    sides = train.withColumn("side", F.lit("train")).union(test.withColumn("side", F.lit("test")))
    return sides.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("doc_id").alias("documents"),
        F.countDistinct("side").alias("sides"),
    )


def lr_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the fit is an optimum: per bucket, and as -1 for the intercept, whether the slope is gone."""
    _, rows = _hashed_reviews(spark, sf_dir)
    train, _ = models.split_by_key(rows, "review_id")
    model = models.LogisticRegressionAlone().fit(train)
    slopes = models.slopes(model, train)
    return slopes.select("dim", (F.abs("slope") < NO_SLOPE).alias("is_optimum"))


def _plausible(accuracy: str) -> Column:
    return F.col(accuracy).between(0, 100).alias("plausible")


def cv_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = _hashed_reviews(spark, sf_dir)
    train, _ = models.split_by_key(rows, "review_id")
    found = models.grid_rows(spark, models.cross_validate(train, key="review_id"))
    return found.select("max_iter", _plausible("accuracy"))


def lr_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled review scored by a model of its training side, and whether the class is the side of the plane."""
    _, rows = _hashed_reviews(spark, sf_dir)
    train, _ = models.split_by_key(rows, "review_id")
    model = models.LogisticRegressionAlone(maxIter=10).fit(train)
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients.toArray()])
    products = F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w)
    margin = F.aggregate(products, F.lit(float(model.intercept)), lambda total, x: total + x)
    agrees = (F.abs(margin) < 1e-9) | ((margin > 0) == (F.col("prediction") == 1.0))
    is_class = F.col("prediction").isin(0.0, 1.0) & agrees
    return model.transform(rows).select("review_id", "label", is_class.alias("is_class"))


def accuracy_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a text is of good quality exactly when it is not toxic."""
    judged = table(spark, sf_dir, "labels").select(
        F.col("quality").cast("double").alias("label"),
        (1 - F.col("toxic")).cast("double").alias("prediction"),
    )
    return models.accuracy_percent(judged).select(F.round("accuracy", PLACES).alias("accuracy"))


def train_eval_htf(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = _hashed_reviews(spark, sf_dir)
    result, _ = models.train_and_score("LogisticRegression", rows, sinks.HASHED_COUNTS)
    return models.result_rows(spark, [result])


def compare_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighting scales columns and fitting evens scales out, so hashed counts and TF-IDF are equally accurate."""
    tokens = tokens_of(labelled_reviews(spark, sf_dir))
    results = compare_feature_sets(tokens, word2vec=_in_parallel(spark))
    counted = next(r.accuracy for r in results if r.feature_name == sinks.HASHED_COUNTS)
    found = models.result_rows(spark, results)
    like_counts = F.when(F.col("feature_name") != sinks.WORD_VECTORS, F.abs(F.col("accuracy") - counted) < 0.5)
    return found.select("classifier_name", "feature_name", _plausible("accuracy"), like_counts.alias("like_counts"))


# --- language scan -----------------------------------------------------------------------------


def language_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hygiene.scan_lines(table(spark, sf_dir, "documents"), ["doc_id"])


def language_scan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings as a report prints them."""
    return language_scan(spark, sf_dir).select(
        "doc_id", "line_no", "kind", hygiene.shown(F.col("content")).alias("shown")
    )


def language_scan_german(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scan for another language, in which whole words decide more often."""
    documents = table(spark, sf_dir, "documents")
    return hygiene.scan_lines(
        documents, ["doc_id"], letters=GERMAN_LETTERS, patterns=GERMAN_WORDS
    )


def language_scan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings per kind, for both languages together; each line is cut and read once."""
    line = F.col("line")
    kinds = F.array(
        hygiene.finding_kind(line), hygiene.finding_kind(line, GERMAN_LETTERS, GERMAN_WORDS)
    )
    lines = hygiene.lines_of(table(spark, sf_dir, "documents"), ["doc_id"], "text")
    found = lines.select(F.explode(kinds).alias("kind")).where(F.col("kind").isNotNull())
    return hygiene.summary(found)


def file_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pages a scan by suffix would look at, going by the last part of their urls."""
    scope = hygiene.in_scope(F.col("url"), suffixes=[".html"], names=["665"], excluded=["474.html"])
    return table(spark, sf_dir, "pages").select("page_id", scope.alias("in_scope"))


QUERIES: tuple[Query, ...] = (
    scan_csv,
    scan_csv_by_line,
    features_roundtrip,
    model_roundtrip,
    content_digest,
    file_manifest,
    manifest_verify,
    manifest_valid,
    incremental_files,
    load_incremental,
    domain_violations,
    null_report,
    drop_nulls,
    row_audit,
    class_balance,
    run_audit,
    audit_json_roundtrip,
    job_audit,
    strip_html,
    letters_only,
    collapse_spaces,
    lowercase,
    clean_text,
    tokenize,
    remove_stopwords,
    clean_tokens,
    label_index,
    hashing_tf,
    idf_weights,
    tf_idf,
    w2v_vocab,
    w2v_doc_vectors,
    minmax_scale,
    feature_shape,
    featurize_all,
    hash_split,
    random_split,
    lr_fit,
    cv_grid,
    lr_predict,
    accuracy_eval,
    train_eval_htf,
    compare_features,
    language_scan,
    language_scan_german,
    language_scan_report,
    language_scan_summary,
    file_scope,
    *data_queries.QUERIES,
)
