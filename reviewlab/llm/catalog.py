"""The dealt operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.llm import ann, collocations, decontaminate, language, minhash, pieces, quality, secrets, sharding, suffixes, trie, urls, warc
from reviewlab.scratch import fresh_path
from reviewlab.sources.tables import table

# A model file that users replace by their own.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# The rules of the url filter: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of a shuffled corpus, equal in rows."""
    shuffle = sharding.shuffled(table(spark, sf_dir, "documents"))
    text = F.coalesce("record.text", F.lit(""))
    return sharding.sharded(shuffle, 8).select(
        "record.doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages, rules).select("row.page_id", "host", "path", "rule", "verdict")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a record and read back."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), "url", F.col("html").cast("binary").alias("payload")
    )
    path = fresh_path(spark, "archives")
    warc.write_archives(warc.with_revisits(pages), path)
    number = lambda column: F.nullif(F.regexp_extract(column, "[0-9-]*$", 0), F.lit("")).cast("long")
    return warc.read_archives(spark, path).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


def op4_pieces(spark: SparkSession, sf_dir: str, model_path: str = MODEL) -> DataFrame:
    """The pieces of every document, and whether they decode to its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.with_pieces(docs, pieces.read_model(model_path), keep_text=False)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1).alias("held_out")
    )
    model = language.fit(docs.where("not held_out"), text="text", label="lang")
    found = docs.select("doc_id", "held_out", language.identified(F.col("text"), model).alias("f"))
    return found.select(
        "doc_id", "held_out", F.col("f.lang").alias("lang_pred"), "f.score", "f.ambiguous"
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, linked at 80 of 100."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, one row per item found."""
    items = table(spark, sf_dir, "benchmark")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", F.explode(decontaminate.hits(F.col("text"), items)).alias("h"))
    return found.select(
        "doc_id",
        F.col("h.item").alias("item_id"),
        "h.score",
        F.col("h.question").alias("question_overlap"),
        F.col("h.answer").alias("answer_overlap"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new ledger, filled with all documents and joined back to them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = fresh_path(spark, "ledger")
    secrets.update(docs, ledger)
    found = secrets.findings(docs, ledger)
    rules = F.transform("found", lambda s: s["rule"])
    counts = [
        (F.size("found") - F.size(F.array_remove(rules, rule.name))).cast("long").alias(f"n_{rule.name}")
        for rule in secrets.RULES
    ]
    spans = secrets.listed(F.col("found"))
    return found.select(
        "row.doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur twice or more."""
    return suffixes.without_repeats(table(spark, sf_dir, "documents"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    rows = table(spark, sf_dir, "embeddings")
    found = ann.nearest(rows, rows.where("vec_id % 20 = 0"), k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the labels that are not held out."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = quality.fit(docs.where(~held_out), labels, label="quality")
    found = docs.select("doc_id", held_out.alias("held_out"), quality.scored(F.col("text"), model).alias("f"))
    return found.select(
        "doc_id",
        "held_out",
        "f.score",
        (F.col("f.score") >= 0.7).cast("int").alias("predicted"),
        "f.passage",
        "f.weight",
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """Placed turns, with the first turns of every conversation those of the one it stems from.

    Conversation c takes its first h turns from c - c % 5 and goes on with its own turns
    after its first h; h is a hash of c.
    """
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"))
    head = (F.crc32(F.col("conv").cast("string")) % 9).alias("h")
    convs = sizes.select("conv", head, (F.col("conv") - F.col("conv") % 5).alias("base"))
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left")
    convs = convs.withColumn("n_base", F.coalesce("n_base", F.lit(0).cast("long")))
    columns = ("t1", "t2", "bytes")
    taken = (
        turns.where("place <= 8")
        .withColumnRenamed("conv", "base")
        .join(convs.select("conv", "base", "h"), "base")
        .where("place <= h")
        .select("conv", "place", *columns)
    )
    place = F.col("place") - F.col("h") + F.least("h", "n_base")
    own = turns.join(convs, "conv").where("place > h").select("conv", place.alias("place"), *columns)
    return taken.unionByName(own)


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the rebuilt conversations."""
    turns = trie.placed(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return trie.nodes(rebuilt(turns), turns.select("conv"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language."""
    return collocations.mined(table(spark, sf_dir, "documents"))


QUERIES = [op1_sharding, op2_url_filters, op3_warc, op4_pieces, op5_language, op6_minhash, op7_decontaminate, op8_secrets, op9_suffixes, op10_ann, op11_quality, op12_trie, op13_collocations]


def oracle_sql() -> dict[str, str]:
    rules = ", ".join(str(rule) for rule in URL_RULES)
    kinds = [
        f"""
select doc_id, '{rule.name}' as kind, {i} as ord, unnest(list_filter(list_transform(
    range(0, (len(parts) - 1) // 3),
    lambda k: {{'a': coalesce(list_sum(list_transform(parts[1:3 * k + 1], lambda p: length(p))), 0)::bigint,
               'b': length(parts[3 * k + 2]) + length(parts[3 * k + 3]),
               'size': length(parts[3 * k + 3])}}), lambda s: s.size >= {rule.least})) as s
from (select doc_id, string_split(regexp_replace(translate(coalesce(text, ''), chr(1), chr(2)),
    '{rule.pattern.replace("'", "''")}', chr(1) || '\\1' || chr(1) || '\\2' || chr(1), 'g'), chr(1)) as parts
  from documents)"""
        for i, rule in enumerate(secrets.RULES)
    ]
    return {
        "op13_collocations": f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[.,;:!?\n\x0B\f\r]')) as piece
  from documents),
split as (
  select lang, row_number() over () as id,
    list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') as ws from pieces),
words as (select lang, id, unnest(ws) as w, unnest(range(len(ws))) as i from split),
runs as (
  select lang, w, lead(w, 1) over p as w2, lead(w, 2) over p as w3, lead(w, 3) over p as w4, lead(w, 4) over p as w5
  from words window p as (partition by id order by i)),
grams as (
  select lang, 1 as size, w as phrase from runs
  union all select lang, 2, w || ' ' || w2 from runs where w2 is not null
  union all select lang, 3, w || ' ' || w2 || ' ' || w3 from runs where w3 is not null
  union all select lang, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4 from runs where w4 is not null
  union all select lang, 5, w || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 from runs where w5 is not null),
f as (select lang, size, phrase, count(*) as f from grams group by all),
total as (select lang, sum(f)::bigint as n from f where size = 1 group by lang),
cand as (select lang, size, phrase, f as a from f where size > 1 and f >= {collocations.LEAST}),
cuts as (
  select c.*, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') as head,
    array_to_string(string_split(phrase, ' ')[k + 1:], ' ') as tail
  from cand c, (values (1), (2), (3), (4)) s(k) where k < size),
scored as (
  select c.lang, c.size, c.phrase, c.a, x.f as l, y.f as r, n,
    ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score,
    row_number() over (partition by c.lang, c.phrase order by (1000::hugeint * a * n) // (x.f::hugeint * y.f), k) as place
  from cuts c join f x on x.lang = c.lang and x.phrase = head join f y on y.lang = c.lang and y.phrase = tail
    join total t on t.lang = c.lang),
kept as (
  select * from scored s where place = 1 and not exists (
    select 1 from cand b where b.lang = s.lang and b.a = s.a and b.size > s.size
      and strpos(' ' || b.phrase || ' ', ' ' || s.phrase || ' ') > 0))
select * from (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
  from kept) where rank <= {collocations.TOP}""",
        "op12_trie": """
with turns as (
  select conv_id as c, row_number() over (
      partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place,
    coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
alphabet as (
  select i, list_reduce(list_concat([i::ubigint], range(8)), lambda x, j:
    case when x % 2 = 1 then xor(x // 2, 3988292384::ubigint) else x // 2 end) as v from range(256) r(i)),
lookup as (select list(v order by i) as t from alphabet),
convs as (
  select c, c - c % 5 as base, xor(list_reduce(list_concat([4294967295::ubigint],
      list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::ubigint)), lambda x, y:
      xor(x // 256, t[(xor(x, y) % 256 + 1)::int])), 4294967295::ubigint) % 9 as h
  from (select distinct c from turns), lookup),
sizes as (select c, count(*) as n from turns group by c),
built as (
  select v.c, t.place, t.role, t.text from convs v join turns t on t.c = v.base and t.place <= v.h
  union all
  select v.c, t.place - v.h + least(v.h, coalesce(s.n, 0)), t.role, t.text
  from convs v join turns t on t.c = v.c and t.place > v.h left join sizes s on s.c = v.base),
seqs as (
  select v.c, coalesce(list({'r': role, 't': text} order by place) filter (place is not null), []) as seq
  from convs v left join built using (c) group by v.c),
paths as (select c, seq, d::bigint as d, seq[1:d] as key, len(seq) = d as at_end
          from (select c, seq, unnest(range(len(seq) + 1)) as d from seqs)),
keyed as (
  select key, d, min(c) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (at_end), '')) as ends_sha256,
    coalesce(strlen(any_value(seq)[d].t), 0) as size
  from paths group by key, d),
below as (select k.*, p.conv_id as parent_conv_id
          from keyed k left join keyed p on p.d = k.d - 1 and p.key = k.key[1:k.d - 1]),
children as (select key[1:d - 1] as key, count(*) as n_children from keyed where d > 0 group by 1),
own as (select b.*, coalesce(n_children, 0) as n_children from below b left join children using (key)),
sums as (
  select key[1:a] as key, sum((n_children = 0)::int)::bigint as n_leaves,
    sum((n_convs - 1) * size)::bigint as saved_tokens
  from (select *, unnest(range(d + 1)) as a from own) group by 1)
select conv_id, d as depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
from own join sums using (key)""",
        "op8_secrets": f"""
with found as ({" union all ".join(kinds)}),
listed as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign,
    count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || s.a || ':' || (s.a + s.b), ',' order by s.a, ord) as spans
  from found group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(spans, '')) as base_sha256,
  coalesce(spans, '') as spans
from documents left join listed using (doc_id)""",
        "op2_url_filters": rf"""
with parsed as (
  select page_id,
    coalesce(translate(regexp_extract(url, '{urls.PARTS}', 1), '{urls.UPPER}', '{urls.LOWER}'), '') as host,
    coalesce(regexp_extract(url, '{urls.PARTS}', 2), '') as path
  from pages),
rules(verdict, rule_host, rule_path) as (values {rules}),
ranked as (
  select p.*, r.verdict, rule_host || rule_path as rule,
    row_number() over (partition by p.page_id order by len(rule_host || rule_path) desc) as place
  from parsed p left join rules r
    on ('.' || p.host) like ('%.' || rule_host) and starts_with(p.path, rule_path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from ranked where place = 1""",
        "op3_warc": """
with h as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
k as (select *, max(page_id) over (partition by hex) as keeper from h),
bits as (
  select page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + ('0b' ||
      substr(b, (5 * i + 1)::int, 5))::utinyint)::int, 1), '' order by i) as digest
  from (select page_id, list_aggregate(list_transform(range(0, 40), lambda n:
      lpad(bin(('0x' || substr(hex, (n + 1)::int, 1))::utinyint), 4, '0')), 'string_agg', '') as b from k),
    range(32) r(i) group by page_id)
select page_id, strlen(html)::bigint as payload_bytes, digest as payload_digest,
  case when page_id = keeper then 'response' else 'revisit' end as record_type,
  case when page_id <> keeper then keeper end as refers_to
from k join bits using (page_id)""",
    }
