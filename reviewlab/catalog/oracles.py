"""What the catalog's queries must return, as SQL for DuckDB over the same tables.

Learned values are checked by what must hold of them; digests of the table files
themselves and one accuracy have no entry and are checked by tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from reviewlab.catalog import data_oracles
from reviewlab.catalog.queries import GERMAN_LETTERS, GERMAN_WORDS, RUN_ID
from reviewlab.operators.hygiene import MARKED_LETTERS, WORD_PATTERNS

# Spark's default English stop words, in its order.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()


def _quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values if v)


REVIEWS = """
reviews as (
  select d.doc_id as review_id, d.text as review,
         case when l.quality = 1 then 'positive' else 'negative' end as sentiment
  from documents d join labels l using (doc_id))
"""

UNCHECKED = """
unchecked as (
  select d.doc_id as review_id,
         case when d.lang <> 'de' then d.text end as review,
         case when l.toxic = 1 then 'toxic'
              when l.quality = 1 then 'positive'
              when l.quality is not null then 'negative' end as sentiment
  from documents d left join labels l using (doc_id))
"""


def _clean(column: str) -> str:
    stripped = f"regexp_replace({column}, '<[^>]*>', '', 'g')"
    letters = f"regexp_replace({stripped}, '[^A-Za-z ]+', '', 'g')"
    return f"lower(regexp_replace({letters}, ' +', ' ', 'g'))"


def _words(column: str) -> str:
    return f"list_filter(string_split_regex({column}, '\\W'), lambda w: len(w) >= 1)"


def _kept(column: str) -> str:
    return f"list_filter({_words(column)}, lambda w: w not in ({_quoted(STOP_WORDS)}))"


def _word_list(words: str) -> str:
    return f"""
    with found as (select doc_id, {words} as words from documents)
    select doc_id, len(words)::bigint as n_words,
           coalesce(array_to_string(words, ' '), '') as words
    from found"""


def _content_words(table: str, key: str, column: str) -> str:
    """CTE ``content_words(id, word)``, one row per word."""
    return f"""
content_words as (
  select {key} as id, unnest({_kept(_clean(column))}) as word from {table})
"""


# MurmurHash3 (32 bit, seed 42) of each distinct ASCII word, taken modulo 250.
BUCKETS = """
w as (select distinct word as w from content_words),
b as (select w, len(w) n,
  list_transform(range(0, len(w)//4), lambda i: (ascii(w[4*i+1]) + ascii(w[4*i+2])*256
    + ascii(w[4*i+3])*65536 + ascii(w[4*i+4])*16777216)::ubigint) ks,
  list_reduce(list_concat([0::ubigint], list_transform(range(0, len(w)%4), lambda j:
    (ascii(w[(len(w)//4)*4+j+1])*(256**j)::bigint)::ubigint)), lambda x, y: x+y) tail from w),
k as (select w, n,
  list_transform(ks, lambda k: ((((k*3432918353::ubigint)%M)*32768::ubigint%M
    + ((k*3432918353::ubigint)%M)//131072::ubigint)*461845907::ubigint)%M) mk,
  ((((tail*3432918353::ubigint)%M)*32768::ubigint%M
    + ((tail*3432918353::ubigint)%M)//131072::ubigint)*461845907::ubigint)%M mt from b),
r as (select w, xor(xor(list_reduce(list_concat([42::ubigint], mk), lambda h, k:
    (((xor(h,k)*8192::ubigint)%M + xor(h,k)//524288::ubigint)*5::ubigint
    + 3864292196::ubigint)%M), mt), n::ubigint) h from k),
f1 as (select w, (xor(h, h//65536::ubigint)*2246822507::ubigint)%M h from r),
f2 as (select w, (xor(h, h//8192::ubigint)*3266489909::ubigint)%M h from f1),
f3 as (select w, xor(h, h//65536::ubigint) h from f2),
hashed as (select w as word, (((case when h >= 2147483648 then h::bigint - 4294967296
    else h::bigint end) % 250) + 250) % 250 as bucket from f3),
counted as (
  select id, bucket, count(*)::double as tf
  from content_words join hashed using (word) group by id, bucket),
doc_freqs as (select bucket, count(*) as doc_freq from counted group by bucket)
""".replace("M)", "4294967296::ubigint)").replace("%M", "%4294967296::ubigint")


def _weights(table: str) -> str:
    return f"""
weights as (
  select b.bucket, coalesce(f.doc_freq, 0) as doc_freq,
         ln(((select count(*) from {table}) + 1.0) / (coalesce(f.doc_freq, 0) + 1)) as idf
  from range(250) b(bucket) left join doc_freqs f using (bucket))
"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


DOCUMENT_WORDS = _content_words("documents", "doc_id", "text")
REVIEW_WORDS = _content_words("reviews", "review_id", "review")

RANKED = """
ranked as (
  select sentiment, count(*) as row_count,
         (row_number() over (order by count(*) desc, sentiment) - 1)::double as label
  from reviews group by sentiment)
"""

_BOUND = r"[^\p{L}\p{N}_]"
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_BLANK_CODES = (
    "9,10,11,12,13,28,29,30,31,32,133,160,5760,8192,8193,8194,8195,8196,8197,8198,8199,8200,"
    "8201,8202,8232,8233,8239,8287,12288"
)



def _spelled(patterns: Sequence[str]) -> str:
    """Patterns with every blank that text tools know in place of ``\\s``."""
    blanks = "".join(rf"\x{{{int(code):x}}}" for code in _BLANK_CODES.split(","))
    return "|".join(patterns).replace(r"\s", f"[{blanks}]")


def _findings(name: str, letters: str, patterns: Sequence[str]) -> str:
    return f"""
split_{name} as (
  select doc_id, string_split_regex(text, '{_LINE_END}') as lines from documents),
numbered_{name} as (
  select doc_id, unnest(range(1, len(lines) + 1)) as line_no, unnest(lines) as line
  from split_{name}),
judged_{name} as (
  select doc_id, line_no, line,
         case when regexp_matches(line, '[{letters}]') then 'diacritic'
              when regexp_matches(line,
                '(?i)(^|{_BOUND})({_spelled(patterns)})({_BOUND}|$)') then 'keyword'
         end as kind
  from numbered_{name}),
{name} as (
  select doc_id, line_no, kind,
         rtrim(line, list_aggregate(list_transform([{_BLANK_CODES}], lambda c: chr(c)),
                                    'string_agg', '')) as content
  from judged_{name} where kind is not null)
"""


FINDINGS = _findings("findings", MARKED_LETTERS, WORD_PATTERNS)
GERMAN = _findings("german", GERMAN_LETTERS, GERMAN_WORDS)

AUDIT = f"""
select '{RUN_ID}' as run_id, event, subject, value::double as value from (
  select 'rows' as event, '' as subject, count(*) as value from unchecked
  union all select 'complete', '', count(*) from unchecked
    where review is not null and sentiment is not null
  union all select 'nulls', 'review', count(*) from unchecked where review is null
  union all select 'nulls', 'sentiment', count(*) from unchecked where sentiment is null
  union all select 'other', 'sentiment', count(*) from unchecked
    where sentiment not in ('positive', 'negative')
  union all select 'class', 'sentiment.positive', count(*) from unchecked
    where review is not null and sentiment = 'positive'
  union all select 'class', 'sentiment.negative', count(*) from unchecked
    where review is not null and sentiment = 'negative')
"""


def oracle_sql() -> dict[str, str]:
    return data_oracles.oracle_sql() | {
        "scan_csv": """
        select doc_id as review_id, lang as sentiment, length(text) as n_chars,
               sha256(text) as digest from documents""",
        "scan_csv_by_line": """
        with flat as (
        select doc_id as review_id, lang as sentiment,
               regexp_replace(text, '[\\r\\n]+', ' ', 'g') as review from documents)
        select review_id, sentiment, length(review) as n_chars, sha256(review) as digest
        from flat""",
        "features_roundtrip": _with(REVIEWS, RANKED, REVIEW_WORDS, BUCKETS)
        + """
        select label, any_value(row_count) as row_count, count(c.bucket) as nonzeros
        from ranked join reviews using (sentiment) left join counted c on c.id = review_id
        group by label""",
        "model_roundtrip": _with(REVIEWS)
        + """
        select cleaning, count(*) as scored, count(*) as same_score
        from reviews, (values ('default'), ('space'), ('own stop words')) v(cleaning)
        group by cleaning""",
        "content_digest": """
        select doc_id::varchar as path, strlen(text) as length, sha256(text) as digest
        from documents""",
        "manifest_verify": """
        select doc_id::varchar as path,
               case when lang <> 'fr' then sha256(text) end as expected_digest,
               case when lang = 'es' then 'missing'
                    when lang = 'fr' then 'unchecked'
                    when lang = 'de' and sha256(upper(text)) <> sha256(text) then 'mismatch'
                    else 'ok' end as status
        from documents""",
        "manifest_valid": """
        select 'same' as offered, true as valid
        union all select 'changed', count(*) = 0 from documents where lang = 'de'""",
        "load_incremental": """
        select doc_id, sha256(case when source = 'src0' then text || '!' else text end) as text_digest
        from documents""",
        "incremental_files": """
        select doc_id::varchar as path, strlen(text) as length, sha256(text) as digest
        from documents where doc_id not in (select doc_id from labels)""",
        "domain_violations": _with(UNCHECKED)
        + """
        select 'sentiment' as column_name, sentiment as value, count(*) as row_count
        from unchecked
        where sentiment is null or sentiment not in ('positive', 'negative')
        group by sentiment""",
        "null_report": _with(UNCHECKED)
        + """, counted as (
          select count(*) as n, count(*) filter (where review_id is null) as a,
                 count(*) filter (where review is null) as b,
                 count(*) filter (where sentiment is null) as c from unchecked),
        listed as (
          select 'review_id' as column_name, a as null_count, n from counted
          union all select 'review', b, n from counted
          union all select 'sentiment', c, n from counted)
        select column_name, null_count, round(null_count / n * 100, 6) as null_pct
        from listed where null_count > 0""",
        "drop_nulls": _with(UNCHECKED)
        + """
        select * from unchecked
        where review_id is not null and review is not null and sentiment is not null""",
        "row_audit": _with(UNCHECKED)
        + """
        select count(*) as rows_before, count(review || sentiment) as rows_after,
               count(*) - count(review || sentiment) as rows_dropped
        from unchecked""",
        "class_balance": _with(REVIEWS)
        + " select sentiment, count(*) as row_count from reviews group by sentiment",
        "run_audit": _with(UNCHECKED) + AUDIT,
        "audit_json_roundtrip": _with(UNCHECKED) + AUDIT,
        "job_audit": _with(REVIEWS)
        + """
        , counted as (
          select count(*) as n, count(*) filter (where sentiment = 'positive') as p,
                 count(*) filter (where sentiment = 'negative') as m from reviews)
        select event, subject, value::double as value, 0::bigint as exit_code from (
          select 'rows' as event, '' as subject, n as value from counted
          union all select 'complete', '', n from counted
          union all select 'malformed', '', 0
          union all select 'nulls', 'review', 0
          union all select 'nulls', 'sentiment', 0
          union all select 'other', 'sentiment', 0
          union all select 'class', 'sentiment.positive', p from counted
          union all select 'class', 'sentiment.negative', m from counted
          union all select 'accuracy', 'HTFfeaturizedData', null
          union all select 'accuracy', 'TFIDFfeaturizedData', null
          union all select 'accuracy', 'W2VfeaturizedData', null)""",
        "strip_html": """
        select page_id, regexp_replace(html, '<[^>]*>', '', 'g') as stripped from pages""",
        "letters_only": """
        select doc_id, regexp_replace(text, '[^A-Za-z ]+', '', 'g') as letters
        from documents""",
        "collapse_spaces": """
        select doc_id, regexp_replace(text, ' +', ' ', 'g') as collapsed from documents""",
        "lowercase": "select doc_id, lower(text) as lowered from documents",
        "clean_text": f"""
        select 'document' as kind, doc_id as id, {_clean("text")} as cleaned from documents
        union all select 'page', page_id, {_clean("html")} from pages""",
        "tokenize": _word_list(_words("lower(text)")),
        "remove_stopwords": _word_list(_kept("lower(text)")),
        "clean_tokens": _word_list(_kept(_clean("text"))),
        "label_index": _with(REVIEWS, RANKED)
        + """
        select review_id, sentiment, label from reviews join ranked using (sentiment)""",
        "hashing_tf": _with(DOCUMENT_WORDS, BUCKETS)
        + " select id as doc_id, bucket, tf from counted",
        "idf_weights": _with(DOCUMENT_WORDS, BUCKETS, _weights("documents"))
        + " select bucket, doc_freq, round(idf, 6) as idf from weights",
        "tf_idf": _with(DOCUMENT_WORDS, BUCKETS, _weights("documents"))
        + """
        select id as doc_id, bucket, round(tf * idf, 6) as tf_idf
        from counted join weights using (bucket) where tf * idf <> 0""",
        "w2v_vocab": _with(DOCUMENT_WORDS)
        + """
        select word, count(*) as occurrences from content_words
        group by word having count(*) >= 5""",
        "w2v_doc_vectors": _with(DOCUMENT_WORDS)
        + """
        , known as (select word from content_words group by word having count(*) >= 5),
        counted as (
          select id, count(*) as n_words, count(k.word) as n_known
          from content_words w left join known k on k.word = w.word group by id)
        select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_known, 0) as n_known,
               true as is_mean
        from documents left join counted on id = doc_id""",
        "minmax_scale": """
        with cells as (
          select vec_id, generate_subscripts(embedding, 1) - 1 as dim,
                 unnest(embedding)::double as v from embeddings),
        bounds as (select dim, min(v) as lo, max(v) as hi from cells group by dim)
        select vec_id, dim,
               round(case when hi = lo then 0.5 else (v - lo) / (hi - lo) end, 6) as value
        from cells join bounds using (dim)""",
        "feature_shape": _with(REVIEWS, RANKED)
        + f""", cleaned as (
          select sentiment, label, count(*) as row_count,
                 sum(length({_clean("review")}))::bigint as cleaned_chars
          from reviews join ranked using (sentiment) group by sentiment, label)
        select s.feature_set, sentiment, label, row_count,
               250::bigint as min_dims, 250::bigint as max_dims, cleaned_chars
        from cleaned, (values ('HTFfeaturizedData'), ('TFIDFfeaturizedData'),
                              ('W2VfeaturizedData')) s(feature_set)""",
        "featurize_all": _with(REVIEWS, REVIEW_WORDS, BUCKETS, _weights("reviews"))
        + """
        select 'HTFfeaturizedData' as feature_set, (select count(*) from reviews) as row_count,
               (select count(*) from counted) as nonzeros
        union all select 'TFIDFfeaturizedData', (select count(*) from reviews),
               (select count(*) from counted join weights using (bucket) where idf <> 0)
        union all select 'W2VfeaturizedData', (select count(*) from reviews), null""",
        "hash_split": """
        select doc_id,
               (('0x' || substr(md5('11:' || doc_id), 1, 8))::bigint % 100) < 70 as is_train
        from documents""",
        "random_split": """
        select count(*) as row_count, count(distinct doc_id) as documents, 2::bigint as sides
        from labels""",
        "lr_fit": "select i - 1 as dim, true as is_optimum from range(251) r(i)",
        "cv_grid": """
        select max_iter::bigint as max_iter, true as plausible
        from (values (10), (15), (20)) v(max_iter)""",
        "lr_predict": _with(REVIEWS, RANKED)
        + """
        select review_id, label, true as is_class from reviews join ranked using (sentiment)""",
        "compare_features": """
        select 'LogisticRegression' as classifier_name, feature_name, true as plausible,
               case when feature_name <> 'W2VfeaturizedData' then true end as like_counts
        from (values ('HTFfeaturizedData'), ('TFIDFfeaturizedData'), ('W2VfeaturizedData'))
          v(feature_name)""",
        "file_scope": r"""
        with named as (select page_id, list_last(string_split(url, '/')) as name from pages)
        select page_id, (name = '665' or regexp_extract(name, '^.+(\.[^.]+)$', 1) = '.html')
               and name <> '474.html' as in_scope
        from named""",
        "accuracy_eval": """
        select round(avg((quality = 1 - toxic)::int) * 100, 6) as accuracy from labels""",
        "language_scan": _with(FINDINGS)
        + " select doc_id, line_no, kind, content from findings",
        "language_scan_report": _with(FINDINGS)
        + """
        select doc_id, line_no, kind,
               case when length(content) > 120 then substr(content, 1, 117) || '...'
                    else content end as shown
        from findings""",
        "language_scan_german": _with(GERMAN)
        + " select doc_id, line_no, kind, content from german",
        "language_scan_summary": _with(FINDINGS, GERMAN)
        + """
        select kind, count(*) as findings
        from (from findings union all from german) group by kind""",
    }
