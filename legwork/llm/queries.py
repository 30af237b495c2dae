"""One query per operator over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.llm import bpe, divergence, jaccard, language, line_dedup, packing, phrases, quality, secret_scan, token_counts, topk, urls, warc
from legwork.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: SQL twins of the operators that SQL can express.
ORACLE: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op3_bpe(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    coded = bpe.decode_documents(bpe.encode_documents(docs, WORD_BPE), WORD_BPE)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_best_fit_packing(spark, sf):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packing.pack_documents(_table(spark, sf, "documents"), BYTE_BPE, capacity=1024, end_id=2).select(columns)


@query
def op9_token_counts(spark, sf):
    return token_counts.suffix_sums(token_counts.length_histogram(_table(spark, sf, "documents"), BYTE_BPE))


@query
def op1_language_id(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    filters = language.train(docs.where(~language.held_out()))
    found = language.predict(docs.select("doc_id", "text", language.held_out().alias("held_out")), filters)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op4_quality_rules(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf, "labels"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judge(docs, model).select(*columns, "probability")


@query
def op2_secret_scan(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    field = secret_scan.train(docs)
    found = secret_scan.scan(docs, field).drop("text")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "tagged")
    return found.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


@query
def op6_exact_top_k(spark, sf):
    rows = _table(spark, sf, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


ORACLE["op6_exact_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as vec
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.vec, c.vec) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.vec) = len(c.vec)
  where q.vec_id % 100 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 10
"""


@query
def op8_warc(spark, sf):
    folder = f"{work_dir(spark)}/archive"
    warc.write_archive(_table(spark, sf, "pages"), folder)
    return warc.page_records(warc.read_records(spark, folder))


ORACLE["op8_warc"] = """
with p as (
  select page_id, coalesce(html, '') as body from pages
), d as (
  select page_id, cast(octet_length(encode(body)) as bigint) as payload_bytes, sha1(body) as payload_digest,
    max(page_id) over (partition by body) as owner
  from p
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> owner then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> owner then owner end as refers_to
from d
"""

#: Production rules: host and path to verdict.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query
def op10_url_filter(spark, sf):
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "accept_probability")


@query
def op5_jaccard_join(spark, sf):
    return jaccard.near_duplicates(_table(spark, sf, "documents"))


@query
def op13_line_dedup(spark, sf):
    kept = line_dedup.kept_lines(_table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op13_line_dedup"] = """
with l as (
  select doc_id, u.line, u.place
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents) d,
    unnest(d.parts) with ordinality as u(line, place)
), k as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l
), h as (
  select *, length(key) >= 10 and min(doc_id) over (partition by key) <> doc_id as gone from k
)
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from h group by doc_id
"""


@query
def op12_phrases(spark, sf):
    return phrases.collocations(_table(spark, sf, "documents"))


ORACLE["op12_phrases"] = """
with d as (
  select row_number() over () as id, coalesce(lang, 'und') as lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]') as pieces
  from documents
), p as (
  select id, lang, place, regexp_extract_all(piece, '[^\\x20\\x09]+') as words
  from d, unnest(d.pieces) with ordinality as u(piece, place)
), w as (
  select id, place, lang, word, b from p, unnest(p.words) with ordinality as u(word, b)
), g as (
  select lang, word as w1, lead(word) over x as w2, lead(word, 2) over x as w3, lead(word, 3) over x as w4
  from w window x as (partition by id, place order by b)
), total as (
  select lang, cast(count(*) as bigint) as n from g group by lang
), f as (
  select lang, phrase, size, count(*) as a
  from (
    select lang, w1 as phrase, 1 as size from g
    union all select lang, w1 || ' ' || w2, 2 from g where w2 is not null
    union all select lang, w1 || ' ' || w2 || ' ' || w3, 3 from g where w3 is not null
    union all select lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 from g where w4 is not null
  ) group by all having count(*) >= 30
), cand as (
  select *, string_split(phrase, ' ') as words from f where size > 1
), cut as (
  select c.lang, c.phrase, c.size, c.a, c.words, k, l.a as l, r.a as r,
    cast((2000000::hugeint * c.a) // (l.a + r.a) as bigint) as score
  from cand c, (values (1), (2), (3)) s(k)
  join f l on l.lang = c.lang and l.phrase = array_to_string(c.words[1:k], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(c.words[k + 1:], ' ')
  where k < c.size
), scored as (
  select * from cut qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_ as (
  select c.lang, array_to_string(c.words[b:b + n - 1], ' ') as phrase, max(a) as longer
  from cand c, (values (1), (2), (3)) s(b), (values (2), (3)) t(n)
  where n < c.size and b + n - 1 <= c.size group by all
), kept as (
  select s.* from scored s left join inner_ i using (lang, phrase)
  where longer is null or 100::hugeint * longer < 80::hugeint * a
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select lang, cast(rank as integer) as rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000
"""


@query
def op11_divergence(spark, sf):
    return divergence.divergence(_table(spark, sf, "documents"))


ORACLE["op11_divergence"] = """
with d as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), w as (
  select id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d
), kept as (
  select lang, term from w group by all having count(distinct id) >= 30
), size as (
  select lang, count(*) as v from kept group by all
), groups as (
  select distinct lang, source from d
), n as (
  select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all
), totals as (
  select lang, source, coalesce(sum(n), 0) as total from groups left join n using (lang, source) group by all
), langs as (
  select lang, sum(total) as total from totals group by all
), p as (
  select g.lang, g.source, k.term, coalesce(n.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(n.n, 0) + 5)) // (t.total + 5 * s.v) as p
  from groups g join kept k using (lang) join size s using (lang) join totals t using (lang, source)
  left join n using (lang, source, term)
), q as (
  select lang, term, 1 + (1000000000::hugeint * (n + 5)) // (t.total + 5 * s.v) as q
  from (select lang, term, sum(n) as n from n group by all) join size s using (lang) join langs t using (lang)
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item,
    coalesce((select sum(abs(x.p - y.p)) from p x join p y using (lang, term)
      where x.lang = a.lang and x.source = a.source and y.source = b.source), 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  union all
  select lang, source, 'term', term, p - q from p join q using (lang, term) where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 50
"""
