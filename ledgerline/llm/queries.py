"""The registered queries of this subpackage, and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, lsm_dedup, nn_descent, pseudo_likelihood, quality, secrets, simhash, suffix_array, warc, winnowing
from .support import load


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(load(spark, sf_dir, "pages"))


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.deduplicate(load(spark, sf_dir, "documents"), digest=True)


def op5_lsm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lsm_dedup.deduplicate(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.pseudo_likelihood(load(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(load(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.spans(load(spark, sf_dir, "documents"), increments=2)
    # the rules are those of the contract, so all spans are base spans
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(load(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_warc": op3_warc,
    "op4_suffix_array": op4_suffix_array,
    "op5_lsm_dedup": op5_lsm_dedup,
    "op6_pseudo_likelihood": op6_pseudo_likelihood,
    "op7_bpe": op7_bpe,
    "op8_secrets": op8_secrets,
    "op9_winnowing": op9_winnowing,
    "op10_nn_descent": op10_nn_descent,
}
# In DuckDB; texts are whole. Hashes that DuckDB lacks, fitted models, suffix sorting and the tokenizer have no SQL.

_SPACED = r"[^\x20\x09-\x0D]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3 = """with p as (select page_id, encode(coalesce(html, '')) as body from pages),
b as (select *, list_aggregate(list_transform(string_split(sha1(body), ''), lambda h: lpad(bin(('0x' || h)::int), 4, '0')), 'string_agg', '') as bits, max(page_id) over (partition by body) as top from p)
select page_id, octet_length(body) as payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda k: cast(substr(bits, i * 5 + k + 1, 1) as int) * (16 >> k)))::int, 1)), 'string_agg', '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type, case when page_id <> top then top end as refers_to from b"""

_OP5 = f"""with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') as w from documents),
s as (select doc_id, i, array_to_string(w[i : i + 12], ' ') as run from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d) x),
f as (select doc_id, i, min(doc_id) over (partition by run) as first_doc from s),
g as (select distinct doc_id, i + k as j from (select doc_id, i, unnest(range(0, 13)) as k from f where first_doc < doc_id) y),
u as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as j from d),
k as (select u.doc_id, count(g.j) as n_removed, string_agg(case when g.j is null then u.word end, ' ' order by u.j) as kept from u left join g on g.doc_id = u.doc_id and g.j = u.j group by u.doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k on k.doc_id = d.doc_id"""

_ASSIGN = secrets.RULES[0].pattern.replace("'", "''")


def _spans_sql(kind: str, rank: int, pattern: str, value: str, least: int) -> str:
    return f"""select doc_id, '{kind}' as kind, {rank} as rank, list_sum(gaps[:i]) + coalesce(list_sum(lens[:i - 1]), 0) as a, lens[i] as n from
  (select doc_id, unnest(range(1, len(lens) + 1)) as i, gaps, lens, vals from (select doc_id, list_transform(regexp_split_to_array(t, '{pattern}'), lambda x: length(x)) as gaps,
    list_transform(regexp_extract_all(t, '{pattern}'), lambda x: length(x)) as lens, list_transform({value}, lambda x: length(x)) as vals from (select doc_id, coalesce(text, '') as t from documents) x where regexp_matches(t, '{pattern}')) y) z where vals[i] >= {least}"""


_OP8 = f"""with s as ({_spans_sql("assign", 1, _ASSIGN, f"regexp_extract_all(t, '{_ASSIGN}', 2)", 6)} union all {_spans_sql("access", 2, "AKIA[A-Z0-9]+", "regexp_extract_all(t, 'AKIA[A-Z0-9]+')", 20)} union all {_spans_sql("hex", 3, "[0-9a-f]+", "regexp_extract_all(t, '[0-9a-f]+')", 24)}),
g as (select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex, string_agg(kind || ':' || a::bigint || ':' || (a + n)::bigint, ',' order by a, rank) as spans from s group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans from documents d left join g on g.doc_id = d.doc_id"""

_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
_OP9 = f"""with d as (select doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') as w from documents),
b as (select item_id, regexp_extract_all({_LOWERED}, '{_WORD}') as w from benchmark where item_id is not null),
win as (select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as run from (select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0) x),
sizes as (select distinct n from win),
s as (select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as run from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n) x),
hit as (select s.doc_id, s.i, s.n, win.item_id from s join win on win.n = s.n and win.run = s.run),
words as (select doc_id, count(distinct i + k) as n_hit from (select doc_id, i, unnest(range(0, n)) as k from hit) x group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_id, item_id::varchar as item from hit) x group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words on words.doc_id = d.doc_id left join items on items.doc_id = d.doc_id"""

_OP10 = """with recursive e as (select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings where embedding is not null and label is not null),
u as (select *, sqrt(list_sum(list_transform(v, lambda x: x * x))) as r from e), ok as (select * from u where r > 0 and isfinite(r)),
links as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v) where list_dot_product(a.v, b.v) / (a.r * b.r) >= 0.93),
reach(a, b) as (select vec_id, vec_id from embeddings union select reach.a, links.b from reach join links on links.a = reach.b)
select m.vec_id, coalesce(n, 0) as n_links, c as component_id, m.vec_id = c as kept from embeddings m join (select a, min(b) as c from reach group by a) x on x.a = m.vec_id left join (select a, count(*) as n from links group by a) y on y.a = m.vec_id"""

ORACLE_SQL: dict[str, str] = {"op3_warc": _OP3, "op5_lsm_dedup": _OP5, "op8_secrets": _OP8, "op9_winnowing": _OP9, "op10_nn_descent": _OP10}
