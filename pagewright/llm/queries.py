"""The registered queries of the subpackage: each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import chat_format, exact_dedup, html_extract, language_id, lm_score, mixing, packing, simhash, substring_dedup, topk


#: The tokenizer of op7; its file is read where it lies.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_table(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.document_languages(_table(spark, sf_dir, "documents"))


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator with all its evidence: markup, address suffix, host and domain."""
    return language_id.page_languages(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(_table(spark, sf_dir, "documents"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat_format.chat_digests(turns.unionByName(extra))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mixing": op2_mixing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "page_language_id": page_language_id,
    "op5_html_extract": op5_html_extract,
    "op6_lm_score": op6_lm_score,
    "op7_packing": op7_packing,
    "op8_topk": op8_topk,
    "op9_simhash": op9_simhash,
    "op10_chat_format": op10_chat_format,
}

ORACLE_SQL: dict[str, str] = {
    "op2_mixing": """
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
         md5('0:' || coalesce(doc_id::varchar, 'null')) as k
  from documents
), per as (
  select source, sum(size)::bigint as source_size,
         [1.0::double, 2.0::double, 3.0::double][((row_number() over (order by source asc nulls last) - 1) % 3 + 1)::int] as w
  from d group by source
), lv as (
  select *, (3 * source_size)::double as ceiling,
         (sum(source_size::double) over () - coalesce(sum((3 * source_size)::double) over (order by (3 * source_size)::double / w, source asc nulls last rows between unbounded preceding and 1 preceding), 0))
         / sum(w) over (order by (3 * source_size)::double / w, source asc nulls last rows between current row and unbounded following) as own_level
  from per
), lm as (select *, max(own_level) over () as lvl from lv),
t as (
  select source, source_size, case when ceiling / w <= lvl then ceiling else lvl * w end as target from lm
), b as (
  select *, least(floor(target + 0.5)::bigint, 3 * source_size) as budget from t
), r as (
  select d.doc_id, d.size, b.source_size, b.target, d.source, b.budget,
         coalesce(sum(d.size) over (partition by d.source order by d.k, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as run
  from d join b on d.source is not distinct from b.source
)
select doc_id, size, source_size, target,
       ((case when source_size > 0 then budget // source_size else 0 end) * size
        + greatest(0, least(case when source_size > 0 then budget % source_size else 0 end - run, size)))::bigint as taken, source
from r
""",
    "op3_exact_dedup": """
with d as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents
)
select doc_id, max(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size,
       row_number() over (partition by text_sha256 order by doc_id desc nulls last) = 1 as kept, text_sha256
from d
""",
    "op8_topk": """
with v as (
  select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.r, q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.r <> c.r and len(q.v) = len(c.v) where q.vec_id % 50 = 0
)
select query_id, rank, vec_id, score
from (select *, (row_number() over (partition by r order by score desc, vec_id))::int as rank from s) where rank <= 5
""",
    "op10_chat_format": """
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), f as (
  select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) is not distinct from role as joined from c
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
       sum(case when joined then 8 else 8 + 8 + 7 + length(replace(replace(role, '&', '&amp;'), '<', '&lt;')) end
           + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')))::bigint as formatted_chars
from f group by conv_id
""",
}
