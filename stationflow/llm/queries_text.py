"""Queries of packing and line dedup."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm.line_dedup import LineIndex
from stationflow.llm.packing import pack, token_pieces
from stationflow.llm.registry import query, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    packed = pack(token_pieces(docs, F.col("doc_id"), F.col("text"), TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query(
    "op2_line_dedup",
    r"""
with lines as (
  select doc_id, i, l, translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as l,
          unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i from documents)),
shared as (
  select k, max(doc_id) as last_doc from lines where length(k) >= 20
  group by k having count(distinct doc_id) >= 3),
judged as (
  select doc_id, i, l, last_doc is not null and last_doc <> doc_id as gone
  from lines left join shared using (k))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(l, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
""",
)
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    index = LineIndex.build(docs, F.col("doc_id"), F.col("text"), min_docs=3, least=20)
    cleaned = index.clean(docs, references=index.references)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
