"""Queries of the operators that use DataFrame operations only: mixing, sharding, quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm.common import word_count
from stationflow.llm.mixing import mix_sources
from stationflow.llm.quality_rules import STOP_WORDS, quality_rules
from stationflow.llm.registry import query, table
from stationflow.llm.sharding import balanced_shards


@query("op3_mixing")
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    # The text's hash orders rows that share an id, so that reruns agree.
    mix = mix_sources(docs, F.col("doc_id"), F.col("source"), word_count(F.col("text")), carry={"_text": F.xxhash64("text")})
    return mix.documents.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_sharding")
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``bytes``; the key is a hash of the text, so equal texts are neighbours. A null text has
    no bytes: its size is 1 and its checksum that of no bytes, 0."""
    text = F.coalesce("text", F.lit(""))
    placed = balanced_shards(
        table(spark, folder, "documents"), F.col("doc_id"), F.octet_length(text) + 1, F.xxhash64(text),
        shards=8, carry={"text_crc32": F.crc32(text)},
    )
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
_WORDY = r"list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))"


@query(
    "op7_quality_rules",
    rf"""
with base as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, {_WORDY} as lines
  from documents),
windows as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(range(1, len(w) - 1)) as i from base where len(w) >= 3)),
twice as (select r, i from windows qualify count(*) over (partition by r, g) > 1),
covered as (select r, count(distinct i + k) as n from twice, (select unnest([0, 1, 2]) as k) group by r),
m as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
    cast(length(t) - length(replace(t, '!', '')) as bigint) as n_exclamations,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words,
    len(list_filter(w, lambda x: lower(x) in ({_STOPS}))) as n_stop_words, len(lines) as n_lines,
    len(list_filter(lines, lambda x: substr(ltrim(x, ' '), 1, 1) in ('-', '*', '•', '·'))) as n_bullet_lines,
    len(list_filter(lines, lambda x: rtrim(x, ' ') like '%...' or rtrim(x, ' ') like '%…')) as n_ellipsis_lines
  from base left join covered using (r)),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and word_chars / n_words between 2.5 and 12.0 and n_symbols / n_words <= 0.1
    and n_exclamations / n_words <= 0.2 and n_stop_words / n_words >= 0.02 and n_dup_lines / n_lines <= 0.3
    and n_bullet_lines / n_lines <= 0.9 and n_ellipsis_lines / n_lines <= 0.3 as kept
from judged
""",
)
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules(table(spark, folder, "documents").select("doc_id", "text"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[F.col("quality")[c].alias(c) for c in columns])
