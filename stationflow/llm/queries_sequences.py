"""Queries of the operators on the sequence of words or characters of a text."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationflow.llm.byte_bpe import decode, encode
from stationflow.llm.common import let, words
from stationflow.llm.fill_middle import fill_in_middle, restored
from stationflow.llm.periodic_runs import collapse_runs
from stationflow.llm.registry import query, table

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def planted(doc_id: Column, text: Column) -> Column:
    """The text with the contract's planted repetition: of one id in ten, all words from a place on
    become copies of the first few there. A null id plants nothing."""
    chosen, deal = F.crc32(doc_id.cast("string").cast("binary")), F.lit(10).cast("long")
    g = F.floor(chosen / deal)

    def repeated(found: Column) -> Column:
        n = F.size(found).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8).cast("long"))))
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda i: F.get(found, (a + F.pmod(i, p)).cast("int")))
        return F.array_join(F.concat(F.slice(found, F.lit(1), a.cast("int")), tail), " ")

    wordy = text.rlike("[^\\x20\\x09-\\x0D]")
    return F.when((F.pmod(chosen, deal) == 0) & wordy, let(words(text), repeated)).otherwise(text)


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = collapse_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    runs = F.col("periodic.runs")
    # By cross products, so exact; runs come by start and period, and the first of equal ones stays.
    better = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    best = F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda a, r: F.when(better(a, r), r).otherwise(a))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("_best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("1000 * _best.length div _best.period").alias("exponent_milli")
    return rows.select("doc_id", "n_runs", "_best.start", "_best.length", "_best.period", milli, "runs_sha256", "collapsed_sha256")


@query("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ids = encode(docs, BYTE_TOKENIZER).drop("text")
    back = decode(ids, BYTE_TOKENIZER)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


_DRAWS = ", ".join(f"('0x' || substr(h, {1 + 8 * i}, 8))::bigint as h{i + 1}" for i in range(4))


@query(
    "op13_fill_middle",
    rf"""
with base as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t,
    sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
cut as (
  select r, doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as units, {_DRAWS} from base),
placed as (
  select *, len(units) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as a,
    greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as b from cut),
parts as (
  select *, array_to_string(units[1:a], '') as p, array_to_string(units[a + 1:b], '') as m, array_to_string(units[b + 1:], '') as s,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from placed)
select doc_id, cast(n as bigint) as n, form,
  cast(case when form <> 'plain' then length(p) end as bigint) as prefix_chars,
  cast(case when form <> 'plain' then length(m) end as bigint) as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts
""",
)
def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    made = fill_in_middle(docs, F.col("doc_id")).drop("text")
    fim = [F.col(f"fim.{c}") for c in ("n", "form", "prefix_chars", "middle_chars")]
    back = restored(F.col("fim.output"), F.col("fim.form"))
    return made.select("doc_id", *fim, F.sha2("fim.output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
