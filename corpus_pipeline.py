"""A corpus from documents to packed sequences, by the operators of stationflow.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents, with ``n_chars``
brought up to date where the text has changed. Every stage works on all rows it is given:

1. ``language_id``: documents whose language is not recognised (no text, no letter, or a score below
   the calibrated one) go.
2. ``line_dedup``: of lines that three or more documents share, all but those of the largest doc_id go.
3. ``near_dedup``: of each class of near-duplicates the smallest doc_id stays. Rows that repeat an id
   and a text are one document; a document without an id goes by its text.
4. ``mixing``: sources are mixed to their weights, 150% of all words in total. A row is a document,
   or what the mix takes of its words, once for each round through its source.
5. ``packing``: pieces of at most 2048 tokens in sequences, as op1 returns them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm import language_id as languages
from stationflow.llm.common import let, word_count
from stationflow.llm.line_dedup import LineIndex
from stationflow.llm.mixing import mix_sources
from stationflow.llm.near_dedup import near_duplicates
from stationflow.llm.packing import pack, token_pieces
from stationflow.llm.queries_text import TOKENIZER
from stationflow.session import durable


def _packed(docs: DataFrame) -> DataFrame:
    """The id, the text and all else in one column, so that no name of docs clashes with another."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *others).alias("row"))


def _documents(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the length of the text as it is now."""
    columns = {c: F.col("row")[c].alias(c) for c in docs.columns} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return packed.select(*[columns[c] for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = docs.where("text is not null and lang is not null")
    model = languages.fit_on(labelled, F.col("doc_id"), F.col("text"), F.col("lang"))
    found = languages.identify(_packed(docs), "text", model).where("not lang_rejected")
    return _documents(found, docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = _packed(docs)
    index = LineIndex.build(packed, F.col("doc_id"), F.col("text"), min_docs=3, least=20)
    return _documents(index.clean(packed, references=index.references), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Ids are kept apart from the hashes that stand for missing ones.
    given = F.struct(F.lit(0).alias("missing"), F.col("doc_id").cast("long").alias("id"))
    made = F.struct(F.lit(1).alias("missing"), F.xxhash64("text").alias("id"))
    keyed = _packed(docs).withColumn("key", F.when(F.col("doc_id").isNotNull(), given).otherwise(made))
    found = near_duplicates(keyed, F.col("key"), F.col("text"))
    first = found.where("doc_id = class_id").select(F.col("doc_id").alias("key")).dropDuplicates()
    return _documents(keyed.join(first, "key", "left_semi").dropDuplicates(["key", "text"]), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mix = mix_sources(docs, F.col("doc_id"), F.col("source"), word_count(F.col("text")), carry={"text_hash": F.xxhash64("text")})
    spans = mix.spans.groupBy("_src", "_start", "epoch")
    spans = spans.agg(F.sum("length").alias("taken"), F.sort_array(F.collect_list(F.struct("first", "length"))).alias("spans"))
    # Written before the texts are read, as what a query gathers at once is the driver's load.
    spans = durable(spans, "mixed-spans")
    rows = mix.placed.where("size > 0").select("_src", "_start", F.struct("doc_id", "source", "text_hash").alias("key"), "size")
    # Rows that repeat an id, a source and a text have a place in the stream each; their texts are
    # equal, so each is found once.
    texts = _packed(docs).withColumn("key", F.struct("doc_id", F.col("row.source").alias("source"), F.xxhash64("text").alias("text_hash")))
    out = spans.join(rows, ["_src", "_start"]).withColumnRenamed("key", "of")
    out = texts.dropDuplicates(["key"]).join(out, F.col("key").eqNullSafe(F.col("of")))
    whole, parts = F.col("taken") == F.col("size"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    cut = lambda words: F.flatten(F.transform("spans", lambda s: F.slice(words, s["first"].cast("int") + 1, s["length"].cast("int"))))
    out = out.withColumn("text", F.when(whole, F.col("text")).otherwise(F.array_join(let(parts, cut), "")))
    return _documents(out, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = pack(token_pieces(docs, F.col("doc_id"), F.col("text"), TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can neither train the language model nor tokenize; the tests hold the pipeline against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
