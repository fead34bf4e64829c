"""Chunk tables, context assembly, conversations; vector search is in ``vectors``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.functions.scalar import text_or
from stationflow.functions.text import fixed_chunks
from stationflow.operators.rollups import distinct_text, ordered_text
from stationflow.operators.vectors import unsearchable, vector_topk  # noqa: F401

# What stands in for the context of a question that matches nothing, unless the caller has its own.
NO_CONTEXT = "No stored passage matches this question."


def concat_pages(pages: DataFrame, doc: str = "doc_id", page: str = "page_no", text: str = "text") -> DataFrame:
    """Page texts of a document joined without a separator; a NULL page adds nothing.

    The result is one value per document, so a group is as large as its own output cell.
    """
    return pages.groupBy(doc).agg(ordered_text(F.col(page), F.col(text), "").alias("text"))


def chunk_table(docs: DataFrame, chunks: Column, keep: Sequence[str]) -> DataFrame:
    """One row per chunk with its position."""
    return docs.select(*keep, F.posexplode(chunks).alias("chunk_no", "chunk_text"))


def chunk_records(docs: DataFrame, doc: str, file_name: str, category: str, text: str = "text") -> DataFrame:
    """Chunks with an id and metadata; the id is derived, so ingesting again changes nothing."""
    rows = chunk_table(docs, fixed_chunks(F.col(text)), [doc, file_name])
    parts = F.concat_ws("\u0001", F.col(doc).cast("string"), F.col("chunk_no").cast("string"), F.col("chunk_text"))
    return rows.select(
        F.concat(F.lit("chunk-"), F.sha2(parts, 256)).alias("id"),
        F.col(doc),
        F.col("chunk_no"),
        F.struct(
            F.col("chunk_text"), F.lit(category).alias("category"), F.col(file_name).alias("file_name")
        ).alias("metadata"),
    )


def assemble_context(queries: DataFrame, matches: DataFrame, fallback: str = NO_CONTEXT) -> DataFrame:
    """Per query the prompt context, source lines and file note of its matches.

    ``matches`` has ``query_id, rank, chunk_text, file_name, topic`` with at most k rows per
    query. A query without matches gets ``fallback`` and empty notes.
    """
    # The format of a passage and of a source line.
    file_name, topic = text_or(F.col("file_name"), "Unknown file"), text_or(F.col("topic"), "General")
    chunk = F.trim(F.coalesce("chunk_text", F.lit("")))
    named = matches.select(
        "query_id",
        "rank",
        file_name.alias("file_name"),
        F.concat(F.lit("["), file_name, F.lit(", topic: "), topic, F.lit("]\n"), chunk).alias("block"),
        F.concat(F.lit("- "), file_name, F.lit(" (topic: "), topic, F.lit(")")).alias("source"),
    )
    contexts = named.groupBy("query_id").agg(
        ordered_text(F.col("rank"), F.col("block")).alias("context"),
        distinct_text(F.col("source"), "\n").alias("sources"),
        distinct_text(F.col("file_name")).alias("files"),
    )
    return queries.join(contexts, "query_id", "left").select(
        *queries.columns,
        F.coalesce("context", F.lit(fallback)).alias("context"),
        F.coalesce("sources", F.lit("")).alias("sources"),
        F.coalesce("files", F.lit("")).alias("files"),
    )


def conversation_history(messages: DataFrame) -> DataFrame:
    """Turns without system messages, the rows of a conversation in order.

    Rows are dealt out by conversation and sorted within tasks: an order over all conversations,
    which would take a sampling pass, is of no use to a reader of one. Rows rather than arrays, so
    a long conversation is sorted on disk if need be.
    """
    return messages.where(F.col("role") != "system").repartition("conv_id").sortWithinPartitions("conv_id", "turn")


def conversation_list(messages: DataFrame) -> DataFrame:
    """Non-empty conversations with a short label, their size and the last user message."""
    is_user = F.col("role") == "user"
    return messages.groupBy("conv_id").agg(
        F.substring(F.first("conv_id").cast("string"), 1, 8).alias("label"),
        F.count_if(F.col("role") != "system").alias("messages"),
        F.max_by(F.when(is_user, F.col("text")), F.when(is_user, F.col("turn"))).alias("last_user_message"),
    )
