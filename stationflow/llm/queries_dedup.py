"""The query of near-duplicate documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm.near_dedup import near_duplicates
from stationflow.llm.registry import query, table


@query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return near_duplicates(docs, F.col("doc_id"), F.col("text")).select("doc_id", "class_id")
