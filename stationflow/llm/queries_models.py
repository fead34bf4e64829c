"""Queries of the fitted models: quality classifier and language identification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationflow.llm import language_id, quality_model
from stationflow.llm.registry import query, table


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The votes' posterior of each document and the scorer's verdict; no given label is used."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model, scorer = quality_model.fit_on(docs, F.col("doc_id"), F.col("text"))
    scored = quality_model.score_quality(docs, "text", scorer)
    return scored.select("doc_id", "quality_score", (F.col("quality_score") >= 0.5).alias("kept"))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


@query("op8_language_id")
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    learn = docs.where(~held_out())
    model = language_id.fit_on(learn, F.col("doc_id"), F.col("text"), F.col("lang"))
    found = language_id.identify(docs.select("doc_id", "text"), "text", model)
    held = F.coalesce(held_out(), F.lit(False)).alias("held_out")
    return found.select("doc_id", held, "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))
