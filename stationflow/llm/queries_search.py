"""Queries of exact top-k search and HTML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm import html_extraction
from stationflow.llm.registry import query, table
from stationflow.llm.topk_search import top_k


@query(
    "op9_topk_search",
    """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id)
select query_id, cast(row_number() over w as integer) as rank, vec_id, score
from scored
window w as (partition by query_id order by score desc, vec_id)
qualify row_number() over w <= 5
""",
)
def op9_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, F.col("vec_id"), F.col("embedding"), F.col("vec_id") % 50 == 0, k=5)


@query("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    model = html_extraction.fit(html_extraction.labelled_pages())
    return html_extraction.extract(pages, "html", model).select("page_id", "url", "text", "n_chars")
