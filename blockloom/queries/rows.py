"""Projections, casts, row access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.functions.text import url_decode
from blockloom.operators import rows as R
from blockloom.queries.registry import query, table


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    return R.with_row_index(table(spark, d, "documents"), order=["doc_id"], by=["source"])


@query("project_required", "SELECT doc_id, text FROM documents")
def project_required(spark: SparkSession, d: str) -> DataFrame:
    return R.project_required(table(spark, d, "documents"), ["doc_id", "text"])


@query("drop_columns", "SELECT doc_id, source, n_chars FROM documents")
def drop_columns(spark: SparkSession, d: str) -> DataFrame:
    return R.drop_columns(table(spark, d, "documents"), "text", "lang", "attention_mask")


@query(
    "align_schema",
    """SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(quality AS INTEGER) AS quality FROM labels
       UNION ALL SELECT vec_id AS doc_id, CAST(label AS INTEGER) AS quality FROM embeddings""",
)
def align_schema(spark: SparkSession, d: str) -> DataFrame:
    """Wide integers narrowed to what the first source has."""
    first = table(spark, d, "labels").select("doc_id", "quality")
    second = table(spark, d, "embeddings").select(
        F.col("label").cast("bigint").alias("quality"), F.col("vec_id").alias("doc_id")
    )
    return first.unionByName(R.align_schema(second, first))


_NUMBERED = """WITH r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS row_idx FROM documents)
"""


@query("row_index", f"{_NUMBERED} SELECT source, doc_id, row_idx FROM r")
def row_index(spark: SparkSession, d: str) -> DataFrame:
    return _numbered(spark, d).select("source", "doc_id", "row_idx")


@query("limit_rows", f"{_NUMBERED} SELECT source, doc_id, row_idx FROM r WHERE row_idx < 10")
def limit_rows(spark: SparkSession, d: str) -> DataFrame:
    return R.limit_rows(_numbered(spark, d), 10).select("source", "doc_id", "row_idx")


@query("row_at", f"{_NUMBERED} SELECT source, doc_id, text FROM r WHERE row_idx = 7")
def row_at(spark: SparkSession, d: str) -> DataFrame:
    return R.row_at(_numbered(spark, d), 7).select("source", "doc_id", "text")


@query("preview", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10")
def preview(spark: SparkSession, d: str) -> DataFrame:
    return R.preview(table(spark, d, "documents"), 10, order=["doc_id"]).select("doc_id", "text")


@query("url_decode_text", "SELECT page_id, url || '+a+b %' AS decoded FROM pages")
def url_decode_text(spark: SparkSession, d: str) -> DataFrame:
    sent = F.concat(F.replace(F.url_encode("url"), F.lit("+"), F.lit("%20")), F.lit("+a%2Bb %"))
    return table(spark, d, "pages").select("page_id", url_decode(sent).alias("decoded"))
