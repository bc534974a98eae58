"""Packing token rows into blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.operators import packing as P
from blockloom.queries.registry import (
    BATCH_ROWS,
    BLOCK,
    SQL_ENCODED_DOCS,
    SQL_ENCODED_LINES,
    WORKERS,
    digest,
    encoded_docs,
    encoded_lines,
    query,
    sql_digest,
)

SCOPE = ["source", "shard", "batch"]


def sql_pack(rows: str, scope: str, order: str, *, keep_tail: bool = False) -> str:
    """CTEs that cut the ``input_ids`` of ``rows`` into ``blocks``."""
    tail = f"""
  UNION ALL
  SELECT {scope}, CAST(ceil(kept / {BLOCK}.0) AS BIGINT) AS block,
    flat[greatest(n - {BLOCK}, 0) + 1 : n] AS input_ids
  FROM sized WHERE n % {BLOCK} <> 0""" if keep_tail else ""
    return f"""
flats AS (SELECT {scope}, flatten(list(input_ids ORDER BY {order})) AS flat FROM {rows} GROUP BY {scope}),
sized AS (
  SELECT *, len(flat) AS n, CASE WHEN len(flat) >= {BLOCK} THEN (len(flat) // {BLOCK}) * {BLOCK} ELSE len(flat) END AS kept
  FROM flats),
blocks AS (
  SELECT {scope}, i // {BLOCK} AS block, flat[i + 1 : least(i + {BLOCK}, kept)] AS input_ids
  FROM (SELECT *, unnest(range(0, kept, {BLOCK})) AS i FROM sized){tail})"""


SQL_SCOPED = f"""{SQL_ENCODED_LINES},
sharded AS (
  SELECT *, least({WORKERS}, n_rows) AS p, n_rows // least({WORKERS}, n_rows) AS sz, n_rows % least({WORKERS}, n_rows) AS m FROM enc),
placed AS (
  SELECT *, CASE WHEN row_idx < m * (sz + 1) THEN row_idx // (sz + 1) ELSE m + (row_idx - m * (sz + 1)) // sz END AS shard,
    CASE WHEN row_idx < m * (sz + 1) THEN row_idx % (sz + 1) ELSE (row_idx - m * (sz + 1)) % sz END AS in_shard
  FROM sharded),
scoped AS (SELECT *, in_shard // {BATCH_ROWS} AS batch FROM placed)"""

_SHOWN = f"block, CAST(len(input_ids) AS INTEGER) AS n_ids, {sql_digest('input_ids')} AS ids_md5"


def scoped_lines(spark: SparkSession, d: str) -> DataFrame:
    return P.with_scope(encoded_lines(spark, d), workers=WORKERS, batch_rows=BATCH_ROWS)


def scoped_blocks(spark: SparkSession, d: str, **options) -> DataFrame:
    return P.pack_blocks(scoped_lines(spark, d), block_size=BLOCK, scope=SCOPE, scope_rows=BATCH_ROWS, **options)


def _shown(df: DataFrame, *scope: str) -> DataFrame:
    return df.select(*scope, "block", F.size("input_ids").alias("n_ids"), digest(F.col("input_ids")).alias("ids_md5"))


@query("pack_blocks", f"WITH {SQL_ENCODED_DOCS},{sql_pack('enc', 'source', 'doc_id')} SELECT source, {_SHOWN} FROM blocks")
def pack_blocks(spark: SparkSession, d: str) -> DataFrame:
    """A whole source is one scope."""
    blocks = P.pack_blocks(encoded_docs(spark, d), block_size=BLOCK, scope=["source"], order=["doc_id"])
    return _shown(blocks, "source")


@query(
    "pack_scope",
    f"WITH {SQL_SCOPED},{sql_pack('scoped', 'source, shard, batch', 'row_idx')} SELECT source, shard, batch, {_SHOWN} FROM blocks",
)
def pack_scope(spark: SparkSession, d: str) -> DataFrame:
    return _shown(scoped_blocks(spark, d), *SCOPE)


@query(
    "scope_of_rows",
    f"WITH {SQL_SCOPED} SELECT source, row_idx, shard, batch FROM scoped",
)
def scope_of_rows(spark: SparkSession, d: str) -> DataFrame:
    return scoped_lines(spark, d).select("source", "row_idx", "shard", "batch")


@query(
    "copy_labels",
    f"""WITH {SQL_SCOPED},{sql_pack('scoped', 'source, shard, batch', 'row_idx')}
    SELECT source, shard, batch, block, {sql_digest('input_ids')} AS labels_md5 FROM blocks""",
)
def copy_labels(spark: SparkSession, d: str) -> DataFrame:
    labelled = P.copy_labels(scoped_blocks(spark, d))
    return labelled.select(*SCOPE, "block", digest(F.col("labels")).alias("labels_md5"))


@query(
    "pack_keep_tail",
    f"""WITH {SQL_SCOPED},{sql_pack('scoped', 'source, shard, batch', 'row_idx', keep_tail=True)}
    SELECT source, shard, batch, {_SHOWN} FROM blocks""",
)
def pack_keep_tail(spark: SparkSession, d: str) -> DataFrame:
    return _shown(scoped_blocks(spark, d, keep_tail=True), *SCOPE)


@query(
    "pack_token_loss",
    f"""WITH {SQL_SCOPED},{sql_pack('scoped', 'source, shard, batch', 'row_idx')},
    b AS (SELECT source, count(*) AS n_blocks, sum(len(input_ids)) AS kept FROM blocks GROUP BY source),
    a AS (SELECT source, sum(len(input_ids)) AS tokens_in FROM scoped GROUP BY source)
    SELECT source, CAST(tokens_in AS BIGINT) AS tokens_in, coalesce(n_blocks, 0) AS n_blocks,
      CAST(coalesce(kept, 0) AS BIGINT) AS tokens_kept, CAST(tokens_in - coalesce(kept, 0) AS BIGINT) AS tokens_lost
    FROM a LEFT JOIN b USING (source)""",
)
def pack_token_loss(spark: SparkSession, d: str) -> DataFrame:
    return P.pack_loss(encoded_lines(spark, d), scoped_blocks(spark, d))
