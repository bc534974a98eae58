"""Batch shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.operators import collate as C
from blockloom.operators.instruct import encode_pairs, mask_labels
from blockloom.operators.rows import with_row_index
from blockloom.queries.registry import SQL_PAIRS, digest, instructions, query, sql_digest, vocabulary

BATCH = 8
NAIVE = 64


def _examples(spark: SparkSession, d: str, max_len: int | None = None) -> DataFrame:
    rows = with_row_index(instructions(spark, d), order=["conv_id", "turn"]).drop("n_rows")
    pairs = encode_pairs(rows, vocabulary(spark, d), key=["row_idx"])
    return mask_labels(pairs, max_len=max_len)


_EXAMPLES = f"""{SQL_PAIRS},
ex AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_idx, list_concat(source_ids, target_ids) AS input_ids,
    list_concat(list_transform(source_ids, lambda x: -100), target_ids) AS labels FROM pairs),
batched AS (SELECT *, row_idx // {BATCH} AS batch_id FROM ex),
wide AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) AS n FROM batched),
padded AS (
  SELECT batch_id, row_idx, list_resize(input_ids, n, 3) AS input_ids, list_resize(labels, n, -100) AS labels FROM wide)"""


@query(
    "pad_batch",
    f"""WITH {_EXAMPLES} SELECT batch_id, row_idx, CAST(len(input_ids) AS INTEGER) AS n,
      {sql_digest('input_ids')} AS ids_md5, {sql_digest('labels')} AS labels_md5 FROM padded""",
)
def pad_batch(spark: SparkSession, d: str) -> DataFrame:
    padded = C.pad_batches(_examples(spark, d), batch_size=BATCH)
    return padded.select(
        "batch_id",
        "row_idx",
        F.size("input_ids").alias("n"),
        digest(F.col("input_ids")).alias("ids_md5"),
        digest(F.col("labels")).alias("labels_md5"),
    )


@query(
    "attention_mask",
    f"""WITH {_EXAMPLES} SELECT row_idx, CAST(len(list_filter(input_ids, lambda x: x <> 3)) AS INTEGER) AS n_seen,
      {sql_digest('list_transform(input_ids, lambda x: CAST(x <> 3 AS INTEGER))')} AS mask_md5 FROM padded""",
)
def attention_mask(spark: SparkSession, d: str) -> DataFrame:
    padded = C.pad_batches(_examples(spark, d), batch_size=BATCH)
    return padded.select(
        "row_idx",
        F.size(F.filter("attention_mask", lambda m: m)).alias("n_seen"),
        digest(F.col("attention_mask").cast("array<int>")).alias("mask_md5"),
    )


@query(
    "collate_first_on_ragged",
    f"""WITH {_EXAMPLES},
    cut AS (SELECT batch_id, row_idx, input_ids[1:{NAIVE}] AS ids FROM batched),
    b AS (SELECT *, min(len(ids)) OVER w AS lo, max(len(ids)) OVER w AS hi,
            first_value(ids) OVER (PARTITION BY batch_id ORDER BY row_idx) AS first_ids FROM cut WINDOW w AS (PARTITION BY batch_id))
    SELECT batch_id, row_idx, {sql_digest('CASE WHEN lo <> hi THEN first_ids ELSE ids END')} AS ids_md5 FROM b""",
)
def collate_first_on_ragged(spark: SparkSession, d: str) -> DataFrame:
    collated = C.collate_first_on_ragged(_examples(spark, d, NAIVE).drop("labels"), batch_size=BATCH)
    return collated.select("batch_id", "row_idx", digest(F.col("input_ids")).alias("ids_md5"))


@query("collate_label_field", "SELECT vec_id, CAST(label AS BIGINT) AS labels FROM embeddings")
def collate_label_field(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d.rstrip('/')}/embeddings.parquet").withColumn("note", F.lit("text"))
    return C.label_field(rows).drop("embedding")


@query(
    "labels_by_value",
    f"""WITH v AS (SELECT vec_id, CAST(floor(vec_id / {BATCH}) AS BIGINT) AS batch_id, vec_id % 3 <> 0 AS whole,
            CASE WHEN vec_id % 7 = 0 THEN NULL WHEN vec_id % 3 = 0 THEN label - 2.75 ELSE label - 2 END AS n FROM embeddings),
    k AS (SELECT batch_id, arg_min(whole, vec_id) AS whole FROM v WHERE n IS NOT NULL GROUP BY batch_id)
    SELECT vec_id, batch_id, CASE WHEN k.whole THEN CAST(trunc(n) AS DOUBLE) + 0 ELSE CAST(CAST(n AS FLOAT) AS DOUBLE) END AS labels,
      CASE WHEN k.whole THEN 'bigint' ELSE 'float' END AS labels_kind
    FROM v JOIN k USING (batch_id) WHERE n IS NOT NULL""",
)
def labels_by_value(spark: SparkSession, d: str) -> DataFrame:
    """Labels of both makes and missing ones in one column."""
    rows = spark.read.parquet(f"{d.rstrip('/')}/embeddings.parquet").select("vec_id", "label")
    text = F.when(F.col("vec_id") % 3 == 0, (F.col("label") - 2.75).cast("string")).otherwise((F.col("label") - 2).cast("string"))
    mixed = F.parse_json(F.when(F.col("vec_id") % 7 == 0, "null").otherwise(text))
    return C.labels_by_value(rows.select("vec_id", mixed.alias("label")), batch_size=BATCH, index="vec_id")


@query(
    "shift_right",
    f"""WITH {_EXAMPLES}
    SELECT row_idx, {sql_digest('list_transform(list_concat([1], labels[1:len(labels) - 1]), lambda x: CASE WHEN x = -100 THEN 3 ELSE x END)')} AS ids_md5 FROM ex""",
)
def shift_right(spark: SparkSession, d: str) -> DataFrame:
    shifted = C.shift_right(_examples(spark, d), start=1, pad=3)
    return shifted.select("row_idx", digest(F.col("decoder_input_ids")).alias("ids_md5"))


@query(
    "prepend_ignored",
    f"""WITH {_EXAMPLES} SELECT row_idx, {sql_digest('list_concat([-100, -100, -100, -100, -100], labels)')} AS labels_md5,
      CAST(len(input_ids) + 5 AS INTEGER) AS n_mask FROM padded""",
)
def prepend_ignored(spark: SparkSession, d: str) -> DataFrame:
    longer = C.prepend_ignored(C.pad_batches(_examples(spark, d), batch_size=BATCH), v=5)
    return longer.select(
        "row_idx", digest(F.col("labels")).alias("labels_md5"), F.size("attention_mask").alias("n_mask")
    )
