"""Sampling, weighting, mixing, splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.operators import sampling as M
from blockloom.queries.registry import query, table
from blockloom.session import scratch_path
from blockloom.sources import load_corpus, write_corpus

# The weights of the mixed sources; the others count once.
WEIGHTS = {"src0": 0.05, "src1": 0.5, "src2": 3.0, "src3": 2.0, "src4": 0.999}


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


_HASH = "md5('1234:' || doc_id)"


@query("shuffle_rows", f"SELECT doc_id, row_number() OVER (ORDER BY {_HASH}, doc_id) - 1 AS row_idx FROM documents")
def shuffle_rows(spark: SparkSession, d: str) -> DataFrame:
    return M.shuffle(_docs(spark, d), key=["doc_id"]).select("doc_id", "row_idx")


@query(
    "downsample",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_HASH}, doc_id) AS rn,
                   count(*) OVER (PARTITION BY source) AS n FROM documents)
    SELECT source, doc_id, text FROM r WHERE rn <= ceil(n * 0.3::DOUBLE)""",
)
def downsample(spark: SparkSession, d: str) -> DataFrame:
    return M.exact_sample(_docs(spark, d), key=["doc_id"], frac=0.3, by=["source"]).select("source", "doc_id", "text")


@query(
    "upsample",
    "SELECT doc_id, CAST(c AS INTEGER) AS copy_no FROM documents, (SELECT unnest(range(1, 4)) AS c)",
)
def upsample(spark: SparkSession, d: str) -> DataFrame:
    return M.upsample(_docs(spark, d), 3).select("doc_id", "copy_no")


@query(
    "concat_sources",
    """SELECT 'documents' AS source, doc_id AS id, text FROM documents
       UNION ALL SELECT 'benchmark' AS source, item_id AS id, text FROM benchmark
       UNION ALL SELECT 'conversations' AS source, conv_id AS id, text FROM conversations""",
)
def concat_sources(spark: SparkSession, d: str) -> DataFrame:
    ids = {"documents": "doc_id", "benchmark": "item_id", "conversations": "conv_id"}
    parts = {n: table(spark, d, n).select(F.col(c).alias("id"), "text") for n, c in ids.items()}
    return M.concat_sources(parts).select("source", "id", "text")


_SQL_MIX = f"""weights AS (SELECT * FROM (VALUES {', '.join(f"('{s}', {w}::DOUBLE)" for s, w in WEIGHTS.items())}) w(source, weight)),
weighted AS (SELECT d.*, coalesce(weight, 1) AS weight FROM documents d LEFT JOIN weights USING (source)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_HASH}, doc_id) AS rn,
             count(*) OVER (PARTITION BY source) AS n FROM weighted),
mixed AS (
  SELECT source, doc_id, text, CAST(unnest(range(1, CAST(greatest(1, floor(weight)) AS BIGINT) + 1)) AS INTEGER) AS copy_no
  FROM ranked WHERE weight >= 1 OR rn <= ceil(n * weight))"""


def mixed_docs(spark: SparkSession, d: str) -> DataFrame:
    return M.mix(_docs(spark, d), WEIGHTS, key=["doc_id"], default=1)


@query("mix_sources", f"WITH {_SQL_MIX} SELECT source, doc_id, copy_no, md5(text) AS text_md5 FROM mixed")
def mix_sources(spark: SparkSession, d: str) -> DataFrame:
    return mixed_docs(spark, d).select("source", "doc_id", "copy_no", F.md5("text").alias("text_md5"))


def _sql_split(k: str) -> str:
    return f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY {_HASH}, doc_id) AS rn, count(*) OVER () AS n FROM documents)
    SELECT doc_id, CASE WHEN rn <= {k} THEN 'test' ELSE 'train' END AS split FROM r"""


@query("split_fraction", _sql_split("ceil(n * 0.05::DOUBLE)"))
def split_fraction(spark: SparkSession, d: str) -> DataFrame:
    return M.split(_docs(spark, d), test=0.05, key=["doc_id"]).select("doc_id", "split")


@query("split_count", _sql_split("100"))
def split_count(spark: SparkSession, d: str) -> DataFrame:
    return M.split(_docs(spark, d), test=100, key=["doc_id"]).select("doc_id", "split")


@query("split_none", "SELECT doc_id, 'train' AS split FROM documents")
def split_none(spark: SparkSession, d: str) -> DataFrame:
    return M.split(_docs(spark, d), test=None, key=["doc_id"]).select("doc_id", "split")


@query(
    "split_and_shuffle",
    f"""WITH {_SQL_MIX},
    r AS (SELECT *, row_number() OVER (ORDER BY md5('1234:' || source || ':' || doc_id || ':' || copy_no)) - 1 AS rn,
            CAST(ceil(count(*) OVER () * 0.05::DOUBLE) AS BIGINT) AS k FROM mixed)
    SELECT source, doc_id, CAST(copy_no AS INTEGER) AS copy_no, CASE WHEN rn < k THEN 'test' ELSE 'train' END AS split,
      CAST(rn - CASE WHEN rn < k THEN 0 ELSE k END AS BIGINT) AS place, md5(text) AS text_md5 FROM r""",
)
def split_and_shuffle(spark: SparkSession, d: str) -> DataFrame:
    """Mixed, split and shuffled documents, written as they lie and read back."""
    placed = M.split_and_shuffle(mixed_docs(spark, d), test=0.05, key=["source", "doc_id", "copy_no"])
    folder = scratch_path(spark, "shuffled")
    write_corpus(placed, folder, order="place", placed=True)
    sides = [load_corpus(spark, folder, side).withColumn("split", F.lit(side)) for side in ("train", "test")]
    both = sides[0].unionByName(sides[1])
    return both.select("source", "doc_id", "copy_no", "split", "place", F.md5("text").alias("text_md5"))


@query(
    "leaked_copies",
    f"""WITH {_SQL_MIX},
    r AS (SELECT *, row_number() OVER (ORDER BY md5('1234:' || doc_id || ':' || copy_no), doc_id, copy_no) AS rn, count(*) OVER () AS n FROM mixed),
    s AS (SELECT doc_id, count(DISTINCT rn <= ceil(n * 0.05::DOUBLE)) AS sides FROM r GROUP BY doc_id)
    SELECT count(*) AS n_leaked FROM s WHERE sides > 1""",
)
def leaked_copies(spark: SparkSession, d: str) -> DataFrame:
    parted = M.split(mixed_docs(spark, d), test=0.05, key=["doc_id", "copy_no"])
    return M.leaked_copies(parted, key=["doc_id"])
