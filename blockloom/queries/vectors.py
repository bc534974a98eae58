"""Keyed vectors.  Values are compared as whole millionths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blockloom.operators import vectors as X
from blockloom.queries.registry import digest, query, table

RANK = 4
SCALE = 0.5


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("v"), "label")


def _shown(v: str):
    return digest(F.transform(v, lambda x: F.floor(x.cast("double") * 1e6)))


def _sql_shown(v: str) -> str:
    return f"md5(array_to_string(list_transform({v}, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1e6) AS BIGINT)), ','))"


_MINUS = "list_transform(list_zip({a}, {b}), lambda z: z[1] - z[2])"


@query(
    "vector_arith",
    f"""WITH t AS (SELECT vec_id + 1 AS key, embedding AS b FROM embeddings)
    SELECT vec_id AS key, {_sql_shown(f"CASE WHEN b IS NULL THEN embedding ELSE {_MINUS.format(a='embedding', b='b')} END")} AS v_md5
    FROM embeddings LEFT JOIN t ON key = vec_id""",
)
def vector_arith(spark: SparkSession, d: str) -> DataFrame:
    """Every vector minus its predecessor; the first has none."""
    source = _vectors(spark, d).select("key", "v")
    target = source.select((F.col("key") + 1).alias("key"), "v")
    return X.vector_arith(source, target, op="-").select("key", _shown("v").alias("v_md5"))


@query(
    "vector_pad",
    f"""WITH s AS (SELECT label, vec_id, CASE WHEN label = 3 THEN embedding[1:60] ELSE embedding END AS a,
                  list_reverse(CASE WHEN label = 7 THEN embedding[1:50] ELSE embedding END) AS b FROM embeddings),
    p AS (SELECT vec_id, list_resize(a, greatest(len(a), len(b)), 0::FLOAT) AS a, list_resize(b, greatest(len(a), len(b)), 0::FLOAT) AS b FROM s)
    SELECT vec_id, CAST(len(a) AS INTEGER) AS n, {_sql_shown(_MINUS.format(a='a', b='b').replace('-', '+'))} AS v_md5 FROM p""",
)
def vector_pad(spark: SparkSession, d: str) -> DataFrame:
    """Label 3 is short in the source, label 7 in the target."""
    rows = table(spark, d, "embeddings")
    v, label = F.col("embedding"), F.col("label")
    source = rows.select("label", "vec_id", F.when(label == 3, F.slice(v, 1, 60)).otherwise(v).alias("v"))
    target = rows.select("label", "vec_id", F.reverse(F.when(label == 7, F.slice(v, 1, 50)).otherwise(v)).alias("v"))
    summed = X.vector_arith(source, target, op="+", key=["label", "vec_id"], pad_keys=["3", "7"])
    return summed.select("vec_id", F.size("v").alias("n"), _shown("v").alias("v_md5"))


_RANKED = "SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS k FROM embeddings"
_TERMS = " + ".join(f"l[{k + 1}] * w{k}[j]" for k in range(RANK))


@query(
    "low_rank_update",
    f"""WITH r AS ({_RANKED}),
    a AS (SELECT label, {', '.join(f'any_value(embedding) FILTER (WHERE k = {k}) AS w{k}' for k in range(RANK))}
          FROM r WHERE k < {RANK} AND label <> 9 GROUP BY label),
    b AS (SELECT label, vec_id, embedding[11:{10 + RANK}] AS l FROM embeddings WHERE label <> 9),
    w AS (SELECT label, vec_id, CASE WHEN label = 5
            THEN list_transform(embedding, lambda x: CAST(floor(x * 64) / 64 AS FLOAT)) ELSE embedding END AS v FROM embeddings)
    SELECT w.label, w.vec_id, {_sql_shown(f"CASE WHEN l IS NULL OR w0 IS NULL THEN v ELSE list_transform(range(1, 65), lambda j: v[j] + ({_TERMS}) * {SCALE}::FLOAT) END")} AS v_md5
    FROM w LEFT JOIN b ON b.vec_id = w.vec_id LEFT JOIN a ON a.label = w.label""",
)
def low_rank_update(spark: SparkSession, d: str) -> DataFrame:
    """One matrix per label; label 5 is replaced first, label 9 has no factors."""
    rows = table(spark, d, "embeddings").withColumn("key", F.col("label").cast("string"))
    weights = rows.select("key", F.col("vec_id").alias("i"), F.col("embedding").alias("v"))
    with_factors = rows.where(F.col("label") != 9)
    rank = F.row_number().over(W.partitionBy("key").orderBy("vec_id")) - 1
    a = with_factors.withColumn("k", rank).where(F.col("k") < RANK).select("key", "k", F.col("embedding").alias("v"))
    b = with_factors.select("key", F.col("vec_id").alias("i"), F.slice("embedding", 11, RANK).alias("v"))
    coarse = F.transform("embedding", lambda x: (F.floor(x * 64) / 64).cast("float"))
    replaced = rows.where(F.col("label") == 5).select("key", F.col("vec_id").alias("i"), coarse.alias("v"))
    updated = X.low_rank_update(weights, a, b, scale=SCALE, replacement=replaced)
    return updated.select(
        F.col("key").cast("int").alias("label"), F.col("i").alias("vec_id"), _shown("v").alias("v_md5")
    )


@query(
    "keyed_last_wins",
    f"""WITH u AS (
      SELECT vec_id AS key, embedding AS v, 0 AS o FROM embeddings
      UNION ALL SELECT vec_id * 2, embedding, 1 FROM embeddings UNION ALL SELECT vec_id * 3, embedding, 2 FROM embeddings)
    SELECT key, {_sql_shown('arg_max(v, o)')} AS v_md5 FROM u GROUP BY key""",
)
def keyed_last_wins(spark: SparkSession, d: str) -> DataFrame:
    first = _vectors(spark, d).select("key", "v")
    tables = [first] + [first.select((F.col("key") * n).alias("key"), "v") for n in (2, 3)]
    return X.keyed_last_wins(tables).select("key", _shown("v").alias("v_md5"))


@query(
    "vector_size_total",
    "SELECT CAST(sum(len(embedding)) AS BIGINT) AS n_elements, CAST(sum(len(embedding)) * 4 AS BIGINT) AS n_bytes FROM embeddings",
)
def vector_size_total(spark: SparkSession, d: str) -> DataFrame:
    return X.size_total(_vectors(spark, d))
