"""Corpus statistics and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.functions.text import millions, thousands
from blockloom.operators import metrics as E
from blockloom.operators import sampling as M
from blockloom.operators import stats as S
from blockloom.queries.instruct import examples
from blockloom.queries.registry import SQL_ENCODED_DOCS, SQL_PAIRS, encoded_docs, query, table

_STATS = f"""{SQL_ENCODED_DOCS},
stats AS (
  SELECT lang || '_' || source AS name, count(*) AS n, CAST(sum(len(input_ids)) AS BIGINT) AS tokens,
    count(*) * arg_min(len(input_ids), doc_id) AS guess
  FROM enc GROUP BY 1)"""


def _named(spark: SparkSession, d: str) -> DataFrame:
    """Each language of each source is one corpus."""
    return encoded_docs(spark, d).withColumn("name", F.concat_ws("_", "lang", "source"))


def _exact(spark: SparkSession, d: str) -> DataFrame:
    return S.corpus_stats(_named(spark, d), by="name")


@query(
    "row_counts",
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY md5('1234:' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM documents)
    SELECT source, CASE WHEN rn <= ceil(n * 0.05::DOUBLE) THEN 'test' ELSE 'train' END AS split, count(*) AS n_rows FROM r GROUP BY ALL""",
)
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    return S.row_counts(M.split(table(spark, d, "documents"), test=0.05, key=["doc_id"]))


@query("token_estimate", f'WITH {_STATS} SELECT name, n AS "rows", guess AS tokens FROM stats')
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return S.corpus_stats(_named(spark, d), mode="estimate", by="name", order=["doc_id"])


@query("token_exact", f'WITH {_STATS} SELECT name, n AS "rows", tokens FROM stats')
def token_exact(spark: SparkSession, d: str) -> DataFrame:
    return _exact(spark, d)


@query(
    "prefix_rollup",
    f"""WITH {_STATS}
    SELECT split_part(name, '_', 1) AS prefix, CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(tokens) AS BIGINT) AS tokens
    FROM stats GROUP BY 1""",
)
def prefix_rollup(spark: SparkSession, d: str) -> DataFrame:
    return S.prefix_rollup(_exact(spark, d))


@query(
    "stats_totals",
    f"""WITH {_STATS}, p AS (SELECT *, split_part(name, '_', 1) AS prefix FROM stats)
    SELECT CASE WHEN grouping(name) = 0 THEN 'name' WHEN grouping(prefix) = 0 THEN 'prefix' ELSE 'all' END AS level,
      prefix, name, CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(tokens) AS BIGINT) AS tokens
    FROM p GROUP BY GROUPING SETS ((prefix, name), (prefix), ())""",
)
def stats_totals(spark: SparkSession, d: str) -> DataFrame:
    return S.stats_totals(_exact(spark, d))


@query(
    "sorted_report",
    f"WITH {_STATS} SELECT name, format('{{:,}}', n) AS rows_text, tokens / 1e6 AS tokens_millions FROM stats",
)
def sorted_report(spark: SparkSession, d: str) -> DataFrame:
    return S.sorted_report(_exact(spark, d))


@query(
    "format_counts",
    """SELECT event_type, format('{:,}', count(*)) AS n_text, round(count(*) / 1e6, 6) AS n_millions FROM events GROUP BY 1""",
)
def format_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return counts.select(
        "event_type", thousands(F.col("n")).alias("n_text"), F.round(millions(F.col("n")), 6).alias("n_millions")
    )


@query(
    "token_accuracy",
    f"""WITH {SQL_PAIRS},
    l AS (SELECT list_concat(list_transform(source_ids, lambda x: -100), target_ids) AS labels FROM pairs),
    t AS (SELECT len(labels) - 1 AS n,
            len(list_filter(labels[2:], lambda x, i: (x + i) % 3 <> 0 OR x = 0)) AS hits FROM l)
    SELECT CAST(sum(hits) AS BIGINT) AS n_correct, CAST(sum(n) AS BIGINT) AS n_tokens, round(sum(hits) / sum(n), 9) AS accuracy FROM t""",
)
def token_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Predictions are the following labels, about a third of them spoilt."""
    following = F.slice("labels", 2, F.size("labels") - 1)
    spoilt = F.transform(following, lambda x, i: F.when((x + i + 1) % 3 != 0, x).otherwise(0))
    rows = examples(spark, d).withColumn("preds", F.concat(spoilt, F.array(F.lit(0))))
    return E.token_accuracy(rows).select("n_correct", "n_tokens", F.round("accuracy", 9).alias("accuracy"))


@query(
    "accuracy_options",
    """WITH r AS (SELECT doc_id % 5 + 1 AS w, CASE WHEN 1 - toxic = quality THEN 1 ELSE 0 END AS hit FROM labels)
    SELECT 'share' AS variant, round(sum(hit) / count(*), 9) AS accuracy FROM r
    UNION ALL SELECT 'count', CAST(sum(hit) AS DOUBLE) FROM r
    UNION ALL SELECT 'weighted', round(sum(w * hit) / sum(w), 9) FROM r
    UNION ALL SELECT 'weighted_count', CAST(sum(w * hit) AS DOUBLE) FROM r""",
)
def accuracy_options(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels").select(
        "quality", (1 - F.col("toxic")).alias("pred"), (F.col("doc_id") % 5 + 1).alias("w")
    )
    variants = {
        "share": {},
        "count": {"normalize": False},
        "weighted": {"weight": "w"},
        "weighted_count": {"weight": "w", "normalize": False},
    }
    parts = [
        E.accuracy(rows, label="quality", **options).select(F.lit(name).alias("variant"), F.round("accuracy", 9).alias("accuracy"))
        for name, options in variants.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "perplexity",
    """SELECT event_type, round(avg(value / 100), 6) AS eval_loss, round(exp(avg(value / 100)), 6) AS perplexity,
       isinf(exp(avg(value * 1000))) AS overflows FROM events GROUP BY event_type""",
)
def perplexity(spark: SparkSession, d: str) -> DataFrame:
    steps = table(spark, d, "events").select("event_type", (F.col("value") / 100).alias("loss"), (F.col("value") * 1000).alias("huge"))
    near = E.perplexity(steps, by=["event_type"])
    far = E.perplexity(steps, loss="huge", by=["event_type"]).select(
        "event_type", (F.col("perplexity") == float("inf")).alias("overflows")
    )
    return near.join(far, "event_type").select(
        "event_type", F.round("eval_loss", 6).alias("eval_loss"), F.round("perplexity", 6).alias("perplexity"), "overflows"
    )


@query("argmax_ids", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS pred FROM embeddings")
def argmax_ids(spark: SparkSession, d: str) -> DataFrame:
    return E.argmax_ids(table(spark, d, "embeddings"), logits="embedding").select("vec_id", "pred")
