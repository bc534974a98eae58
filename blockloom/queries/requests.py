"""Request tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.functions import text as T
from blockloom.operators import requests as Q
from blockloom.operators.vocab import encode
from blockloom.queries.registry import SQL_VOCAB, query, sql_encode, table, vocabulary

LIMIT = 300
SERVED = "served-model"

SQL_PROMPTS = f"""
folded AS (
  SELECT conv_id, arg_max(text, turn) FILTER (WHERE role = 'system') AS system,
    coalesce(string_agg(CASE role WHEN 'user' THEN '[INST] ' || text || ' [/INST]' ELSE ' ' || text || ' </s>' END, ''
      ORDER BY turn) FILTER (WHERE role <> 'system'), '') AS body
  FROM conversations GROUP BY conv_id),
prompts AS (
  SELECT conv_id, '[INST] <<SYS>>' || chr(10) || coalesce(system, '{T.SYSTEM_MESSAGE}') || chr(10) || '<</SYS>>' || chr(10) || chr(10)
    || CASE WHEN starts_with(body, '[INST] ') THEN body[8:] ELSE '[/INST]' || body END AS prompt
  FROM folded)"""


def prompts(spark: SparkSession, d: str) -> DataFrame:
    return Q.chat_prompts(table(spark, d, "conversations"))


def encoded_prompts(spark: SparkSession, d: str) -> DataFrame:
    return encode(prompts(spark, d), vocabulary(spark, d), text="prompt", key=["conv_id"])


SQL_ENCODED_PROMPTS = f"{SQL_VOCAB},{SQL_PROMPTS},{sql_encode('enc', 'prompts', 'conv_id', text='prompt')}"


@query(
    "fold_system",
    "SELECT conv_id, arg_max(text, turn) FILTER (WHERE role = 'system') AS system_text FROM conversations GROUP BY conv_id",
)
def fold_system(spark: SparkSession, d: str) -> DataFrame:
    return Q.fold_system(table(spark, d, "conversations"))


@query("chat_prompts", f"WITH {SQL_PROMPTS} SELECT conv_id, prompt FROM prompts")
def chat_prompts(spark: SparkSession, d: str) -> DataFrame:
    return prompts(spark, d)


_MESSAGE = f"""'This model''s maximum context length is {LIMIT} tokens. However, you requested ' || (n + wanted) || ' tokens ('
  || n || ' in the messages, ' || wanted || ' in the completion). Please reduce the length of the messages or completion.'"""


@query(
    "context_fit",
    f"""WITH {SQL_ENCODED_PROMPTS},
    t AS (SELECT conv_id, len(input_ids) AS n, CAST(50 + conv_id % 100 AS BIGINT) AS wanted FROM enc)
    SELECT conv_id, n AS n_prompt, wanted AS n_requested, n + wanted <= {LIMIT} AS fits,
      CASE WHEN n + wanted > {LIMIT} THEN {_MESSAGE} END AS message FROM t""",
)
def context_fit(spark: SparkSession, d: str) -> DataFrame:
    asked = encoded_prompts(spark, d).withColumn("max_tokens", 50 + F.col("conv_id") % 100)
    return Q.context_fit(asked, limit=LIMIT, key=["conv_id"])


@query(
    "request_status",
    f"""WITH {SQL_ENCODED_PROMPTS},
    t AS (SELECT conv_id, len(input_ids) AS n, CAST(50 + conv_id % 100 AS BIGINT) AS wanted, conv_id % 2 = 0 AS chat,
            CASE WHEN conv_id % 7 = 3 THEN 'other-model' ELSE '{SERVED}' END AS model FROM enc),
    s AS (SELECT conv_id, CASE
        WHEN model <> '{SERVED}' THEN '{Q.UNKNOWN_MODEL[0]}' || model || '{Q.UNKNOWN_MODEL[1]}'
        WHEN NOT chat AND conv_id % 5 = 1 THEN '{Q.NO_ECHO}'
        WHEN NOT chat AND conv_id % 5 = 2 THEN '{Q.NO_SUFFIX}'
        WHEN conv_id % 11 = 4 THEN '{Q.NO_BIAS}'
        WHEN NOT chat AND conv_id % 13 = 5 THEN '{Q.NO_PROMPT}'
        WHEN NOT chat AND conv_id % 13 = 6 THEN '{Q.MANY_PROMPTS}'
        WHEN chat AND n + wanted > {LIMIT} THEN {_MESSAGE} END AS message FROM t)
    SELECT conv_id, CAST(CASE WHEN message IS NULL THEN 200 WHEN message LIKE 'The model %' THEN 404 ELSE 400 END AS INTEGER) AS status,
      message FROM s""",
)
def request_status(spark: SparkSession, d: str) -> DataFrame:
    """Requests made of the conversations; every rule is broken by some."""
    c = F.col("conv_id")
    single = F.array(F.lit("p"))
    asked = encoded_prompts(spark, d).select(
        "conv_id",
        F.when(c % 2 == 0, "chat").otherwise("completion").alias("endpoint"),
        F.when(c % 7 == 3, "other-model").otherwise(SERVED).alias("model"),
        F.when(c % 11 == 4, F.lit("{}")).alias("logit_bias"),
        (c % 5 == 1).alias("echo"),
        F.when(c % 5 == 2, F.lit("end")).alias("suffix"),
        F.when(c % 13 == 5, F.slice(single, 1, 0)).when(c % 13 == 6, F.concat(single, single)).alias("prompts"),
        F.size("input_ids").cast("bigint").alias("n_prompt"),
        (50 + c % 100).alias("max_tokens"),
    )
    return Q.request_status(asked, served=SERVED, limit=LIMIT).select("conv_id", "status", "message")
