"""Result tables.  Every assistant turn counts as one generated choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.operators import results as U
from blockloom.operators.vocab import encode
from blockloom.queries.registry import SQL_VOCAB, digest, query, sql_digest, sql_encode, table, vocabulary
from blockloom.queries.requests import SQL_PROMPTS, encoded_prompts, prompts

CANDIDATES = [4, 5, 6, 7, 8, 9, 10]


def _answers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("request_id"), F.col("turn").cast("int").alias("idx"), "text"
    )


def _choices(spark: SparkSession, d: str) -> DataFrame:
    return encode(
        _answers(spark, d), vocabulary(spark, d), key=["request_id", "idx"], keep=["text"], add_bos=False, out="token_ids"
    )


def _with_logprobs(choices: DataFrame) -> DataFrame:
    """The chosen token and two others per position, by a rule."""

    def alternatives(t, i):
        near = t < 1000
        return F.create_map(
            t, -((t * 7 + i) % 90) / 10.0,
            F.when(near, t + 1000).otherwise(t - 1), -((t * 5 + i) % 90) / 10.0 - 0.05,
            F.when(near, t + 1001).otherwise(t - 2), -((t * 3 + i) % 90) / 10.0 - 0.07,
        )

    return choices.withColumn("logprobs", F.transform("token_ids", alternatives))


def _positions(spark: SparkSession, d: str) -> DataFrame:
    return U.explode_positions(_with_logprobs(_choices(spark, d)))


_CHOICES = f"""{SQL_VOCAB},
answers AS (SELECT conv_id AS request_id, CAST(turn AS INTEGER) AS idx, text FROM conversations WHERE role = 'assistant'),
{sql_encode('choices', 'answers', 'request_id, idx', bos=False).strip()},
pos AS (SELECT request_id, idx, unnest(input_ids) AS t, CAST(generate_subscripts(input_ids, 1) - 1 AS INTEGER) AS pos FROM choices),
alts AS (
  SELECT request_id, idx, pos, t AS id, -((t * 7 + pos) % 90) / 10.0::DOUBLE AS lp FROM pos
  UNION ALL SELECT request_id, idx, pos, CASE WHEN t < 1000 THEN t + 1000 ELSE t - 1 END, -((t * 5 + pos) % 90) / 10.0::DOUBLE - 0.05 FROM pos
  UNION ALL SELECT request_id, idx, pos, CASE WHEN t < 1000 THEN t + 1001 ELSE t - 2 END, -((t * 3 + pos) % 90) / 10.0::DOUBLE - 0.07 FROM pos)"""


@query(
    "token_logprob",
    f"WITH {_CHOICES} SELECT request_id, idx, pos, t AS token_id, round(-((t * 7 + pos) % 90) / 10.0::DOUBLE, 6) AS token_logprob FROM pos",
)
def token_logprob(spark: SparkSession, d: str) -> DataFrame:
    chosen = U.token_logprob(_positions(spark, d))
    return chosen.select("request_id", "idx", "pos", "token_id", F.round("token_logprob", 6).alias("token_logprob"))


@query(
    "text_offsets",
    f"""WITH {_CHOICES}
    SELECT request_id, idx, pos, token, CAST(coalesce(sum(length(token)) OVER (
      PARTITION BY request_id, idx ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS text_offset
    FROM pos JOIN vocab ON t = id""",
)
def text_offsets(spark: SparkSession, d: str) -> DataFrame:
    placed = U.text_offsets(_choices(spark, d), vocabulary(spark, d))
    # (a plain posexplode would have all of the above evaluated once more, to see whether there are positions)
    each = F.posexplode_outer(F.arrays_zip("tokens", "text_offset")).alias("pos", "_z")
    return placed.select("request_id", "idx", each).where("pos is not null").select(
        "request_id", "idx", "pos", F.col("_z.tokens").alias("token"), F.col("_z.text_offset").alias("text_offset")
    )


@query(
    "top_logprobs",
    f"""WITH {_CHOICES},
    r AS (SELECT *, row_number() OVER (PARTITION BY request_id, idx, pos ORDER BY lp DESC, id) AS rn FROM alts)
    SELECT request_id, idx, pos, string_agg(token, ' ' ORDER BY token) AS tokens, round(sum(lp), 6) AS total
    FROM r JOIN vocab USING (id) WHERE rn <= 2 GROUP BY request_id, idx, pos""",
)
def top_logprobs(spark: SparkSession, d: str) -> DataFrame:
    top = U.top_logprobs(_with_logprobs(_choices(spark, d)), vocabulary(spark, d), k=2)
    total = F.aggregate(F.map_values("top"), F.lit(0.0), lambda a, x: a + x)
    each = F.posexplode_outer("top_logprobs").alias("pos", "top")  # as in text_offsets
    return top.select("request_id", "idx", each).where("pos is not null").select(
        "request_id",
        "idx",
        "pos",
        F.array_join(F.array_sort(F.map_keys("top")), " ").alias("tokens"),
        F.round(total, 6).alias("total"),
    )


@query(
    "next_token_prob",
    f"""WITH {_CHOICES},
    f AS (SELECT request_id, idx FROM pos WHERE pos = 0), c AS (SELECT CAST(unnest({CANDIDATES}) AS INTEGER) AS candidate)
    SELECT f.request_id, f.idx, c.candidate, round(exp(a.lp), 9) AS prob
    FROM f CROSS JOIN c LEFT JOIN alts a ON a.request_id = f.request_id AND a.idx = f.idx AND a.pos = 0 AND a.id = c.candidate""",
)
def next_token_prob(spark: SparkSession, d: str) -> DataFrame:
    probs = U.next_token_prob(_positions(spark, d), CANDIDATES)
    return probs.select("request_id", "idx", "candidate", F.round("prob", 9).alias("prob"))


@query(
    "snapshot_delta",
    f"""WITH {_CHOICES},
    steps AS (SELECT *, CAST(unnest(range(0, CAST(ceil(length(text) / 200.0) AS BIGINT))) AS INTEGER) AS step FROM choices)
    SELECT request_id, idx, step, CAST(step * 200 AS BIGINT) AS text_offset, substring(text, step * 200 + 1, 200) AS delta_text,
      {sql_digest('input_ids[step * 20 + 1 : (step + 1) * 20]')} AS ids_md5 FROM steps""",
)
def snapshot_delta(spark: SparkSession, d: str) -> DataFrame:
    """Growing snapshots of every answer: 200 characters, 20 tokens a step."""
    choices = _choices(spark, d)
    last = F.ceil(F.length("text") / 200).cast("int") - 1
    steps = choices.select("*", F.explode(F.sequence(F.lit(0), last)).alias("step"))
    grown = steps.select(
        "request_id",
        "idx",
        "step",
        F.substring("text", F.lit(1), (F.col("step") + 1) * 200).alias("text"),
        F.slice("token_ids", 1, (F.col("step") + 1) * 20).alias("token_ids"),
    )
    delta = U.snapshot_delta(grown)
    return delta.select("request_id", "idx", "step", "text_offset", "delta_text", digest(F.col("delta_ids")).alias("ids_md5"))


_RECORD = "text_offset array<bigint>, token_logprobs array<double>, tokens array<string>, top_logprobs array<map<string,double>>"


@query(
    "assemble_outputs",
    f"""WITH {_CHOICES},{SQL_PROMPTS},
    named AS (
      SELECT request_id, idx, pos, t, token, coalesce(sum(length(token)) OVER (
        PARTITION BY request_id, idx ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS text_offset
      FROM pos JOIN vocab ON t = id),
    best AS (
      SELECT request_id, idx, pos, string_agg(token, ' ' ORDER BY token) AS alternatives, sum(lp) AS total
      FROM alts JOIN vocab USING (id) GROUP BY request_id, idx, pos),
    records AS (
      SELECT request_id, idx, md5(string_agg(token, '|' ORDER BY pos)) AS tokens, sum(text_offset) AS offsets,
        sum(-((t * 7 + pos) % 90) / 10.0::DOUBLE) AS own, md5(string_agg(alternatives, '|' ORDER BY pos)) AS alternatives, sum(total) AS total
      FROM named JOIN best USING (request_id, idx, pos) GROUP BY request_id, idx)
    SELECT c.conv_id AS request_id, CAST(count(*) AS INTEGER) AS n, string_agg(md5(prompt || text), ',' ORDER BY turn) AS texts,
      string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS "index",
      string_agg(CASE WHEN length(text) > 500 THEN 'length' ELSE 'stop' END, ',' ORDER BY turn) AS finish_reason,
      string_agg(coalesce(tokens, md5('')), ',' ORDER BY turn) AS tokens,
      string_agg(coalesce(alternatives, md5('')), ',' ORDER BY turn) AS alternatives,
      CAST(coalesce(sum(offsets), 0) AS BIGINT) AS offsets, round(coalesce(sum(own), 0), 4) AS own, round(coalesce(sum(total), 0), 4) AS total
    FROM conversations c JOIN prompts p USING (conv_id) LEFT JOIN records r ON r.request_id = c.conv_id AND r.idx = c.turn
    WHERE role = 'assistant' GROUP BY c.conv_id""",
)
def assemble_outputs(spark: SparkSession, d: str) -> DataFrame:
    """The logprobs are read back from the JSON of each choice."""
    asked = prompts(spark, d).withColumnRenamed("conv_id", "request_id")
    reason = F.when(F.length("text") > 500, "length").otherwise("stop")
    recorded = U.logprobs_record(_with_logprobs(_choices(spark, d)), vocabulary(spark, d))
    rows = recorded.join(asked, "request_id").withColumn("finish_reason", reason)
    made = U.assemble_outputs(rows).withColumn("read", F.transform("logprobs", lambda j: F.from_json(j, _RECORD)))
    add = lambda total, x: total + x

    def total(values, zero):
        return F.aggregate(F.flatten(values), zero, add)

    def named(top):
        return F.array_join(F.transform(top, lambda m: F.array_join(F.array_sort(F.map_keys(m)), " ")), "|")

    return made.select(
        "request_id",
        F.size("text").alias("n"),
        F.array_join(F.transform("text", F.md5), ",").alias("texts"),
        F.array_join(F.col("index").cast("array<string>"), ",").alias("index"),
        F.array_join("finish_reason", ",").alias("finish_reason"),
        F.array_join(F.transform("read", lambda r: F.md5(F.array_join(r["tokens"], "|"))), ",").alias("tokens"),
        F.array_join(F.transform("read", lambda r: F.md5(named(r["top_logprobs"]))), ",").alias("alternatives"),
        total(F.transform("read", lambda r: r["text_offset"]), F.lit(0).cast("bigint")).alias("offsets"),
        F.round(total(F.transform("read", lambda r: r["token_logprobs"]), F.lit(0.0)), 4).alias("own"),
        F.round(total(F.transform("read", lambda r: F.flatten(F.transform(r["top_logprobs"], F.map_values))), F.lit(0.0)), 4).alias("total"),
    )


@query(
    "usage_totals",
    f"""WITH {_CHOICES},{SQL_PROMPTS},{sql_encode('enc', 'prompts', 'conv_id', text='prompt')},
    c AS (SELECT request_id, sum(len(input_ids)) AS n FROM choices GROUP BY request_id)
    SELECT request_id, CAST(len(input_ids) AS BIGINT) AS prompt_tokens, CAST(n AS BIGINT) AS completion_tokens,
      CAST(len(input_ids) + n AS BIGINT) AS total_tokens FROM c JOIN enc ON conv_id = request_id""",
)
def usage_totals(spark: SparkSession, d: str) -> DataFrame:
    asked = encoded_prompts(spark, d).select(F.col("conv_id").alias("request_id"), F.col("input_ids").alias("prompt_ids"))
    return U.usage_totals(_choices(spark, d).join(asked, "request_id"))
