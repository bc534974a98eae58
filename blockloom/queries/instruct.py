"""Instruction rows to masked examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.functions import text as T
from blockloom.operators import instruct as I
from blockloom.queries.registry import (
    CAP,
    MAX_LEN,
    MAX_TARGET,
    SQL_INSTRUCTIONS,
    SQL_PAIRS,
    SQL_PROMPT,
    digest,
    instructions,
    pairs,
    query,
    sql_digest,
    sql_tokens,
    table,
)

KEY = ["conv_id", "turn"]
_MERGED = "CASE WHEN coalesce(input, '') <> '' THEN instruction || chr(10) || input ELSE instruction END"


@query("merge_input", f"WITH {SQL_INSTRUCTIONS} SELECT conv_id, turn, {_MERGED} AS merged FROM instr")
def merge_input(spark: SparkSession, d: str) -> DataFrame:
    return instructions(spark, d).select(*KEY, T.merge_input(F.col("instruction"), F.col("input")).alias("merged"))


@query("render_prompt", f"WITH {SQL_INSTRUCTIONS} SELECT conv_id, turn, {SQL_PROMPT} AS prompt FROM instr")
def render_prompt(spark: SparkSession, d: str) -> DataFrame:
    return I.render(instructions(spark, d)).select(*KEY, "prompt")


@query(
    "render_target",
    f"""WITH {SQL_INSTRUCTIONS}
    SELECT conv_id, turn, coalesce(CASE WHEN turn % 4 <> 0 OR conv_id % 7 <> 0 THEN output END, 'None') || '</s>' AS target FROM instr""",
)
def render_target(spark: SparkSession, d: str) -> DataFrame:
    """Some outputs are taken as missing."""
    given = (F.col("turn") % 4 != 0) | (F.col("conv_id") % 7 != 0)
    rows = instructions(spark, d).withColumn("output", F.when(given, F.col("output")))
    return I.render(rows).select(*KEY, "target")


@query(
    "encode_pair",
    f"""WITH {SQL_PAIRS}
    SELECT conv_id, turn, CAST(len(source_ids) AS INTEGER) AS n_source, CAST(len(target_ids) AS INTEGER) AS n_target,
      {sql_digest('source_ids')} AS source_md5, {sql_digest('target_ids')} AS target_md5 FROM pairs""",
)
def encode_pair(spark: SparkSession, d: str) -> DataFrame:
    return pairs(spark, d).select(
        *KEY,
        F.size("source_ids").alias("n_source"),
        F.size("target_ids").alias("n_target"),
        digest(F.col("source_ids")).alias("source_md5"),
        digest(F.col("target_ids")).alias("target_md5"),
    )


_LABELS = "list_concat(list_transform(source_ids, lambda x: -100), target_ids)"


def examples(spark: SparkSession, d: str) -> DataFrame:
    return I.mask_labels(pairs(spark, d))


@query(
    "mask_labels",
    f"""WITH {SQL_PAIRS}
    SELECT conv_id, turn, {sql_digest('list_concat(source_ids, target_ids)')} AS ids_md5, {sql_digest(_LABELS)} AS labels_md5
    FROM pairs""",
)
def mask_labels(spark: SparkSession, d: str) -> DataFrame:
    return examples(spark, d).select(
        *KEY, digest(F.col("input_ids")).alias("ids_md5"), digest(F.col("labels")).alias("labels_md5")
    )


@query(
    "prompt_overhead",
    f"""WITH s AS (SELECT conv_id, arg_max(text, turn) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id),
    t AS (SELECT conv_id, '[INST] <<SYS>>' || chr(10) || system || chr(10) || '<</SYS>>' || chr(10) || chr(10) AS prefix FROM s)
    SELECT conv_id, CAST(1 + len({sql_tokens('prefix')}) AS INTEGER) AS p, CAST(1 AS INTEGER) AS q FROM t""",
)
def prompt_overhead(spark: SparkSession, d: str) -> DataFrame:
    """The overhead of every system message in use."""
    chats = table(spark, d, "conversations").where(F.col("role") == "system")
    systems = chats.groupBy("conv_id").agg(F.max_by("text", "turn").alias("system"))
    return I.prompt_overheads(systems, key=["conv_id"])


def _truncated(spark: SparkSession, d: str, mode: str = "head_tail") -> DataFrame:
    p, q = I.prompt_overhead(spark)
    return I.truncate(pairs(spark, d), max_len=MAX_LEN, max_target=MAX_TARGET, p=p, q=q, mode=mode, cap=CAP)


def _sql_ends(mode: str, cap: int) -> tuple[str, str]:
    """Head and tail lengths; the default prompt's overhead is 10 and 1."""
    kept = {"head_tail": f"least((m + 1) // 2, {cap})", "keep_head": "0", "keep_tail": "m"}[mode]
    return f"11 + m - (1 + {kept})", f"1 + {kept}"


def sql_truncated(mode: str, cap: int = CAP) -> str:
    """CTEs up to ``cut``: the truncated pairs with their old lengths."""
    head, tail = _sql_ends(mode, cap)
    return f"""{SQL_PAIRS},
measured AS (
  SELECT *, len(source_ids) AS sl, len(target_ids) AS tl, len(source_ids) + len(target_ids) > {MAX_LEN} AS truncated,
    {MAX_LEN} - least(len(target_ids), {MAX_TARGET}) AS room, {MAX_LEN} - least(len(target_ids), {MAX_TARGET}) - 11 AS m
  FROM pairs),
ends AS (SELECT *, {head} AS hl, {tail} AS rl FROM measured),
cut AS (
  SELECT conv_id, turn, truncated, sl, tl,
    CASE WHEN truncated AND sl > room THEN list_concat(source_ids[1 : hl], source_ids[sl - rl + 1 : sl]) ELSE source_ids END AS source_ids,
    CASE WHEN truncated THEN target_ids[1 : {MAX_TARGET}] ELSE target_ids END AS target_ids
  FROM ends)"""


def _register_truncation(name: str, mode: str) -> None:
    sql = f"""WITH {sql_truncated(mode)}
    SELECT conv_id, turn, truncated, CAST(len(source_ids) AS INTEGER) AS n_source, CAST(len(target_ids) AS INTEGER) AS n_target,
      {sql_digest('list_concat(source_ids, target_ids)')} AS ids_md5 FROM cut"""

    @query(name, sql)
    def truncation(spark: SparkSession, d: str) -> DataFrame:
        return _truncated(spark, d, mode).select(
            *KEY,
            "truncated",
            F.size("source_ids").alias("n_source"),
            F.size("target_ids").alias("n_target"),
            digest(F.concat("source_ids", "target_ids")).alias("ids_md5"),
        )


for _name, _mode in (
    ("truncate_head_tail", "head_tail"),
    ("truncate_keep_head", "keep_head"),
    ("truncate_keep_tail", "keep_tail"),
):
    _register_truncation(_name, _mode)


@query(
    "truncate_naive",
    f"""WITH {SQL_PAIRS}
    SELECT conv_id, turn, {sql_digest(f'list_concat(source_ids, target_ids)[1:{MAX_LEN}]')} AS ids_md5,
      {sql_digest(f'{_LABELS}[1:{MAX_LEN}]')} AS labels_md5 FROM pairs""",
)
def truncate_naive(spark: SparkSession, d: str) -> DataFrame:
    return I.mask_labels(pairs(spark, d), max_len=MAX_LEN).select(
        *KEY, digest(F.col("input_ids")).alias("ids_md5"), digest(F.col("labels")).alias("labels_md5")
    )


@query(
    "truncation_report",
    f"""WITH {sql_truncated('head_tail')}
    SELECT conv_id, turn, CAST(sl + tl AS INTEGER) AS old_total, CAST(len(source_ids) + len(target_ids) AS INTEGER) AS new_total,
      CAST(sl AS INTEGER) AS old_source, CAST(len(source_ids) AS INTEGER) AS new_source,
      CAST(tl AS INTEGER) AS old_target, CAST(len(target_ids) AS INTEGER) AS new_target FROM cut WHERE truncated""",
)
def truncation_report(spark: SparkSession, d: str) -> DataFrame:
    return I.truncation_report(_truncated(spark, d), key=KEY)


@query(
    "length_profile",
    f"""WITH {SQL_PAIRS}, l AS (SELECT len(source_ids) + len(target_ids) AS n FROM pairs)
    SELECT count(*) AS n, CAST(min(n) AS INTEGER) AS min_len, CAST(max(n) AS INTEGER) AS max_len, round(avg(n), 6) AS avg_len,
      round(quantile_cont(n, 0.5), 6) AS p50_len, round(quantile_cont(n, 0.9), 6) AS p90_len FROM l""",
)
def length_profile(spark: SparkSession, d: str) -> DataFrame:
    profile = I.length_profile(pairs(spark, d))
    return profile.select("n", "min_len", "max_len", *[F.round(c, 6).alias(c) for c in ("avg_len", "p50_len", "p90_len")])
