"""Instruction rows to masked training examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.functions import arrays as A
from blockloom.functions import text as T
from blockloom.operators.vocab import BROADCAST_ROWS, Field, Vocabulary, encode_fields

#: Fixed value: instruction tokens kept at either end before the surplus
#: extends the head.
END_TOKENS = 500


def render(df: DataFrame, *, system: str = T.SYSTEM_MESSAGE, eos: str = T.EOS) -> DataFrame:
    """Add ``prompt`` and ``target`` texts to ``instruction, input, output`` rows."""
    instruction = T.merge_input(F.col("instruction"), F.col("input"))
    return df.select(
        "*",
        T.render_prompt(instruction, system).alias("prompt"),
        F.concat(T.output_text(F.col("output")), F.lit(eos)).alias("target"),
    )


def prompt_overheads(df: DataFrame, *, key: Sequence[str], system: str = "system") -> DataFrame:
    """Per system message ``p`` and ``q``: the token counts of the prompt's
    prefix, its bos included, and of its suffix.

    Unknown tokens count too, so no vocabulary is needed.
    """
    prefix = F.concat(F.lit(T.PROMPT_OPEN), F.col(system), F.lit(T.PROMPT_MIDDLE))
    return df.select(
        *key,
        (F.size(T.tokens(prefix)) + 1).alias("p"),
        F.size(T.tokens(F.lit(T.PROMPT_SUFFIX))).alias("q"),
    )


def prompt_overhead(spark: SparkSession, *, system: str = T.SYSTEM_MESSAGE) -> tuple[int, int]:
    """``(p, q)`` of one system message."""
    one = spark.range(1).select("id", F.lit(system).alias("system"))
    row = prompt_overheads(one, key=["id"]).first()
    return row["p"], row["q"]


def encode_pairs(
    df: DataFrame,
    vocab: Vocabulary,
    *,
    key: Sequence[str],
    keep: Sequence[str] = (),
    system: str = T.SYSTEM_MESSAGE,
    drop_missing_output: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``source_ids`` (bos, no eos) and ``target_ids`` (eos at the end)."""
    if drop_missing_output:
        df = df.where(F.col("output").isNotNull())
    prompt = T.render_prompt(T.merge_input(F.col("instruction"), F.col("input")), system)
    fields = [
        Field(prompt, "source_ids", add_bos=True, add_eos=False),
        Field(T.output_text(F.col("output")), "target_ids", add_bos=False, add_eos=True),
    ]
    return encode_fields(df, vocab, fields, key=key, keep=keep, broadcast_rows=broadcast_rows)


def _cut_source(source: str, mode: str, room: Column, p: int, q: int, cap: int) -> Column:
    """The source cut to ``room`` tokens: prefix, part of the instruction, suffix."""
    ids = F.col(source)
    middle = room - p - q
    kept = {"keep_head": F.lit(0), "keep_tail": middle, "head_tail": F.least(F.ceil(middle / 2).cast("int"), F.lit(cap))}[mode]
    last = q + kept
    first = room - last
    usable = (first >= 0) & (last > 0)
    cut = F.concat(A.head(ids, first), A.tail(ids, last))
    return F.when(usable, cut).otherwise(
        F.raise_error(F.lit("the length limits leave no room for the instruction")).cast("array<int>")
    )


def truncate(
    df: DataFrame,
    *,
    max_len: int,
    max_target: int,
    p: int,
    q: int,
    mode: str = "head_tail",
    cap: int = END_TOKENS,
) -> DataFrame:
    """Bring ``source_ids`` + ``target_ids`` to at most ``max_len`` tokens.

    Only rows that are too long change.  Their target is cut to ``max_target``
    first, which also cuts its eos; the source then gets the room that is
    left, its prefix and suffix kept whole.  Modes: ``head_tail`` (both ends of
    the instruction, surplus to the head), ``keep_head``, ``keep_tail``.

    Adds ``truncated``, ``source_len`` and ``target_len`` (the old lengths).
    """
    if mode not in ("head_tail", "keep_head", "keep_tail"):
        raise ValueError(f"unknown mode {mode!r}")
    lengths = df.select(
        "*",
        F.size("source_ids").alias("source_len"),
        F.size("target_ids").alias("target_len"),
        (F.size("source_ids") + F.size("target_ids") > max_len).alias("truncated"),
    )
    others = [c for c in lengths.columns if c not in ("source_ids", "target_ids")]
    room = F.lit(max_len) - F.least(F.col("target_len"), F.lit(max_target))
    return lengths.select(
        *others,
        F.when(F.col("truncated") & (F.col("source_len") > room), _cut_source("source_ids", mode, room, p, q, cap))
        .otherwise(F.col("source_ids"))
        .alias("source_ids"),
        F.when(F.col("truncated"), A.head(F.col("target_ids"), max_target))
        .otherwise(F.col("target_ids"))
        .alias("target_ids"),
    )


def mask_labels(df: DataFrame, *, ignore: int = T.IGNORE, max_len: int | None = None) -> DataFrame:
    """``input_ids`` and ``labels`` from source and target ids.

    ``max_len`` cuts both plainly at that length (the naive truncation).
    """
    source, target = F.col("source_ids"), F.col("target_ids")
    ids, labels = F.concat(source, target), A.mask_labels(source, target, ignore)
    if max_len is not None:
        ids, labels = A.head(ids, max_len), A.head(labels, max_len)
    return df.select(
        *[c for c in df.columns if c not in ("source_ids", "target_ids")],
        ids.alias("input_ids"),
        labels.alias("labels"),
    )


def truncation_report(df: DataFrame, *, key: Sequence[str]) -> DataFrame:
    """Old and new lengths of every truncated row; ``df`` is what
    :func:`truncate` returns."""
    new_source, new_target = F.size("source_ids"), F.size("target_ids")
    return df.where("truncated").select(
        *key,
        (F.col("source_len") + F.col("target_len")).alias("old_total"),
        (new_source + new_target).alias("new_total"),
        F.col("source_len").alias("old_source"),
        new_source.alias("new_source"),
        F.col("target_len").alias("old_target"),
        new_target.alias("new_target"),
    )


def length_profile(df: DataFrame, *, by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Token-length statistics of untruncated pairs.

    ``exact=False`` swaps the exact median and 90th percentile, which keep one
    counter per distinct length, for approximate ones.
    """
    n = F.size("source_ids") + F.size("target_ids")
    quantile = F.percentile if exact else F.percentile_approx
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.min(n).alias("min_len"),
        F.max(n).alias("max_len"),
        F.avg(n).alias("avg_len"),
        quantile(n, F.lit(0.5)).cast("double").alias("p50_len"),
        quantile(n, F.lit(0.9)).cast("double").alias("p90_len"),
    )


def instruction_examples(
    df: DataFrame,
    vocab: Vocabulary,
    *,
    key: Sequence[str],
    keep: Sequence[str] = (),
    max_len: int = 4096,
    max_target: int = 512,
    mode: str = "head_tail",
    system: str = T.SYSTEM_MESSAGE,
) -> DataFrame:
    """Instruction rows to ``input_ids`` and ``labels``, start to finish."""
    p, q = prompt_overhead(df.sparkSession, system=system)
    pairs = encode_pairs(df, vocab, key=key, keep=keep, system=system)
    cut = truncate(pairs, max_len=max_len, max_target=max_target, p=p, q=q, mode=mode)
    return mask_labels(cut).select(*key, *keep, "input_ids", "labels")


__all__ = [
    "encode_pairs",
    "instruction_examples",
    "length_profile",
    "mask_labels",
    "prompt_overhead",
    "prompt_overheads",
    "render",
    "truncate",
    "truncation_report",
]
