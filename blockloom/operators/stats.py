"""Corpus statistics and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.functions.text import millions, name_prefix, thousands


def row_counts(df: DataFrame, *, by: Sequence[str] = ("source", "split")) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"))


def corpus_stats(
    df: DataFrame,
    *,
    mode: str = "exact",
    by: str = "source",
    ids: str = "input_ids",
    order: Sequence[str] = ("row_idx",),
) -> DataFrame:
    """Rows and tokens per corpus as ``(name, rows, tokens)``.

    ``exact`` adds the lengths up.  ``estimate`` multiplies the row count by
    the length of the first row: right for full blocks, a guess otherwise.
    """
    length = F.size(ids).cast("bigint")
    if mode == "exact":
        tokens = F.sum(length)
    elif mode == "estimate":
        tokens = F.count("*") * F.min_by(length, F.struct(*order))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.groupBy(F.col(by).alias("name")).agg(F.count("*").alias("rows"), tokens.alias("tokens"))


def prefix_rollup(df: DataFrame, *, values: Sequence[str] = ("rows", "tokens")) -> DataFrame:
    """Sum the statistics whose names share the part before the first ``_``."""
    return df.groupBy(name_prefix(F.col("name")).alias("prefix")).agg(*[F.sum(v).alias(v) for v in values])


def stats_totals(df: DataFrame, *, values: Sequence[str] = ("rows", "tokens")) -> DataFrame:
    """Per corpus, per prefix and overall, in one aggregation.

    ``level`` is ``name``, ``prefix`` or ``all``.
    """
    rows = df.select(name_prefix(F.col("name")).alias("prefix"), "name", *values)
    rolled = rows.rollup("prefix", "name").agg(F.grouping_id().alias("_g"), *[F.sum(v).alias(v) for v in values])
    level = F.when(F.col("_g") == 0, "name").when(F.col("_g") == 1, "prefix").otherwise("all")
    return rolled.select(level.alias("level"), "prefix", "name", *values)


def sorted_report(df: DataFrame) -> DataFrame:
    """Statistics by name: row counts with thousands separators, tokens in
    millions."""
    return df.select(
        "name", thousands(F.col("rows")).alias("rows_text"), millions(F.col("tokens")).alias("tokens_millions")
    ).orderBy("name")
