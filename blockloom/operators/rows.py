"""Row access: explicit row numbers, limits, schema alignment.

Spark has no row order, so rows carry a dense ``row_idx``.  It is a running
total of ones; packing needs the running total of lengths.  Both come from
:func:`running_total`, which never puts an unbounded group into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blockloom.functions.text import count_pieces, text_pieces
from blockloom.session import stored

#: Up to this many rows one window per group is used as it is.
SMALL_ROWS = 200_000
#: Rows per range partition beyond that.
PART_ROWS = 2_000_000


def project_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the named columns; a missing one fails before any job runs."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    return df.select(*columns)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns; absent ones are ignored."""
    return df.drop(*columns)


def align_schema(df: DataFrame, like: DataFrame) -> DataFrame:
    """Cast to the column names, order and types of ``like``.

    Casts are ANSI casts: a value that does not fit raises.
    """
    if set(df.columns) != set(like.columns):
        raise ValueError(f"columns differ: {sorted(df.columns)} and {sorted(like.columns)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema])


def running_total(
    df: DataFrame,
    *,
    order: Sequence[str],
    by: Sequence[str] = (),
    value: Column | None = None,
    start: str = "start",
    total: str = "total",
    small_rows: int = SMALL_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the group, and the
    group's sum.

    ``by`` + ``order`` must be unique.  Only the keys are sorted, and never an
    unbounded group of them in one task.  Few rows: one window per group, and
    the result is broadcast back, so the payload does not move.  Many rows: the
    keys are range-partitioned (a hot group spreads over many partitions),
    summed per partition, and shifted by the sums of the partitions before; the
    payload moves once, by its unique key.
    """
    by, order = list(by), list(order)
    value = F.lit(1) if value is None else value
    keys = df.select(*by, *order, value.cast("bigint").alias("_v"))
    n_rows = keys.count()
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    zero = F.lit(0).cast("bigint")
    if n_rows <= small_rows:
        before = group.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        placed = keys.select(
            *by, *order, F.coalesce(F.sum("_v").over(before), zero).alias(start), F.sum("_v").over(group).alias(total)
        )
        return _join_back(df, F.broadcast(placed), [*by, *order], [start, total])

    parts = max(2, math.ceil(n_rows / part_rows))
    ranged = keys.repartitionByRange(parts, *by, *order).withColumn("_part", F.spark_partition_id())
    # Stored, because partition numbers may change when a lost task is redone.
    ranged = stored(ranged, "running-total")
    inside = W.partitionBy("_part", *by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("_v").over(inside), zero))
    # One row per (group, partition): at most partitions + groups rows.
    sums = ranged.groupBy("_part", *by).agg(F.sum("_v").alias("_sum"))
    earlier = group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = sums.select(
        "_part", *by, F.coalesce(F.sum("_sum").over(earlier), zero).alias("_shift"), F.sum("_sum").over(group).alias(total)
    )
    shifted = _join_back(local, shifts, ["_part", *by], ["_shift", total])
    placed = shifted.select(*by, *order, (F.col("_local") + F.col("_shift")).alias(start), total)
    return _join_back(df, placed, [*by, *order], [start, total])


def _join_back(df: DataFrame, found: DataFrame, keys: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Bring ``new`` columns back to the rows of ``df``; null keys match too."""
    renamed = {k: f"_key_{i}" for i, k in enumerate(keys)}
    right = found.select(*[F.col(k).alias(r) for k, r in renamed.items()], *new)
    same = [df[k].eqNullSafe(right[r]) for k, r in renamed.items()]
    return df.join(right, same).select(*[df[c] for c in df.columns], *new)


def with_row_index(
    df: DataFrame,
    *,
    order: Sequence[str],
    by: Sequence[str] = (),
    out: str = "row_idx",
    total: str = "n_rows",
    **limits: int,
) -> DataFrame:
    """Add a dense zero-based row number per group and the group's row count."""
    return running_total(df, order=order, by=by, start=out, total=total, **limits)


def explode_pieces(
    df: DataFrame,
    *,
    key: Sequence[str],
    by: Sequence[str] = ("source",),
    text: str = "text",
    sample_by: str = "line",
    keep_linebreaks: bool = False,
) -> DataFrame:
    """A table of texts as lines, paragraphs or documents, numbered per group.

    The numbers are summed over the texts, not over their pieces.  Returns the
    group, the key, ``piece_no``, ``text``, ``row_idx`` and ``n_rows``.
    """
    by, key = list(by), list(key)
    texts = df.select(*by, *key, F.col(text).alias("_text"))
    count = count_pieces(F.col("_text"), sample_by)
    placed = running_total(texts, order=key, by=by, value=count, start="_first", total="n_rows")
    pieces = text_pieces(F.col("_text"), sample_by, keep_linebreaks)
    rows = placed.select(*by, *key, "_first", "n_rows", F.posexplode(pieces).alias("piece_no", "text"))
    return rows.select(
        *by,
        *key,
        F.col("piece_no").cast("bigint").alias("piece_no"),
        "text",
        (F.col("_first") + F.col("piece_no")).alias("row_idx"),
        "n_rows",
    )


def limit_rows(df: DataFrame, n: int, *, index: str = "row_idx") -> DataFrame:
    """The first ``n`` rows by row number, fewer if there are fewer."""
    return df.where(F.col(index) < n)


def row_at(df: DataFrame, i: int, *, index: str = "row_idx") -> DataFrame:
    """The ``i``-th row; no row if ``i`` is too large."""
    return df.where(F.col(index) == i)


def preview(df: DataFrame, n: int = 10, *, order: Sequence[str] = ("row_idx",)) -> DataFrame:
    """The first ``n`` rows in order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)
