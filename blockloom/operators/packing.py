"""Packing token rows into blocks of one size.

Rows of a scope are read as one token stream in row order and cut into blocks.
The remainder of a scope is dropped, but a scope shorter than one block keeps
its one short block.  Nothing is ever concatenated whole: each row yields one
fragment per block it touches, and only a block's fragments meet again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blockloom.operators.rows import running_total
from blockloom.session import stored

#: Scopes of at most this many rows are summed by a plain window.
SCOPE_ROWS = 100_000


def with_scope(
    df: DataFrame,
    *,
    workers: int = 32,
    batch_rows: int = 1000,
    index: str = "row_idx",
    total: str = "n_rows",
) -> DataFrame:
    """Add the worker shard and the batch a row falls into.

    Shards are contiguous and as even as possible, the longer ones first; with
    fewer rows than workers there are as many shards as rows.
    """
    idx, n = F.col(index), F.col(total)
    used = F.least(F.lit(workers).cast("bigint"), n)
    size, longer = F.floor(n / used), n % used
    edge = longer * (size + 1)
    in_long = idx < edge
    shard = F.when(in_long, F.floor(idx / (size + 1))).otherwise(longer + F.floor((idx - edge) / size))
    in_shard = F.when(in_long, idx % (size + 1)).otherwise((idx - edge) % size)
    return df.select(
        "*", shard.cast("bigint").alias("shard"), F.floor(in_shard / batch_rows).cast("bigint").alias("batch")
    )


def _fragments(block: int, ids: str, keep_tail: bool) -> Column:
    """Per row: (block number, offset of the fragment, its tokens)."""
    size = F.lit(block).cast("bigint")
    start, end, total = F.col("_start"), F.col("_end"), F.col("_total")

    def piece(number: Column, first: Column, last: Column) -> Column:
        low, high = F.greatest(start, first), F.least(end, last)
        part = F.slice(ids, (low - start + 1).cast("int"), (high - low).cast("int"))
        return F.struct(number.alias("block"), low.alias("low"), part.alias("part"))

    kept = F.col("_kept")
    first_block = F.floor(start / size).cast("bigint")
    last_block = F.floor((F.least(end, kept) - 1) / size).cast("bigint")
    regular = F.transform(
        F.sequence(first_block, last_block), lambda b: piece(b, b * size, F.least((b + 1) * size, kept))
    )
    none = F.slice(F.array(piece(start, start, start)), 1, 0)
    pieces = F.when(start < kept, regular).otherwise(none)
    if not keep_tail:
        return pieces
    number = F.ceil(kept / size).cast("bigint")
    tail_from = F.greatest(total - size, F.lit(0).cast("bigint"))
    in_tail = (total % size != 0) & (end > tail_from)
    return F.concat(pieces, F.when(in_tail, F.array(piece(number, tail_from, total))).otherwise(none))


def pack_blocks(
    df: DataFrame,
    *,
    block_size: int,
    scope: Sequence[str],
    order: Sequence[str] = ("row_idx",),
    ids: str = "input_ids",
    keep_tail: bool = False,
    scope_rows: int | None = None,
) -> DataFrame:
    """Blocks of ``block_size`` tokens per scope: the scope, ``block``, the ids.

    ``scope_rows`` states how many rows a scope can hold at most (the batch
    size, say); without it, or beyond 100,000 rows, the offsets come from a
    distributed running total over the stored rows.  ``keep_tail`` adds the
    last ``block_size`` tokens of a scope that leaves a remainder.
    """
    scope, order = list(scope), list(order)
    rows = df.select(*scope, *order, ids)
    length = F.size(ids).cast("bigint")
    if scope_rows is not None and scope_rows <= SCOPE_ROWS:
        group = W.partitionBy(*scope)
        before = group.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        placed = rows.select(
            "*",
            F.coalesce(F.sum(length).over(before), F.lit(0)).cast("bigint").alias("_start"),
            F.sum(length).over(group).alias("_total"),
        )
    else:
        rows = stored(rows, "token-rows")
        placed = running_total(rows, order=order, by=scope, value=length, start="_start", total="_total")
    placed = placed.where(length > 0).select(
        *scope,
        ids,
        "_start",
        (F.col("_start") + length).alias("_end"),
        "_total",
        F.when(F.col("_total") >= block_size, F.floor(F.col("_total") / block_size) * block_size)
        .otherwise(F.col("_total"))
        .cast("bigint")
        .alias("_kept"),
    )
    return _joined(placed, scope, ids, block_size, keep_tail)


def _joined(placed: DataFrame, scope: list[str], ids: str, block_size: int, keep_tail: bool = False) -> DataFrame:
    """Rows with their offsets to blocks."""
    fragments = placed.select(*scope, F.explode(_fragments(block_size, ids, keep_tail)).alias("_f"))
    fragments = fragments.select(*scope, "_f.block", F.struct("_f.low", "_f.part").alias("_piece"))
    blocks = fragments.groupBy(*scope, "block").agg(F.sort_array(F.collect_list("_piece")).alias("_pieces"))
    return blocks.select(*scope, "block", F.flatten(F.transform("_pieces", lambda p: p["part"])).alias(ids))


def pack_arrivals(
    df: DataFrame, carried: DataFrame, *, block_size: int, scope: Sequence[str], order: Sequence[str], ids: str = "input_ids"
) -> tuple[DataFrame, DataFrame]:
    """Pack what has arrived behind what earlier arrivals left over.

    ``carried`` holds, per scope, ``n_blocks`` (blocks made so far) and ``tail``
    (fewer tokens than a block).  Returns the new complete blocks, numbered on,
    and what is carried next, scopes without arrivals included.
    """
    scope, order = list(scope), list(order)
    rows = stored(df.select(*scope, *order, ids), "arrived-rows")
    length = F.size(ids).cast("bigint")
    placed = running_total(rows, order=order, by=scope, value=length, start="_start", total="_total")
    zero = F.lit(0).cast("bigint")
    # One row a scope, never more tokens than a block in it.
    before = carried.select(*scope, F.size("tail").cast("bigint").alias("_carried"))
    moved = placed.where(length > 0).join(before, scope, "left").withColumn("_carried", F.coalesce("_carried", zero))
    new = moved.select(
        *scope,
        ids,
        (F.col("_start") + F.col("_carried")).alias("_start"),
        (F.col("_start") + F.col("_carried") + length).alias("_end"),
        (F.col("_total") + F.col("_carried")).alias("_total"),
    )
    totals = rows.groupBy(*scope).agg(F.sum(length).alias("_new"))
    old = carried.join(totals, scope).where((F.size("tail") > 0) & (F.col("_new") > 0))
    size = F.size("tail").cast("bigint")
    head = old.select(*scope, F.col("tail").alias(ids), zero.alias("_start"), size.alias("_end"), (size + F.col("_new")).alias("_total"))
    whole = new.unionByName(head).withColumn("_kept", F.col("_total"))
    packed = stored(_joined(whole, scope, ids, block_size), "arrived-blocks")
    full = F.size(ids) == block_size
    made = packed.groupBy(*scope).agg(F.count_if(full).alias("_made"), F.max(F.when(~full, F.col(ids))).alias("_left"))
    numbers = carried.select(*scope, F.col("n_blocks").alias("_before"))
    blocks = packed.where(full).join(numbers, scope, "left").select(
        *scope, (F.col("block") + F.coalesce("_before", zero)).alias("block"), ids
    )
    nothing = F.array().cast(packed.schema[ids].dataType)
    after = carried.join(made, scope, "full").select(
        *scope,
        (F.coalesce("n_blocks", zero) + F.coalesce("_made", zero)).alias("n_blocks"),
        F.when(F.col("_made").isNull(), F.col("tail")).otherwise(F.coalesce("_left", nothing)).alias("tail"),
    )
    return blocks, after


def copy_labels(df: DataFrame, *, ids: str = "input_ids") -> DataFrame:
    """Labels equal to the ids, as 32-bit integers."""
    return df.withColumn("labels", F.col(ids).cast("array<int>"))


def pack_loss(before: DataFrame, after: DataFrame, *, by: Sequence[str] = ("source",), ids: str = "input_ids") -> DataFrame:
    """Tokens before and after packing, per source."""
    tokens = F.sum(F.size(ids).cast("bigint"))
    first = before.groupBy(*by).agg(tokens.alias("tokens_in"))
    second = after.groupBy(*by).agg(tokens.alias("tokens_kept"), F.count("*").alias("n_blocks"))
    zero = F.lit(0).cast("bigint")
    return first.join(second, list(by), "left").select(
        *by,
        "tokens_in",
        F.coalesce("n_blocks", zero).alias("n_blocks"),
        F.coalesce("tokens_kept", zero).alias("tokens_kept"),
        (F.col("tokens_in") - F.coalesce("tokens_kept", zero)).alias("tokens_lost"),
    )
