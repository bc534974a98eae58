"""User-supplied batch functions, a tokenizer for example."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    *,
    batch_rows: int = 1000,
    scope: Sequence[str] = (),
    order: Sequence[str] = ("row_idx",),
) -> DataFrame:
    """Apply ``fn`` to batches of at most ``batch_rows`` rows; it may return
    any number of rows of ``schema``.

    Without ``scope`` batches are cut from the partitions as they come, with
    no shuffle.  With the columns of :func:`packing.with_scope` as ``scope``
    each batch is exactly one scope in row order.
    """
    if scope:
        index = list(order)

        def one_scope(batch: pd.DataFrame) -> pd.DataFrame:
            return fn(batch.sort_values(index, ignore_index=True))

        return df.groupBy(*scope).applyInPandas(one_scope, schema)

    def cut(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            for at in range(0, len(chunk), batch_rows):
                yield fn(chunk.iloc[at : at + batch_rows].reset_index(drop=True))

    return df.mapInPandas(cut, schema)


__all__ = ["map_batches"]
