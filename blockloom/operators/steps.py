"""Arrow batches in steps of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text or elements of lists that the array code works on at a time; a longer row is a step of its own.
STEP = 1 << 19


def steps(limit: int | None = None) -> Callable[[Iterator], Iterator]:
    """Cuts Arrow batches (one column, or a tuple) into runs of rows of about ``limit``
    bytes or elements, so that what a worker holds follows neither a batch's rows nor their lengths."""
    limit = STEP if limit is None else limit

    def lengths(column: pa.Array) -> np.ndarray:
        nested = pa.types.is_list(column.type) or pa.types.is_large_list(column.type)
        n = pc.list_value_length(column) if nested else pc.binary_length(column)
        return pc.fill_null(n, 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def cut(batches: Iterator) -> Iterator:
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            ends = np.cumsum(sum(map(lengths, columns)))
            at = 0
            while at < len(ends):
                before = ends[at - 1] if at else 0
                end = max(int(np.searchsorted(ends, before + limit, side="right")), at + 1)
                yield tuple(c.slice(at, end - at) for c in columns) if isinstance(batch, tuple) else batch.slice(at, end - at)
                at = end

    return cut
