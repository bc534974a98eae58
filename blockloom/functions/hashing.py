"""Seeded ordering by hash, independent of partitioning and of the engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(key: Sequence[str], seed: int) -> Column:
    """md5 of the seed and the key columns joined by colons."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def hash_bucket(hashed: Column) -> Column:
    """The first four hex digits: 65,536 buckets in hash order."""
    return F.substring(hashed, 1, 4)
