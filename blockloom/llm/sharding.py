"""Uniform shuffle into shards of exact size.

How many rows go from each input partition to each shard is drawn first, from
the multivariate hypergeometric distribution that a uniform shuffle follows
given the shards' sizes. Then every partition permutes its rows and deals them
out by its row of that matrix, rows are exchanged, and every shard permutes what
it got. Only counts reach the driver: one number per partition.

Only DataFrame functions are used; no row leaves the JVM.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from blockloom.llm.common import keep

SHARDS = 8
SEED = 17
#: Rows that one window group sorts, on average.
GROUP_ROWS = 20_000


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows from each partition to each shard: shard sizes differ by one at
    most, and a partition's row is drawn without replacement from the places
    still free."""
    total = sum(counts)
    free = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    draw = np.random.default_rng(seed)
    matrix = []
    for n in counts:
        row = []
        left, rest = int(n), int(free.sum())
        for s in range(shards):
            rest -= int(free[s])
            take = _hypergeometric(draw, int(free[s]), rest, left)
            row.append(take)
            left -= take
        free -= np.array(row, np.int64)
        matrix.append(row)
    return matrix


def _hypergeometric(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    if not n or not good:
        return 0
    if not bad:
        return n
    if good + bad < 10**9:
        return int(draw.hypergeometric(good, bad, n))
    # beyond the generator's range: split the draw, which keeps the distribution exact
    half = n // 2
    if n <= 1:
        return int(draw.integers(good + bad) < good)
    if n < 10**4:
        taken = 0
        for i in range(n):
            taken += int(draw.integers(good + bad - i) < good - taken)
        return taken
    first = _hypergeometric(draw, good, bad, half)
    return first + _hypergeometric(draw, good - first, bad - (half - first), n - half)


def shuffle_into_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: shard sizes differ by one at most,
    slots count from 0 without gaps, and every arrangement is equally likely.

    All rows take part, nulls and repeated rows included; of an empty table
    nothing is returned. Rows are stored once with their partition and place, so
    a recomputed task deals them out as before. An input that has columns named
    ``shard`` or ``slot`` gets them replaced.
    """
    own = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    partition = f"_p{seed}"
    numbered = keep(
        rows.select(*own).withColumn("_row", F.monotonically_increasing_id()), "rows-to-shard"
    ).withColumn(partition, F.shiftright("_row", 33))
    counted = numbered.groupBy(partition).agg(F.count("*").alias("n")).orderBy(partition).collect()
    if not counted:
        return numbered.select(*own, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    matrix = communication_matrix([r.n for r in counted], shards, seed)
    ends = np.cumsum(np.array(matrix), axis=1).tolist()
    spark = rows.sparkSession
    dealt = spark.createDataFrame(
        [(r[partition], *e) for r, e in zip(counted, ends, strict=True)], f"of long, {', '.join(f'e{s} long' for s in range(shards))}"
    )
    # the local permutation: places in the order of a random number per row
    key = F.xxhash64(F.lit(seed), F.col("_row"))
    placed = _places(numbered, [partition], key, "_place", {r[partition]: r.n for r in counted})
    shard = sum((F.col("_place") >= F.col(f"e{s}")).cast("int") for s in range(shards - 1)) if shards > 1 else F.lit(0)
    at_shard = placed.join(dealt, F.col(partition) == F.col("of")).select(*own, "_row", shard.alias("shard"))
    sizes = {s: sum(row[s] for row in matrix) for s in range(shards)}
    again = F.xxhash64(F.lit(seed + 1), F.col("_row"))
    return _places(at_shard, ["shard"], again, "slot", sizes).select(*own, "shard", "slot")


def _places(rows: DataFrame, group: list[str], key: Column, name: str, sizes: dict[int, int]) -> DataFrame:
    """Places from 0 within each group in the order of ``key``. Large groups are
    cut by the key's leading bits, so that no task sorts a whole group."""
    cuts = 1
    while cuts * GROUP_ROWS < max(sizes.values()):
        cuts *= 2
    cut = F.shiftrightunsigned(key, 64 - (cuts.bit_length() - 1)) if cuts > 1 else F.lit(0).cast("long")
    # ordered as the signed key's bits are: leading bits first, then the unsigned rest
    keyed = rows.withColumn("_key", key).withColumn("_cut", cut)
    before = F.sum("_n").over(W.partitionBy(*group).orderBy("_cut").rowsBetween(W.unboundedPreceding, -1))
    starts = keyed.groupBy(*group, "_cut").agg(F.count("*").alias("_n")).select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), F.col("_cut").alias("_c"), F.coalesce(before, F.lit(0)).alias("_start"))
    within = F.row_number().over(W.partitionBy(*group, "_cut").orderBy("_key", "_row")) - 1
    on = F.col("_cut") == F.col("_c")
    for i, g in enumerate(group):
        on = on & (F.col(g) == F.col(f"_g{i}"))
    return keyed.withColumn("_within", within).join(starts, on).withColumn(name, (F.col("_start") + F.col("_within")).cast("long"))


def document_shards(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Documents by the ``rows`` law. Size: UTF-8 bytes of the text plus 1; a
    null text has none and the checksum of nothing. Texts stay where they are:
    only ids, sizes and checksums are exchanged."""
    text = F.coalesce("text", F.lit(""))
    digests = documents.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffle_into_shards(digests, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
