"""Exact sampling, weighting, mixing, shuffling and splitting.

Random order is the order of a seeded md5 over the row's unique key, so a
result depends on seed and keys alone, not on partitions.  An exact sample is
"all rows up to the k-th smallest hash": the k-th hash is found on the keys
only (a 65,536-bucket histogram, then the one bucket it falls into), and the
payload is merely filtered.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blockloom.functions.hashing import hash_bucket, seeded_hash
from blockloom.operators.rows import align_schema, with_row_index

#: Fixed value: the seed of every sampling step unless told otherwise.
SEED = 1234
#: Rows per partition where rows are placed anew.
PART_ROWS = 1_000_000
#: Up to this many groups, a table of one row per group is broadcast.
FEW_GROUPS = 100_000


def shuffle(df: DataFrame, *, key: Sequence[str], seed: int = SEED, out: str = "row_idx") -> DataFrame:
    """A seeded permutation: ``out`` is the row's place in it."""
    hashed = df.withColumn("_h", seeded_hash(key, seed))
    return with_row_index(hashed, order=["_h", *key], out=out, total="_n").drop("_h", "_n")


def _cuts(keys: DataFrame, key: list[str], wanted: DataFrame, few_groups: bool) -> DataFrame:
    """Per group ``_g`` the hash and key of its ``_k``-th row.

    ``keys`` holds ``_g``, ``key`` and ``_h``; ``wanted`` holds ``_g`` and
    ``_k``.  With few groups not even the keys move, but for the counts and
    the one bucket per group.
    """
    bucketed = keys.withColumn("_b", hash_bucket(F.col("_h")))
    histogram = bucketed.groupBy("_g", "_b").agg(F.count("*").alias("_c"))
    # At most 65,536 rows per group, however large the group.
    upto = W.partitionBy("_g").orderBy("_b").rowsBetween(W.unboundedPreceding, 0)
    running = histogram.withColumn("_upto", F.sum("_c").over(upto)).join(wanted, "_g")
    edge = running.where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_c") < F.col("_k"))).select(
        "_g", "_b", (F.col("_k") - F.col("_upto") + F.col("_c")).alias("_need")
    )
    # Only the bucket the cut falls into is ranked: 1/65,536 of a group.
    inside = W.partitionBy("_g").orderBy("_h", *key)
    ranked = bucketed.join(F.broadcast(edge) if few_groups else edge, ["_g", "_b"])
    at = ranked.withColumn("_r", F.row_number().over(inside)).where(F.col("_r") == F.col("_need"))
    return at.select("_g", F.col("_h").alias("_cut_h"), F.struct(*key).alias("_cut_key"))


def _flag_first_k(
    df: DataFrame, by: list[str], key: list[str], seed: int, wanted: DataFrame, few_groups: bool, among=None
) -> DataFrame:
    """Add ``_in``: whether a row is among its group's first ``_k`` by hash.

    Groups are compared as structs, so a null group is one like any other.
    """
    group = F.struct(*by).alias("_g")
    keys = (df if among is None else df.where(among)).select(group, *key, seeded_hash(key, seed).alias("_h"))
    cuts = _cuts(keys, key, wanted.select(group, "_k"), few_groups)
    if few_groups:
        # One row per group, found once: the result is a mere filter, and no
        # row of the payload moves for it, however large its group.
        cuts = F.broadcast(df.sparkSession.createDataFrame(cuts.collect(), cuts.schema))
    marked = df.select("*", group, seeded_hash(key, seed).alias("_h")).join(cuts, "_g", "left")
    below = F.struct(F.col("_h").alias("h"), F.struct(*key).alias("k")) <= F.struct(
        F.col("_cut_h").alias("h"), F.col("_cut_key").alias("k")
    )
    return marked.withColumn("_in", F.coalesce(below, F.lit(False))).drop("_g", "_h", "_cut_h", "_cut_key")


def _are_few(groups: DataFrame) -> bool:
    return groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS


def _flag_whole(df: DataFrame, key: list[str], seed: int, k: int) -> DataFrame:
    """As :func:`_flag_first_k` for one group: the cut is one row of values."""
    keys = df.select(F.lit(0).alias("_g"), *key, seeded_hash(key, seed).alias("_h"))
    wanted = df.sparkSession.range(1).select(F.lit(0).alias("_g"), F.lit(k).cast("bigint").alias("_k"))
    cut = _cuts(keys, key, wanted, True).first()
    if cut is None:
        return df.withColumn("_in", F.lit(False))
    hashed = seeded_hash(key, seed)
    last = F.struct(*[F.lit(cut["_cut_key"][c]).cast(df.schema[c].dataType).alias(c) for c in key])
    below = (hashed < cut["_cut_h"]) | ((hashed == cut["_cut_h"]) & (F.struct(*key) <= last))
    return df.withColumn("_in", below)


def exact_sample(
    df: DataFrame,
    *,
    key: Sequence[str],
    k: int | None = None,
    frac: float | None = None,
    by: Sequence[str] = (),
    seed: int = SEED,
) -> DataFrame:
    """Exactly ``k`` rows, or ``ceil(n * frac)`` rows, without replacement,
    per group of ``by``; all rows of a group that has no more."""
    if (k is None) == (frac is None):
        raise ValueError("give either k or frac")
    by, key = list(by), list(key)
    if by:
        n = F.count("*")
        size = F.lit(k) if k is not None else F.ceil(n * F.lit(float(frac)))
        wanted = df.groupBy(*by).agg(F.least(size.cast("bigint"), n).alias("_k"))
        flagged = _flag_first_k(df, by, key, seed, wanted, _are_few(wanted))
    else:
        n = df.count()
        flagged = _flag_whole(df, key, seed, min(n, k if k is not None else math.ceil(n * frac)))
    return flagged.where("_in").drop("_in")


def upsample(df: DataFrame, k: int) -> DataFrame:
    """Every row ``k`` times, told apart by ``copy_no`` from 1 to ``k``."""
    if int(k) != k or k < 1:
        raise ValueError(f"a repetition count must be a positive integer, not {k}")
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(k)))).alias("copy_no"))


def check_weight(weight: float) -> float:
    """A share in (0, 1] or a whole number of repetitions."""
    if 0 < weight <= 1 or (weight >= 2 and int(weight) == weight):
        return weight
    raise ValueError(f"a weight must lie in (0, 1] or be an integer of at least 2, not {weight}")


def concat_sources(sources: Sequence[DataFrame] | Mapping[str, DataFrame]) -> DataFrame:
    """All rows of all sources, duplicates kept, in the first source's schema.

    A mapping adds its names as the column ``source``.
    """
    if isinstance(sources, Mapping):
        sources = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    first = sources[0]
    return reduce(DataFrame.unionByName, [first, *[align_schema(df, first) for df in sources[1:]]])


def mix(
    df: DataFrame,
    weights: Mapping[str, float],
    *,
    key: Sequence[str],
    seed: int = SEED,
    source: str = "source",
    default: float | None = None,
    leave_out: bool = False,
) -> DataFrame:
    """Weight the sources of one table: a share below 1 samples exactly
    ``ceil(n * share)`` rows, a whole number repeats every row.

    Sources without a weight get ``default``; without one they raise, or with
    ``leave_out`` are left out.  Adds ``copy_no``.  One pass over all sources; the weights are a small table.
    """
    weights = {name: float(check_weight(w)) for name, w in weights.items()}
    if default is not None:
        check_weight(default)
    spark = df.sparkSession
    table = spark.createDataFrame(list(weights.items()), f"{source} string, _weight double")
    how = "inner" if leave_out and default is None else "left"
    weighted = df.join(F.broadcast(table) if len(weights) <= FEW_GROUPS else table, source, how)
    if default is not None:
        weighted = weighted.withColumn("_weight", F.coalesce("_weight", F.lit(float(default))))
    elif not leave_out:
        unknown = F.raise_error(F.concat(F.lit("no weight for source "), F.coalesce(F.col(source).cast("string"), F.lit("null"))))
        weighted = weighted.withColumn("_weight", F.coalesce("_weight", unknown.cast("double")))
    wanted = (
        weighted.where(F.col("_weight") < 1)
        .groupBy(source)
        .agg(F.count("*").alias("_n"), F.first("_weight").alias("_w"))
        .select(source, F.ceil(F.col("_n") * F.col("_w")).cast("bigint").alias("_k"))
    )
    # Only sources with a share need a cut; unless the default is a share, the
    # caller's list bounds them.
    listed = default is None or default >= 1
    few = len(weights) <= FEW_GROUPS if listed else _are_few(wanted)
    flagged = _flag_first_k(weighted, [source], list(key), seed, wanted, few, among=F.col("_weight") < 1)
    copies = F.greatest(F.lit(1), F.col("_weight").cast("int"))
    return (
        flagged.where((F.col("_weight") >= 1) | F.col("_in"))
        .select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy_no"))
        .drop("_weight", "_in")
    )


def _test_rows(n: int, test: float | int | None) -> int:
    """How many of ``n`` rows are ``test``."""
    if test is None:
        return 0
    if isinstance(test, float):
        if not 0 < test < 1:
            raise ValueError(f"a test share must lie between 0 and 1, not {test}")
        k = math.ceil(n * test)
    else:
        k = test
    if not 0 < k < n:
        raise ValueError(f"{k} test rows out of {n} leave one side empty")
    return k


def split(df: DataFrame, *, test: float | int | None, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """Add ``split``: exactly the wanted share or number of rows is ``test``,
    the rest ``train``; without a wish all rows are ``train``.

    The key must tell repeated rows apart (include ``copy_no``).
    """
    if test is None:
        return df.withColumn("split", F.lit("train"))
    flagged = _flag_whole(df, list(key), seed, _test_rows(df.count(), test))
    return flagged.withColumn("split", F.when(F.col("_in"), "test").otherwise("train")).drop("_in")


def split_and_shuffle(
    df: DataFrame, *, test: float | int | None, key: Sequence[str], seed: int = SEED, out: str = "place", part_rows: int = PART_ROWS
) -> DataFrame:
    """:func:`split` and :func:`shuffle` of each side, with one exchange of the rows.

    Both follow the same seeded hash, so one rank gives the split (the first
    rows are ``test``) and the place in it.  Ranks are the counts of the hash's
    65,536 buckets summed up, from the keys alone, and the place in the bucket.
    The counts also say which buckets make a partition of about ``part_rows``
    rows.  Rows lie in rank order, within and across partitions.
    """
    key = list(key)
    hashed = seeded_hash(key, seed)
    buckets = sorted(tuple(r) for r in df.select(hash_bucket(hashed).alias("_b")).groupBy("_b").count().collect())
    n = sum(c for _, c in buckets)
    k = _test_rows(n, test)
    spark = df.sparkSession
    rows = max(1, min(part_rows, math.ceil(n / int(spark.conf.get("spark.sql.shuffle.partitions")))))
    table, base = [], 0
    for bucket, count in buckets:
        table.append((bucket, base, base // rows))
        base += count
    parts = table[-1][2] + 1 if table else 1
    # At most 65,536 rows, whatever the input.
    places = F.broadcast(spark.createDataFrame(table, "_b string, _base bigint, _part int"))
    marked = df.withColumn("_h", hashed).withColumn("_b", hash_bucket(F.col("_h"))).join(places, "_b")
    inside = W.partitionBy("_part", "_b").orderBy("_h", *key)
    ranked = marked.repartitionById(parts, F.col("_part")).withColumn("_rank", F.col("_base") + F.row_number().over(inside) - 1)
    is_test = F.col("_rank") < k
    return ranked.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.when(is_test, "test").otherwise("train").alias("split"),
        (F.col("_rank") - F.when(is_test, 0).otherwise(k)).cast("bigint").alias(out),
    )


def leaked_copies(df: DataFrame, *, key: Sequence[str]) -> DataFrame:
    """How many rows have copies on both sides of the split.

    Repeating precedes splitting, so copies of one row can land on both.
    """
    sides = df.groupBy(*key).agg(F.count_distinct("split").alias("_sides"))
    return sides.where(F.col("_sides") > 1).agg(F.count("*").alias("n_leaked"))
