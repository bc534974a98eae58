"""Arithmetic over tables of keyed float vectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.functions.arrays import to_half

#: Factor tables with more elements than this are not broadcast.
BROADCAST_ELEMENTS = 8_000_000
SALTS = 16


def _zero_padded(v: Column, length: Column) -> Column:
    missing = F.greatest(length - F.size(v), F.lit(0))
    return F.concat(v, F.array_repeat(F.lit(0.0).cast("float"), missing))


def vector_arith(
    src: DataFrame,
    tgt: DataFrame,
    *,
    op: str,
    key: Sequence[str] = ("key",),
    v: str = "v",
    width: str | None = None,
    pad_keys: Sequence[str] = (),
) -> DataFrame:
    """Per key ``source - target`` or ``source + target`` in 32-bit floats.

    A key only in the source passes unchanged, one only in the target is
    dropped.  For keys named in ``pad_keys`` (values of the first key column)
    the shorter vector gets zeros at its end.  With ``width``, a column of row
    widths, vectors are matrices laid out row by row, and rows of different
    width leave the source unchanged.  Other sizes that differ raise.
    """
    if op not in ("+", "-"):
        raise NotImplementedError(f"operation {op!r}")
    key = list(key)
    other = tgt.select(*key, F.col(v).alias("_t"), *([F.col(width).alias("_tw")] if width else []))
    both = src.join(other, key, "left")
    a, b = F.col(v), F.col("_t")
    longest = F.greatest(F.size(a), F.size(b))
    paddable = F.col(key[0]).cast("string").isin(*[str(k) for k in pad_keys]) if pad_keys else F.lit(False)
    same_width = F.col(width) == F.col("_tw") if width else F.lit(True)
    same = (F.size(a) == F.size(b)) & same_width

    def combined(x: Column, y: Column) -> Column:
        x, y = x.cast("array<float>"), y.cast("array<float>")
        return F.zip_with(x, y, (lambda p, q: p + q) if op == "+" else (lambda p, q: p - q))

    size_error = F.raise_error(
        F.concat(F.lit("vectors differ in size for key "), F.concat_ws(",", *[F.col(k).cast("string") for k in key]))
    )
    out_type = src.schema[v].dataType
    result = (
        F.when(b.isNull(), a)
        .when(same, combined(a, b).cast(out_type))
        .when(paddable & same_width, combined(_zero_padded(a, longest), _zero_padded(b, longest)).cast(out_type))
        .when(paddable, a)
        .otherwise(size_error.cast(out_type))
    )
    return both.select(*[result.alias(v) if c == v else F.col(c) for c in src.columns])


def low_rank_update(
    weights: DataFrame,
    a: DataFrame,
    b: DataFrame,
    *,
    scale: float,
    replacement: DataFrame | None = None,
    transpose: bool = False,
    broadcast_elements: int = BROADCAST_ELEMENTS,
) -> DataFrame:
    """``W + scale * (B @ A)`` per key, on matrices stored as rows.

    ``weights(key, i, v)``; ``a(key, k, v)`` with one row per rank;
    ``b(key, i, v)`` with one row of rank length per row of ``W``.  With
    ``transpose`` the product is transposed, so ``a`` and ``b`` swap roles:
    column ``k`` of ``b`` then multiplies entry ``i`` of ``a``'s row ``k``.
    A ``replacement(key, i, v)`` takes the place of ``W`` first.  Keys without
    factors keep their weights.  The rank is narrow, so each weight row meets
    its key's whole wide factor in one record.
    """
    if transpose:
        # (B @ A)^T = A^T @ B^T: rows of the left factor are columns of A.
        left = _columns_as_rows(a, "k", "j").withColumnRenamed("j", "i")
        wide = _columns_as_rows(b, "i", "j").withColumnRenamed("j", "k")
    else:
        left, wide = b, a
    base = weights
    if replacement is not None:
        # Replacing matrices are taken in half precision.
        new = replacement.select("key", "i", to_half(F.col("v")).alias("_new"))
        base = base.join(new, ["key", "i"], "left").select("key", "i", F.coalesce("_new", "v").alias("v"))
    rows = base.join(left.select("key", "i", F.col("v").alias("_l")), ["key", "i"], "left")
    factor = wide.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("_w"))
    elements = wide.agg(F.sum(F.size("v"))).first()[0] or 0
    if elements <= broadcast_elements:
        joined = rows.join(F.broadcast(factor), "key", "left")
    else:
        # A large matrix holds many rows under one key: spread them.
        salted = rows.withColumn("_salt", F.pmod(F.hash("i"), F.lit(SALTS)))
        copies = factor.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies, ["key", "_salt"], "left").drop("_salt")
    # Rank by rank: acc + l[k] * A[k], element-wise in 32-bit floats.
    pairs = F.zip_with("_l", "_w", lambda x, w: F.struct(x.cast("float").alias("x"), w["v"].alias("row")))
    zeros = F.transform("v", lambda _: F.lit(0.0).cast("float"))
    product = F.aggregate(
        pairs,
        zeros,
        lambda acc, p: F.zip_with(acc, p["row"], lambda s, e: s + p["x"] * e),
    )
    factor_of = F.lit(scale).cast("float")
    updated = F.zip_with("v", product, lambda w, d: w + d * factor_of)
    has_both = F.col("_l").isNotNull() & F.col("_w").isNotNull()
    return joined.select("key", "i", F.when(has_both, updated).otherwise(F.col("v")).alias("v"))


def _columns_as_rows(df: DataFrame, row: str, column: str) -> DataFrame:
    """Transpose matrices stored as rows: one row per former column."""
    cells = df.select("key", row, F.posexplode("v").alias(column, "_e"))
    turned = cells.groupBy("key", column).agg(F.sort_array(F.collect_list(F.struct(row, "_e"))).alias("_c"))
    return turned.select("key", column, F.transform("_c", lambda c: c["_e"]).alias("v"))


def keyed_last_wins(tables: Sequence[DataFrame], *, key: str = "key", v: str = "v") -> DataFrame:
    """Several key -> vector tables as one; later tables overwrite earlier."""
    ordered = [df.select(key, v, F.lit(n).alias("_order")) for n, df in enumerate(tables)]
    merged = reduce(DataFrame.unionByName, ordered)
    return merged.groupBy(key).agg(F.max_by(v, "_order").alias(v))


def size_total(df: DataFrame, *, v: str = "v", bytes_per_element: int = 4) -> DataFrame:
    """Bytes of all vectors together."""
    elements = F.sum(F.size(v).cast("bigint"))
    return df.agg(elements.alias("n_elements"), (elements * bytes_per_element).alias("n_bytes"))
