"""Shaping batches: padding, masks, labels for decoders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.functions import arrays as A
from blockloom.functions.text import IGNORE, PAD_ID


def with_batch_id(df: DataFrame, batch_size: int, *, index: str = "row_idx") -> DataFrame:
    """Consecutive rows share a batch; the last batch may be smaller."""
    return df.withColumn("batch_id", F.floor(F.col(index) / batch_size).cast("bigint"))


def pad_batches(
    df: DataFrame, *, batch_size: int, pad_id: int = PAD_ID, ignore: int = IGNORE, index: str = "row_idx"
) -> DataFrame:
    """Right-pad ids and labels to the longest row of their batch, and add the
    attention mask.  A window holds one batch, never more."""
    batch = W.partitionBy("batch_id")
    wide = with_batch_id(df, batch_size, index=index).select(
        "*",
        F.max(F.size("input_ids")).over(batch).alias("_ids_len"),
        F.max(F.size("labels")).over(batch).alias("_labels_len"),
    )
    others = [c for c in wide.columns if c not in ("input_ids", "labels", "_ids_len", "_labels_len")]
    padded = wide.select(
        *others,
        A.pad_right(F.col("input_ids"), F.col("_ids_len"), pad_id).alias("input_ids"),
        A.pad_right(F.col("labels"), F.col("_labels_len"), ignore).alias("labels"),
    )
    return padded.withColumn("attention_mask", A.attention_mask(F.col("input_ids"), pad_id))


def collate_first_on_ragged(
    df: DataFrame, *, batch_size: int, columns: tuple[str, ...] = ("input_ids",), index: str = "row_idx"
) -> DataFrame:
    """Where the rows of a batch differ in length in any of the columns, every
    row of that batch becomes its first row; even batches stay as they are."""
    batch = W.partitionBy("batch_id")
    first = batch.orderBy(index).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    numbered = with_batch_id(df, batch_size, index=index)
    ragged = F.lit(False)
    for c in columns:
        ragged = ragged | (F.min(F.size(c)).over(batch) != F.max(F.size(c)).over(batch))
    marked = numbered.select("*", ragged.alias("_ragged"), *[F.first(c).over(first).alias(f"_first_{c}") for c in columns])
    others = [c for c in numbered.columns if c not in columns]
    return marked.select(
        *others, *[F.when(F.col("_ragged"), F.col(f"_first_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )


def label_field(df: DataFrame) -> DataFrame:
    """``label`` as ``labels`` (whole numbers as bigint, others as float), else
    ``label_ids``; string columns are not collated."""
    types = {f.name: f.dataType for f in df.schema}
    kept = [c for c, t in types.items() if c not in ("label", "label_ids") and not isinstance(t, T.StringType)]
    for name in ("label", "label_ids"):
        if name not in types:
            continue
        inner = types[name].elementType if isinstance(types[name], T.ArrayType) else types[name]
        target = "bigint" if isinstance(inner, T.IntegralType) else "float"
        if isinstance(types[name], T.ArrayType):
            target = f"array<{target}>"
        return df.select(*kept, F.col(name).cast(target).alias("labels"))
    return df.select(*kept)


def labels_by_value(
    df: DataFrame, *, batch_size: int, columns: tuple[str, ...] = ("label", "label_ids"), index: str = "row_idx"
) -> DataFrame:
    """``batch_id``, ``labels`` and ``labels_kind``, the type decided batch by batch.

    Of ``columns`` (numbers, booleans or variants) a batch takes the first that
    has a value in it. Its first value, in the order of ``index``, makes the
    batch ``bigint`` (whole numbers and booleans; fractions are cut off) or
    ``float`` (rounded to single precision); ``labels`` holds both as double.
    Rows without a value in that column, SQL's or JSON's null, are left out, and
    so are values that are no number. String columns are not collated.
    """
    batch = W.partitionBy("batch_id")
    whole = batch.orderBy(index).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    types = {f.name: f.dataType for f in df.schema}
    given = [c for c in columns if c in types]
    values = []
    for c in given:
        if isinstance(types[c], T.VariantType):
            number, made = F.try_variant_get(c, "$", "double"), F.schema_of_variant(c)
            integral = made.isin("BIGINT", "BOOLEAN") | made.rlike(r"^DECIMAL\([0-9]+,0\)$")
            number = F.when(made.rlike("^(BIGINT|BOOLEAN|FLOAT|DOUBLE|DECIMAL.*)$"), number)
        else:
            number = F.col(c).cast("double")
            integral = F.lit(isinstance(types[c], (T.IntegralType, T.BooleanType)))
        values.append(F.when(number.isNotNull(), F.struct(number.alias("number"), integral.alias("integral"))))
    numbered = with_batch_id(df, batch_size, index=index)
    firsts = [F.first(v, ignorenulls=True).over(whole).alias(f"_first_{i}") for i, v in enumerate(values)]
    marked = numbered.select("*", *[v.alias(f"_value_{i}") for i, v in enumerate(values)], *firsts)
    chosen, kind = F.lit(None).cast("double"), F.lit(None).cast("boolean")
    for i in reversed(range(len(values))):
        present = F.col(f"_first_{i}").isNotNull()
        chosen = F.when(present, F.col(f"_value_{i}.number")).otherwise(chosen)
        kind = F.when(present, F.col(f"_first_{i}.integral")).otherwise(kind)
    cut = F.when(chosen < 0, -F.floor(-chosen)).otherwise(F.floor(chosen)).cast("double")
    kept = [c for c in numbered.columns if c not in columns and not isinstance(types.get(c), T.StringType)]
    out = marked.select(
        *kept,
        F.when(kind, cut).otherwise(chosen.cast("float").cast("double")).alias("labels"),
        F.when(kind, "bigint").otherwise("float").alias("labels_kind"),
    )
    return out.where(F.col("labels").isNotNull())


def shift_right(df: DataFrame, *, start: int, pad: int | None, labels: str = "labels") -> DataFrame:
    """Add ``decoder_input_ids``: the labels moved one to the right behind the
    start id, ignored labels as the pad id."""
    if pad is None:
        raise ValueError("a pad id has to be defined")
    moved = F.concat(F.array(F.lit(start)), F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0))))
    moved = F.when(F.size(labels) == 0, F.col(labels)).otherwise(moved)
    return df.withColumn("decoder_input_ids", A.unmask(moved, by=pad).cast("array<int>"))


def prepend_ignored(df: DataFrame, *, v: int, ignore: int = IGNORE) -> DataFrame:
    """Room for ``v`` virtual tokens in front of labels and attention mask."""
    out = df.withColumn("labels", F.concat(A.repeated(ignore, F.lit(v)), F.col("labels")))
    if "attention_mask" in df.columns:
        ones = F.array_repeat(F.lit(True), v)
        out = out.withColumn("attention_mask", F.concat(ones, F.col("attention_mask")))
    return out
