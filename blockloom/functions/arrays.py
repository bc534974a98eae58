"""Column expressions over token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blockloom.functions.text import IGNORE, PAD_ID


def head(ids: Column, n: Column | int) -> Column:
    """The first ``n`` elements, fewer if there are fewer."""
    return F.slice(ids, 1, n)


def tail(ids: Column, n: Column) -> Column:
    """The last ``n`` elements, all of them if there are fewer."""
    kept = F.least(n, F.size(ids))
    return F.slice(ids, F.size(ids) - kept + 1, kept)


def repeated(value: int, n: Column) -> Column:
    """An int array of ``n`` equal elements."""
    return F.array_repeat(F.lit(value).cast("int"), n.cast("int"))


def pad_right(ids: Column, length: Column, value: int) -> Column:
    return F.concat(ids, repeated(value, length - F.size(ids)))


def int_array(ids: Column) -> Column:
    """Narrow to 32-bit elements; a value that does not fit raises."""
    return ids.cast("array<int>")


def attention_mask(ids: Column, pad_id: int = PAD_ID) -> Column:
    """True wherever the element differs from the pad id, even inside the text."""
    return F.transform(ids, lambda x: x != pad_id)


def mask_labels(source: Column, target: Column, ignore: int = IGNORE) -> Column:
    return F.concat(repeated(ignore, F.size(source)), target)


def argmax_index(values: Column) -> Column:
    """Zero-based index of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def unmask(labels: Column, ignore: int = IGNORE, by: int = 0) -> Column:
    return F.transform(labels, lambda x: F.when(x == ignore, by).otherwise(x))


def to_half(values: Column) -> Column:
    """Floats rounded to the nearest half-precision number (ties to even)."""

    def rounded(x: Column) -> Column:
        x = x.cast("double")
        exponent = F.greatest(F.floor(F.log2(F.abs(x))), F.lit(-14))
        step = F.pow(F.lit(2.0), exponent - 10)
        value = F.rint(x / step) * step
        infinite = F.signum(x) * F.lit(float("inf"))
        return F.when(x == 0, x).when(F.abs(value) > 65504.0, infinite).otherwise(value).cast("float")

    return F.transform(values, rounded)
