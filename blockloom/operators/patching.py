"""Sparse patching of arrays: rows stay where they are, only misses travel.

A first pass fills the arrays of a table in place, as far as a table handed to
every task reaches, and notes what it missed: the place and the number that the
task gave to the looked-up key, which it names once.  The rows are stored in
buckets of their partition number, which every task writes as one file and every
later scan gives back as a partitioning.  The keys of a partition alone are
looked up and sent back to it; the misses, as pairs of numbers, are exchanged
once, and meet the keys' values and then their rows without another exchange.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from blockloom.operators.steps import steps
from blockloom.session import scratch_path


@dataclass(frozen=True)
class Patch:
    """One array column to patch: struct column ``column`` has its ``values``, the
    ``place`` and ``number`` of what was missed, and, numbered from ``base`` on, each
    ``key`` that its partition had not asked for; ``out`` is its new name."""

    column: str
    out: str


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Keys that a task remembers the numbers of; beyond that it begins anew and asks again.
KEYS_HELD = 1 << 18
#: What is partitioned by some of a join's keys is joined as it lies where this is "false".
_AS_IT_LIES = "spark.sql.requireAllClusterKeysForCoPartition"


def numbering(most: int = KEYS_HELD):
    """Begins a task's numbers: a function from keys to their numbers, the first new one, and the new keys."""

    def begin():
        known, given = {}, 0

        def number(keys: Sequence) -> tuple[np.ndarray, int, list]:
            nonlocal given
            if len(known) > most:
                known.clear()
            out, base, new = np.empty(len(keys), np.int32), given, []
            for i, key in enumerate(keys):
                n = known.get(key)
                if n is None:
                    n = known[key] = given
                    given += 1
                    new.append(key)
                out[i] = n
            return out, base, new

        return number

    return begin


def miss_columns(kind: str):
    """Puts together what a first pass returns; ``kind`` is the Arrow type of the keys."""

    def columns(values: pa.Array, starts: np.ndarray, place: np.ndarray, number: np.ndarray, base: int, new: list) -> pa.Array:
        n = len(values)
        lists = lambda x: pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x, pa.int32()))
        # the first row names the keys of all
        named = pa.ListArray.from_arrays(pa.array([0] + [len(new)] * n, pa.int32()), pa.array(new, pa.type_for_alias(kind)))
        of_rows = [values, lists(place), lists(number), pa.array(np.full(n, base), pa.int32()), named]
        return pa.StructArray.from_arrays(of_rows, names=["values", "place", "number", "base", "key"])

    return columns


def _in_buckets(df: DataFrame, column: str, label: str) -> DataFrame:
    """``df`` stored below the shared folder in buckets of ``column``."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(shuffle_partitions(spark), column)
    writer.option("path", scratch_path(spark, label)).saveAsTable(name)
    return spark.table(name)


def _filler(kind: DataType):
    """Overwrite places of arrays, whole Arrow columns at a time."""
    cut = steps()

    def filled(values: pa.Array, places: pa.Array, found: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        flat = values.flatten()
        counts = pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False)
        new = found.flatten().cast(flat.type)
        # Each place takes its element from the old values or, behind them, the new ones.
        source = np.arange(len(flat))
        source[np.repeat(offsets[:-1], counts) + places.flatten().to_numpy(zero_copy_only=False)] = len(flat) + np.arange(len(new))
        flat = pa.concat_arrays([flat, new]).take(pa.array(source))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)

    @F.arrow_udf(kind)
    def fill(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for values, places, found in cut(columns):
            yield filled(values, places, found)

    return fill


def patch_arrays(rows: DataFrame, patches: Sequence[Patch], rare: DataFrame) -> DataFrame:
    """Fill what the first pass missed from ``rare(key, value)``.

    Keys that ``rare`` lacks leave the value as it is.  Rows are told apart by
    where they were stored, so equal and null keys of a table do no harm.  Each
    key is looked up once a partition, so none is hot.  The session's setting
    for joining what lies in buckets is made, unless its start said otherwise.
    """
    spark = rows.sparkSession
    if not spark.sparkContext.getConf().contains(_AS_IT_LIES):
        spark.conf.set(_AS_IT_LIES, "false")
    parts = shuffle_partitions(spark)
    number = F.monotonically_increasing_id()
    kept = _in_buckets(rows.withColumn("_row", number).withColumn("_part", F.shiftright("_row", 33)), "_part", "patched")

    def asked(i: int, column: str) -> DataFrame:
        each = kept.select("_part", F.col(f"{column}.base").alias("_base"), F.posexplode(f"{column}.key").alias("_at", "key"))
        return each.select("_part", F.lit(i).alias("field"), (F.col("_base") + F.col("_at")).alias("number"), "key")

    def missed(i: int):
        zipped = F.arrays_zip(F.col(f"_place{i}").alias("place"), F.col(f"_number{i}").alias("number"))
        return F.transform(zipped, lambda z: F.struct(F.lit(i).alias("field"), z["place"].alias("place"), z["number"].alias("number")))

    keys = reduce(DataFrame.unionByName, [asked(i, p.column) for i, p in enumerate(patches)])
    values = rare.groupBy("key").agg(F.max("value").alias("value"))
    answers = keys.join(values, "key").drop("key").repartition(parts, "_part")
    each = [F.col(f"{p.column}.{part}").alias(f"_{part}{i}") for i, p in enumerate(patches) for part in ("place", "number")]
    some = reduce(Column.__or__, [F.size(f"{p.column}.place") > 0 for p in patches])
    home = kept.where(some).select("_part", "_row", *each).repartition(parts, "_part")
    misses = home.select("_part", "_row", F.explode(F.concat(*map(missed, range(len(patches))))).alias("_m")).select("_part", "_row", "_m.*")
    hits = misses.join(answers, ["_part", "field", "number"]).select("_part", "_row", F.struct("field", "place", "value").alias("_p"))
    back = hits.groupBy("_part", "_row").agg(F.sort_array(F.collect_list("_p")).alias("_patches"))
    joined = kept.join(back, ["_part", "_row"], "left")

    def own(i: int, part: str):
        mine = F.filter("_patches", lambda p: p["field"] == i)
        return F.transform(mine, lambda p: p[part])

    kind = {p.column: kept.schema[p.column].dataType["values"].dataType for p in patches}
    out = {p.column: _filler(kind[p.column])(f"{p.column}.values", own(i, "place"), own(i, "value")).alias(p.out) for i, p in enumerate(patches)}
    return joined.select(*[out.get(c, F.col(f"`{c}`")) for c in rows.columns])
