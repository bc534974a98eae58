"""Storing per-source results, merged corpora and their provenance."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per output file.
FILE_ROWS = 1_000_000


def write_source(df: DataFrame, folder: str, name: str) -> str:
    """One folder per processed source; returns its path."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return path


def write_provenance(spark: SparkSession, path: str, facts: dict) -> None:
    """A one-row JSON manifest: what a result was made from, and how."""
    row = spark.range(1).select(*[F.lit(json.dumps(v) if isinstance(v, (dict, list)) else v).alias(k) for k, v in facts.items()])
    row.coalesce(1).write.mode("overwrite").json(path)


def read_provenance(spark: SparkSession, path: str) -> dict | None:
    """The manifest at ``path``, or nothing if there is none."""
    try:
        row = spark.read.json(path).first()
    except AnalysisException:
        return None
    return row.asDict() if row else None


def materialize_once(
    spark: SparkSession, folder: str, key: dict, build: Callable[[], DataFrame]
) -> DataFrame:
    """The stored result for ``key``, computed and stored if there is none.

    The manifest is written last, so a half-written result never counts; a
    manifest with another key makes the result stale.
    """
    wanted = json.dumps(key, sort_keys=True, ensure_ascii=False)
    data, manifest = f"{folder}/data", f"{folder}/manifest"
    found = read_provenance(spark, manifest)
    if found is None or found.get("key") != wanted:
        # Void the old manifest before its data changes.
        write_provenance(spark, manifest, {"key": ""})
        df = build()
        df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(data)
        write_provenance(spark, manifest, {"key": wanted})
    return spark.read.parquet(data)


def write_corpus(df: DataFrame, folder: str, *, order: str = "row_idx", file_rows: int = FILE_ROWS, placed: bool = False) -> None:
    """Write ``train/`` and ``test/``, the latter empty without a split.

    One write for both, files following each other in row order.  Rows that
    :func:`split_and_shuffle` has ``placed`` are written as they lie; others are
    ranged by split and order first.  The folders are put in place when both are
    complete (by renaming, which object stores do by copying).
    """
    spark = df.sparkSession
    ordered = df if placed else df.repartitionByRange("split", order)
    writing = f"{folder}/_writing-{uuid.uuid4().hex}"
    write = ordered.sortWithinPartitions("split", order).write.partitionBy("split").option("maxRecordsPerFile", file_rows)
    write.parquet(writing)
    for split in ("train", "test"):
        if not _move(spark, f"{writing}/split={split}", f"{folder}/{split}"):
            spark.createDataFrame([], df.drop("split").schema).write.mode("overwrite").parquet(f"{folder}/{split}")
    _path(spark, writing)[1].delete(_path(spark, writing)[0], True)


def _path(spark: SparkSession, path: str) -> tuple:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Put a folder in another's place, if there is one to put."""
    (old, files), (new, _) = _path(spark, source), _path(spark, target)
    if not files.exists(old):
        return False
    files.delete(new, True)
    if not files.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")
    return True
