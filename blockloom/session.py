"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Defaults that hold on one machine and on a cluster alike; anything the
#: caller (or spark-submit) sets wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Tables stored in buckets are joined as they lie, see operators/patching.py.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

#: Input per shuffle partition.
PARTITION_BYTES = 128 * 1024 * 1024

_scratch_roots: dict[str, str] = {}


def build_session(
    app: str = "blockloom", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the library defaults; ``conf`` keys use ``__`` for dots.

    ``input_bytes`` sizes the shuffles: one partition per 128 MB of input, which
    adaptive execution merges again where a stage turns out smaller.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}
    if input_bytes is not None:
        settings.setdefault("spark.sql.shuffle.partitions", str(max(200, input_bytes // PARTITION_BYTES)))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it gets a temporary folder
    that goes with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _scratch_roots:
        _scratch_roots[app] = tempfile.mkdtemp(prefix="blockloom-")
        atexit.register(shutil.rmtree, _scratch_roots[app], ignore_errors=True)
    return _scratch_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/blockloom/{app}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage and freezes values such as partition numbers, which
    a lost executor could otherwise change on recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
