"""Processing only what has not been processed yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.operators.instruct import instruction_examples
from blockloom.operators.packing import pack_arrivals
from blockloom.operators.vocab import Vocabulary, encode
from blockloom.sources.readers import read_instructions


def _run(stream: DataFrame, checkpoint: str, process: Callable[[DataFrame, int], None]) -> None:
    """All micro-batches that are due, one after the other."""
    query = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _arriving(spark: SparkSession, kind: str, in_dir: str, files_per_batch: int | None):
    reader = spark.readStream.format(kind).option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader


def _so_far(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.parquet(folder)
    except AnalysisException:
        return None


def _lines(spark: SparkSession, in_dir: str, files_per_batch: int | None) -> DataFrame:
    return _arriving(spark, "text", in_dir, files_per_batch).load(in_dir).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("text"),
    )


def incremental_sources(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    *,
    files_per_batch: int | None = None,
) -> DataFrame | None:
    """Run ``transform`` over the text files that arrived since the last call,
    then return everything stored so far, if anything is.

    ``transform`` gets ``file, block, at, text`` of one micro-batch; sorting by
    ``file, block, at`` gives file order.  A repeated micro-batch overwrites
    its own output, so a restart neither loses nor doubles rows.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("at", F.monotonically_increasing_id())
        transform(numbered).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    _run(_lines(spark, in_dir, files_per_batch), checkpoint, store)
    return _so_far(spark, out_dir)


#: Fixed value: the columns of a stream of files; their content is never read.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_CARRIED = "source string, n_blocks bigint, tail array<int>"


def _version(spark: SparkSession, out_dir: str, version: int) -> DataFrame:
    """What was left over after a micro-batch; before the first, nothing."""
    if version < 0:
        return spark.createDataFrame([], _CARRIED)
    return spark.read.schema(_CARRIED).parquet(f"{out_dir}/carried/version={version}")


def incremental_blocks(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    vocab: Vocabulary,
    *,
    block_size: int,
    files_per_batch: int | None = None,
) -> DataFrame | None:
    """Pack the lines of arriving files into blocks, each source one stream.

    A source is a folder below ``in_dir``; its files follow each other by
    arrival, then by name.  What does not fill a block is carried to the next
    arrival in a table of one row a source.  Micro-batch ``n`` reads version
    ``n - 1`` of it and writes version ``n`` last, so a repeated micro-batch
    finds what it found before and overwrites what it wrote.  The version
    before the one read is removed then.

    Returns all blocks so far (``source``, ``block``, ``input_ids``), if there
    are any; see :func:`open_tails` for the rest.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        source = F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
        numbered = batch.select(source.alias("source"), "file", "block", F.monotonically_increasing_id().alias("at"), "text")
        ids = encode(numbered, vocab, key=["source", "file", "block", "at"], add_eos=True)
        blocks, carried = pack_arrivals(
            ids, _version(spark, out_dir, batch_id - 1), block_size=block_size, scope=["source"], order=["file", "block", "at"]
        )
        blocks.write.mode("overwrite").parquet(f"{out_dir}/blocks/batch={batch_id}")
        carried.write.mode("overwrite").parquet(f"{out_dir}/carried/version={batch_id}")
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/carried/version={batch_id - 2}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    _run(_lines(spark, in_dir, files_per_batch), checkpoint, store)
    found = _so_far(spark, f"{out_dir}/blocks")
    return None if found is None else found.drop("batch")


def open_tails(spark: SparkSession, out_dir: str, *, short: bool = False) -> DataFrame:
    """What is carried now: ``source``, ``n_blocks`` and ``tail``.

    With ``short``, the short blocks of sources that never filled one, as a run
    over all files at once keeps them: ``source``, ``block``, ``input_ids``.
    """
    found = _so_far(spark, f"{out_dir}/carried")
    if found is None:
        last = spark.createDataFrame([], _CARRIED)
    else:
        latest = found.agg(F.max("version")).first()[0]
        last = found.where(F.col("version") == latest).drop("version")
    if not short:
        return last
    never = last.where((F.col("n_blocks") == 0) & (F.size("tail") > 0))
    return never.select("source", F.lit(0).cast("bigint").alias("block"), F.col("tail").alias("input_ids"))


def incremental_instructions(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    vocab: Vocabulary,
    *,
    max_len: int = 4096,
    max_target: int = 512,
    mode: str = "head_tail",
    files_per_batch: int | None = None,
) -> DataFrame | None:
    """Masked examples of the JSON files that arrived since the last call (arrays
    or lines, each file by its own form); returns all examples so far, if any.

    The stream only lists files; each micro-batch reads its own and overwrites
    its own output.  A micro-batch of empty files adds nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # The stream's own log lists a micro-batch's files on the driver as well.
        files = [r["path"] for r in batch.where("length > 0").select("path").collect()]
        if not files:
            return
        rows = read_instructions(spark, files)
        made = instruction_examples(rows, vocab, key=["file", "row_idx"], max_len=max_len, max_target=max_target, mode=mode)
        made.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    listed = _arriving(spark, "binaryFile", in_dir, files_per_batch).schema(_FILES).load(in_dir).select("path", "length")
    _run(listed, checkpoint, store)
    found = _so_far(spark, out_dir)
    return None if found is None else found.drop("batch")
