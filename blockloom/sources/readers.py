"""Reading text, JSON and stored corpora, in file order.

Every reader returns ``file``, ``row_idx`` and ``n_rows`` beside its own
columns: the row's dense number within its file and the file's row count.
The numbers come from the order Spark reads a file split in, so the text
itself is not shuffled for them.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blockloom.functions.text import file_stem, url_decode
from blockloom.operators.rows import running_total, with_row_index
from blockloom.session import stored

log = logging.getLogger(__name__)

#: A table of this many file splits or fewer is broadcast.
BROADCAST_SPLITS = 200_000
#: Files of these suffixes do not tell whether their last line ends.
COMPRESSED = (".gz", ".bz2", ".zst", ".zstd", ".lz4", ".snappy", ".deflate")

INSTRUCTION_COLUMNS = ("instruction", "input", "output")


@dataclass(frozen=True)
class Source:
    """A file, its weight in a mix, and reading options (``sample_by``,
    ``keep_linebreaks``)."""

    path: str
    weight: float = 1
    options: dict = field(default_factory=dict)

    @property
    def stem(self) -> str:
        name = self.path.rstrip("/").rsplit("/", 1)[-1]
        return name.rsplit(".", 1)[0]

    @classmethod
    def of(cls, spec: Source | str | Sequence) -> Source:
        """From a path or from ``[path, weight]``, ``[path, weight, options]``."""
        if isinstance(spec, Source):
            return spec
        return cls(spec) if isinstance(spec, str) else cls(*spec)


def _split_rows(raw: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Rows with their file, split and place within the task that read them."""
    return raw.select(
        *[c.alias(name) for name, c in columns.items()],
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )


def _indexed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number rows per file, in file order.

    What was read is written once, with the places it was read at. Numbers come
    from that table alone, so they hold whatever splits a later scan would
    make, and every row that was read is in it.
    """
    rows = stored(rows, "file-rows")
    splits = rows.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    of_file = W.partitionBy("file")
    before = of_file.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    placed = splits.select(
        "file",
        "_block",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(of_file).alias("n_rows"),
    )
    if splits.count() <= BROADCAST_SPLITS:
        placed = F.broadcast(placed)
    return rows.join(placed, ["file", "_block"]).select(
        "file", (F.col("_at") + F.col("_shift")).alias("row_idx"), "n_rows", *columns
    )


def _newlines(text: Column) -> Column:
    """Carriage returns, alone or before a newline, as newlines. A text without any is not copied."""
    return F.when(text.contains("\r"), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def read_text(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    sample_by: str = "line",
    keep_linebreaks: bool = False,
) -> DataFrame:
    """Text files as rows of one line, one paragraph or one whole file."""
    paths = [path] if isinstance(path, str) else list(path)
    value = F.col("value")
    if sample_by == "document":
        whole = spark.read.text(paths, wholetext=True)
        one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        return whole.select(
            F.col("_metadata.file_path").alias("file"), zero.alias("row_idx"), one.alias("n_rows"), _newlines(value).alias("text")
        )
    if sample_by == "paragraph":
        return _paragraphs(_whole_lines(spark, paths))
    if sample_by != "line":
        raise ValueError(f"sample_by must be line, paragraph or document, not {sample_by!r}")
    if not keep_linebreaks:
        return _indexed(_split_rows(spark.read.text(paths), {"text": value}), ["text"])
    lines = _whole_lines(spark, paths)
    text = F.when(F.col("_ends"), F.concat("text", F.lit("\n"))).otherwise(F.col("text"))
    return lines.select("file", "row_idx", "n_rows", text.alias("text"))


def _whole_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Numbered lines and whether a line end follows each (``_ends``).

    The last line of a file has one only if the file ends in one; the bytes of
    the lines against the size of the file tell.
    """
    raw = spark.read.text(paths, lineSep="\n")
    value = F.col("value")
    sizes = raw.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.sum(F.octet_length(value) + 1).alias("_bytes"), F.first("_metadata.file_size").alias("_size")
    )
    squeezed = sizes.where(F.lower(F.regexp_extract("file", r"(\.[^./]*)$", 1)).isin(*COMPRESSED)).select("file").first()
    if squeezed:
        raise ValueError(f"line ends of a compressed file cannot be told: {squeezed.file}")
    open_ended = sizes.where(F.col("_bytes") > F.col("_size")).select("file", F.lit(True).alias("_open"))
    pieces = F.split(F.regexp_replace(value, r"\r\z", ""), "\r", -1)  # carriage returns end lines as well
    rows = _split_rows(raw.select("_metadata", F.explode(pieces).alias("value")), {"text": value})
    lines = _indexed(rows, ["text"]).join(open_ended, "file", "left")
    last = F.coalesce("_open", F.lit(False)) & (F.col("row_idx") == F.col("n_rows") - 1)
    return lines.select("file", "row_idx", "n_rows", "text", (~last).alias("_ends"))


def _paragraphs(lines: DataFrame) -> DataFrame:
    """Lines put together between empty ones.

    As cutting at every two newlines from the left does it: of an odd run of
    newlines one is left over, for the next paragraph's beginning, or as a
    paragraph of its own at the end of the file. Blank lines are counted by a
    distributed running total, so a large file is not one task's.
    """
    blank = F.col("text") == ""
    counted = running_total(
        lines.drop("n_rows"), order=["row_idx"], by=["file"], value=blank.cast("bigint"), start="_blanks", total="_all_blanks"
    )
    counted = stored(counted, "counted-lines")
    sizes = lines.groupBy("file").agg(F.max("n_rows").alias("_lines"))
    runs = counted.where(blank).groupBy("file", (F.col("row_idx") - F.col("_blanks")).alias("_run")).agg(
        F.count("*").alias("_n"), F.min("row_idx").alias("_from"), (F.max("row_idx") + 1).alias("_first")
    )
    # newlines in a row: one after each empty line, and one after the line before them
    newlines = F.col("_n") + (F.col("_from") > 0).cast("bigint")
    left_over = runs.select("file", "_first", (newlines % 2 == 1).alias("_odd"))
    texts = counted.where(~blank).groupBy("file", "_blanks").agg(
        F.min("row_idx").alias("_first"), F.max("row_idx").alias("_last"), F.sort_array(F.collect_list(F.struct("row_idx", "text", "_ends"))).alias("_lines_of")
    )
    joined = texts.join(left_over, ["file", "_first"], "left").join(sizes, "file")
    body = F.array_join(F.transform("_lines_of", lambda x: x["text"]), "\n")
    head = F.when(F.col("_odd"), "\n").otherwise("")
    closed = (F.col("_last") == F.col("_lines") - 1) & F.element_at("_lines_of", -1)["_ends"]
    whole = joined.select("file", "_first", F.concat(head, body, F.when(closed, "\n").otherwise("")).alias("text"))
    tails = left_over.join(sizes, "file").where((F.col("_first") == F.col("_lines")) & F.col("_odd")).select("file", "_first", F.lit("\n").alias("text"))
    return with_row_index(whole.unionByName(tails), order=["_first"], by=["file"]).select("file", "row_idx", "n_rows", "text")


def _literal(name: str) -> str:
    """A path without characters that the readers take for a pattern: each may
    stand for any, so what is read has to be filtered by file."""
    return re.sub(r"[\[\]{}*?\\]", "?", name)


def _read_json(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each file by its own form: an array, or one object a line.

    A field has to occur somewhere in the files; all of them are looked at.
    """
    raw = _split_rows(spark.read.text(path), {"value": F.col("value")}).withColumn("value", F.regexp_replace("value", r"^\s+", ""))
    forms = raw.where("value <> ''").groupBy("file").agg(F.min_by(F.substring("value", 1, 1), F.struct("_block", "_at")).alias("mark"))
    of_form: dict[bool, list[str]] = {True: [], False: []}
    for row in forms.toLocalIterator():  # a row per file, as the driver lists them anyway
        of_form[row.mark == "["].append(row.file)
    schema = ", ".join(f"`{c}` string" for c in columns)
    seen: set[str] = set()
    parts = []
    for array, files in of_form.items():
        if not files:
            continue
        paths = [_literal(unquote(f)) for f in files]
        patterned = any("?" in p for p in paths)

        def own(rows: DataFrame, files: list[str] = files, patterned: bool = patterned) -> DataFrame:
            return rows.where(F.col("_metadata.file_path").isin(files)) if patterned else rows

        if array:
            objects = F.from_json("value", "array<map<string,string>>")
            holds = [F.exists(objects, lambda m: F.map_contains_key(m, c)) for c in columns]  # noqa: B023
        else:
            holds = [F.array_contains(F.json_object_keys("value"), c) for c in columns]
        some = [F.coalesce(F.max(h), F.lit(False)).alias(c) for h, c in zip(holds, columns, strict=True)]
        there = own(spark.read.text(paths, wholetext=array)).agg(*some).first()
        seen |= {c for c in columns if there[c]}
        found = own(spark.read.json(paths, schema=schema, multiLine=array, mode="FAILFAST"))
        parts.append(_split_rows(found, {c: F.col(c) for c in columns}))
    missing = [c for c in columns if c not in seen]
    if missing:
        raise ValueError(f"{path} has no field {', '.join(map(repr, missing))}")
    return _indexed(reduce(DataFrame.unionByName, parts), columns)


def read_json_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """JSON lines or JSON arrays; keeps ``text``, which must be there."""
    return _read_json(spark, path, ["text"])


def read_instructions(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """JSON rows with ``instruction``, ``input`` and ``output``."""
    return _read_json(spark, path, INSTRUCTION_COLUMNS)


def load_source(spark: SparkSession, spec: Source | str | Sequence) -> DataFrame:
    """Read a text source by its suffix: ``txt``, ``json`` or ``jsonl``."""
    source = Source.of(spec)
    if source.path.endswith("txt"):
        return read_text(spark, source.path, **source.options)
    if source.path.endswith(("json", "jsonl")):
        return read_json_text(spark, source.path)
    raise ValueError(f"cannot tell how to read {source.path}: use .txt, .json or .jsonl")


def read_dir(
    spark: SparkSession, folder: str, *, suffix: str = "txt", first_only: bool = False, columns: Sequence[str] = ("text",)
) -> DataFrame:
    """Every file of a folder with the suffix; ``source`` is the file's stem.

    JSON files may hold arrays or lines, of texts or, with other ``columns``, of
    instructions; the columns must occur.

    ``first_only`` keeps the first file by name, for trying things out.
    """
    files = sorted(_files(spark, folder, suffix))[: 1 if first_only else None]
    if not files:
        raise ValueError(f"no .{suffix} file in {folder}")
    rows = read_text(spark, files) if suffix == "txt" else _read_json(spark, files, columns)
    return rows.withColumn("source", url_decode(file_stem(F.col("file"))))


def load_corpus(spark: SparkSession, folder: str, split: str | None = None) -> DataFrame:
    """A stored corpus, or one of its splits."""
    return spark.read.parquet(f"{folder}/{split}" if split else folder)


def _listed(spark: SparkSession, root: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return list(path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path))


def _files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    names = [s.getPath().getName() for s in _listed(spark, folder) if not s.isDirectory()]
    return [f"{folder.rstrip('/')}/{_literal(n)}" for n in names if n.endswith(f".{suffix}") and n[0] not in "._"]


def scan_corpus_dirs(spark: SparkSession, root: str, *, split: str = "train") -> DataFrame:
    """All corpora below ``root``, told apart by ``name``.

    The first by name sets the columns: others are cast to its types, what they
    lack is null, what they have beyond is left out. A value that does not fit
    raises. Folders that cannot be opened are reported and skipped.
    """
    schema, parts = None, []
    for name in sorted(s.getPath().getName() for s in _listed(spark, root) if s.isDirectory()):
        path = f"{root}/{name}/{split}"
        try:
            rows = spark.read.parquet(path)
        except (AnalysisException, PySparkException) as error:
            log.warning("skipping %s: %s", path, str(error).splitlines()[0])
            continue
        schema = schema or rows.schema
        own = set(rows.columns)
        columns = [(F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        parts.append(rows.select(F.lit(name).alias("name"), *columns))
    if not parts:
        raise ValueError(f"no corpus below {root}")
    return reduce(DataFrame.unionByName, parts)
