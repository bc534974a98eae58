"""Sources and sinks.  Files are written from the tables first, then read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom import sources as S
from blockloom.operators.rows import explode_pieces
from blockloom.operators.sampling import split
from blockloom.queries.registry import SQL_INSTRUCTIONS, SQL_LINES, instructions, lines, query, spread, table
from blockloom.session import scratch_path


def _line_files(spark: SparkSession, d: str) -> str:
    """The documents' lines as text files, one a source."""
    path = scratch_path(spark, "lines")
    rows = lines(spark, d).select("source", "doc_id", "line_no", F.col("text").alias("value"))
    rows.repartition("source").sortWithinPartitions("source", "doc_id", "line_no").select("source", "value").write.partitionBy("source").text(path)
    return path


def _of_file(name: str) -> Column:
    """What a file's folder is named after."""
    return F.regexp_extract("file", "/[a-z]+=([^/]*)/", 1).alias(name)


@query("scan_lines", f"WITH {SQL_LINES} SELECT source, text, row_idx, n_rows FROM lines")
def scan_lines(spark: SparkSession, d: str) -> DataFrame:
    return S.read_text(spark, _line_files(spark, d)).select(_of_file("source"), "text", "row_idx", "n_rows")


@query("scan_lines_keep", f"WITH {SQL_LINES} SELECT source, text || chr(10) AS text, row_idx, n_rows FROM lines")
def scan_lines_keep(spark: SparkSession, d: str) -> DataFrame:
    kept = S.read_text(spark, _line_files(spark, d), keep_linebreaks=True)
    return kept.select(_of_file("source"), "text", "row_idx", "n_rows")


@query(
    "table_lines_keep",
    f"""WITH {SQL_LINES}, last AS (SELECT doc_id, max(line_no) AS m FROM lines GROUP BY doc_id)
    SELECT l.source, l.doc_id, line_no, row_idx,
      md5(l.text || CASE WHEN line_no < m OR right(d.text, 1) = chr(10) THEN chr(10) ELSE '' END) AS text_md5
    FROM lines l JOIN last USING (doc_id) JOIN documents d ON d.doc_id = l.doc_id""",
)
def table_lines_keep(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a table's texts, newlines kept."""
    docs = table(spark, d, "documents").select("source", "doc_id", "text")
    kept = explode_pieces(docs, key=["doc_id"], keep_linebreaks=True)
    return kept.select("source", "doc_id", F.col("piece_no").alias("line_no"), "row_idx", F.md5("text").alias("text_md5"))


@query(
    "scan_paragraphs",
    """WITH pieces AS (
      SELECT role, conv_id, turn, unnest(p) AS text, generate_subscripts(p, 1) AS i
      FROM (SELECT *, string_split(text || chr(10) || chr(10), chr(10) || chr(10)) AS p FROM conversations)),
    numbered AS (
      SELECT role, text, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn, i) - 1 AS row_idx,
        count(*) OVER (PARTITION BY role) AS n_rows
      FROM pieces WHERE text <> '')
    SELECT * FROM numbered""",
)
def scan_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Each message as a paragraph of its role's text file, read back by paragraph."""
    path = scratch_path(spark, "paragraphs")
    chats = table(spark, d, "conversations").repartition("role").sortWithinPartitions("role", "conv_id", "turn")
    chats.select("role", F.concat("text", F.lit("\n")).alias("value")).write.partitionBy("role").text(path)
    return S.read_text(spark, path, sample_by="paragraph").select(_of_file("role"), "text", "row_idx", "n_rows")


#: Documents a file that is read as one row: a larger table makes more files, not larger rows.
FILE_ROWS = 1_000


@query(
    "scan_documents",
    """SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars,
       CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents""",
)
def scan_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole files, one row each: together they hold what was written."""
    path = scratch_path(spark, "documents") + ".txt"
    docs = spread(table(spark, d, "documents").select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("value")))
    docs.write.option("maxRecordsPerFile", FILE_ROWS).text(path)
    files = S.load_source(spark, [path, 1, {"sample_by": "document"}])
    newlines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return files.agg(
        F.sum(newlines).alias("n_lines"), F.sum(F.length("text")).alias("n_chars"), F.sum(F.octet_length("text")).alias("n_bytes")
    )


@query(
    "scan_json_text",
    """SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS row_idx,
       count(*) OVER (PARTITION BY source) AS n_rows FROM documents""",
)
def scan_json_text(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "text")
    docs = table(spark, d, "documents").repartition("source").sortWithinPartitions("source", "doc_id")
    docs.select("source", "doc_id", "text", "lang").write.partitionBy("source").json(path)
    return S.read_json_text(spark, path).select(_of_file("source"), "text", "row_idx", "n_rows")


@query(
    "scan_instructions",
    f"""WITH {SQL_INSTRUCTIONS}
    SELECT instruction, input, output, row_number() OVER (PARTITION BY conv_id % 4 ORDER BY conv_id, turn) - 1 AS row_idx,
      count(*) OVER (PARTITION BY conv_id % 4) AS n_rows FROM instr""",
)
def scan_instructions(spark: SparkSession, d: str) -> DataFrame:
    """Four files; in the first rows of some the extra input does not occur."""
    path = scratch_path(spark, "instructions")
    rows = instructions(spark, d).withColumn("part", F.col("conv_id") % 4)
    rows.repartition("part").sortWithinPartitions("part", "conv_id", "turn").drop("conv_id", "turn").write.partitionBy("part").json(path)
    return S.read_instructions(spark, path).select("instruction", "input", "output", "row_idx", "n_rows")


@query(
    "source_dispatch",
    f"""WITH {SQL_LINES}
    SELECT 'txt' AS kind, text, CAST(count(*) AS BIGINT) AS n FROM lines GROUP BY text
    UNION ALL SELECT 'jsonl' AS kind, text, CAST(count(*) AS BIGINT) AS n FROM benchmark GROUP BY text""",
)
def source_dispatch(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch_path(spark, "dispatch")
    table(spark, d, "documents").select("text").write.text(f"{folder}/documents.txt")
    table(spark, d, "benchmark").write.json(f"{folder}/benchmark.jsonl")
    read = [
        S.load_source(spark, f"{folder}/{name}").select(F.lit(name.split(".")[1]).alias("kind"), "text")
        for name in ("documents.txt", "benchmark.jsonl")
    ]
    return read[0].unionByName(read[1]).groupBy("kind", "text").agg(F.count("*").alias("n"))


_SPLIT = """WITH r AS (
  SELECT *, row_number() OVER (ORDER BY md5('1234:' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM documents)
"""


def _corpus(spark: SparkSession, d: str) -> str:
    folder = scratch_path(spark, "corpus")
    docs = table(spark, d, "documents").withColumn("row_idx", F.col("doc_id"))
    S.write_corpus(split(docs, test=0.05, key=["doc_id"]), folder)
    return folder


@query("load_corpus", f"{_SPLIT} SELECT doc_id, md5(text) AS text_md5 FROM r WHERE rn <= ceil(n * 0.05::DOUBLE)")
def load_corpus(spark: SparkSession, d: str) -> DataFrame:
    return S.load_corpus(spark, _corpus(spark, d), "test").select("doc_id", F.md5("text").alias("text_md5"))


@query("write_source", "SELECT doc_id, source, n_chars, md5(text) AS text_md5 FROM documents")
def write_source(spark: SparkSession, d: str) -> DataFrame:
    path = S.write_source(table(spark, d, "documents"), scratch_path(spark, "single"), "documents")
    return spark.read.parquet(path).select("doc_id", "source", "n_chars", F.md5("text").alias("text_md5"))


@query(
    "write_corpus",
    f"{_SPLIT} SELECT doc_id, CASE WHEN rn <= ceil(n * 0.05::DOUBLE) THEN 'test' ELSE 'train' END AS split, md5(text) AS text_md5 FROM r",
)
def write_corpus(spark: SparkSession, d: str) -> DataFrame:
    folder = _corpus(spark, d)
    parts = [S.load_corpus(spark, folder, s).select("doc_id", F.lit(s).alias("split"), F.md5("text").alias("text_md5")) for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


@query("write_provenance", "SELECT 'documents' AS path, CAST(count(*) AS BIGINT) AS n_rows FROM documents")
def write_provenance(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "provenance")
    S.write_provenance(spark, path, {"path": "documents", "n_rows": table(spark, d, "documents").count()})
    return spark.read.schema("path string, n_rows bigint").json(path)


@query("materialize_once", "SELECT source, CAST(count(*) AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS n_builds FROM documents GROUP BY source")
def materialize_once(spark: SparkSession, d: str) -> DataFrame:
    """Asked for twice, built once."""
    folder, builds = scratch_path(spark, "once"), []

    def build() -> DataFrame:
        builds.append(1)
        return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n_rows"))

    for _ in range(2):
        result = S.materialize_once(spark, folder, {"table": "documents"}, build)
    return result.withColumn("n_builds", F.lit(len(builds)).cast("bigint"))


@query(
    "scan_corpus_dirs",
    """SELECT 'documents' AS name, doc_id AS id, text FROM documents
       UNION ALL SELECT 'benchmark' AS name, item_id AS id, text FROM benchmark
       UNION ALL SELECT 'pages' AS name, NULL AS id, html AS text FROM pages""",
)
def scan_corpus_dirs(spark: SparkSession, d: str) -> DataFrame:
    """Corpora of other types and columns than the first, and a folder that holds none."""
    root = scratch_path(spark, "corpora")
    table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text").write.parquet(f"{root}/benchmark/train")
    docs = table(spark, d, "documents").select("lang", F.col("doc_id").cast("int").alias("id"), "text")
    docs.write.partitionBy("lang").parquet(f"{root}/documents/train")
    table(spark, d, "pages").select("url", F.col("html").alias("text")).write.parquet(f"{root}/pages/train")
    table(spark, d, "benchmark").select("text").write.text(f"{root}/broken/other")
    return S.scan_corpus_dirs(spark, root).select("name", "id", "text")


@query("scan_dir_glob", "SELECT 'json' AS kind, text FROM documents UNION ALL SELECT 'txt' AS kind, replace(text, chr(10), ' ') AS text FROM benchmark")
def scan_dir_glob(spark: SparkSession, d: str) -> DataFrame:
    """A folder of JSON lines, a JSON array and text: each kind by its suffix."""
    folder = scratch_path(spark, "glob")
    docs = table(spark, d, "documents").select("doc_id", "text")
    docs.where("doc_id % 3 > 0").select("text").write.json(folder)
    table(spark, d, "benchmark").select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("value")).write.mode("append").text(folder)
    held = F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list(F.to_json(F.struct("text")))), ",\n"), F.lit("]"))
    arrays = docs.where("doc_id % 3 = 0").groupBy((F.col("doc_id") % 48).alias("part")).agg(held.alias("value"))
    arrays.repartition("part").write.mode("append").partitionBy("part").option("lineSep", "\n").text(f"{folder}/arrays")
    parts = [S.read_dir(spark, folder, suffix=kind).select(F.lit(kind).alias("kind"), "text") for kind in ("json", "txt")]
    other = S.read_json_text(spark, f"{folder}/arrays").select(F.lit("json").alias("kind"), "text")
    return parts[0].unionByName(parts[1]).unionByName(other)


