"""The register of queries, and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.functions import text as T
from blockloom.operators.instruct import encode_pairs
from blockloom.operators.rows import explode_pieces, with_row_index
from blockloom.operators.vocab import Vocabulary, build_vocab, encode
from blockloom.session import stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Special tokens included.
VOCAB_ROWS = 32_000
BLOCK = 128
WORKERS, BATCH_ROWS = 4, 50
MAX_LEN, MAX_TARGET, CAP = 128, 64, 10


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; the SQL is what DuckDB runs on the same tables."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table scanned by fewer tasks than there are cores, over all cores.

    Only ever true of small files: a large table has tasks enough.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def digest(ids: Column) -> Column:
    """An array as one comparable value."""
    return F.md5(F.array_join(ids.cast("array<string>"), ","))


_vocabularies: dict[tuple[str, str, int | None], Vocabulary] = {}


def vocabulary(spark: SparkSession, folder: str, cap: int | None = VOCAB_ROWS) -> Vocabulary:
    """The vocabulary of a folder's documents, built once per application and
    stored, as a tokenizer is trained once and then loaded."""
    known = (spark.sparkContext.applicationId, folder, cap)
    if known not in _vocabularies:
        built = trained_vocabulary(spark, folder, cap)
        _vocabularies[known] = Vocabulary(stored(built.table, "vocabulary"), built.max_rows)
    return _vocabularies[known]


def trained_vocabulary(spark: SparkSession, folder: str, cap: int | None = VOCAB_ROWS) -> Vocabulary:
    docs = table(spark, folder, "documents").select("text")
    return build_vocab(spread(docs), max_vocab=cap)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the documents, each source standing for one file."""
    docs = spread(table(spark, folder, "documents").select("source", "doc_id", "text"))
    return explode_pieces(docs, key=["doc_id"]).withColumnRenamed("piece_no", "line_no")


def encoded_lines(spark: SparkSession, folder: str) -> DataFrame:
    return encode(
        lines(spark, folder),
        vocabulary(spark, folder),
        key=["doc_id", "line_no"],
        keep=["source", "row_idx", "n_rows"],
        add_eos=True,
    )


def encoded_docs(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(table(spark, folder, "documents").select("doc_id", "source", "lang", "text"))
    return encode(docs, vocabulary(spark, folder), key=["doc_id"], keep=["source", "lang"], add_eos=True)


def instructions(spark: SparkSession, folder: str) -> DataFrame:
    """A user turn directly followed by an assistant turn is one instruction
    row; the conversation's system message is its extra input.

    Turns are numbered over the whole table and joined to their successor, so
    a very long conversation is spread like any other.
    """
    chats = table(spark, folder, "conversations")
    numbered = with_row_index(chats, order=["conv_id", "turn"]).drop("n_rows")
    following = numbered.select(
        (F.col("row_idx") - 1).alias("row_idx"),
        "conv_id",
        F.col("role").alias("next_role"),
        F.col("text").alias("output"),
    )
    is_system = F.col("role") == "system"
    systems = chats.where(is_system).groupBy("conv_id").agg(F.max_by("text", "turn").alias("input"))
    pairs = numbered.join(following, ["row_idx", "conv_id"]).where(
        (F.col("role") == "user") & (F.col("next_role") == "assistant")
    )
    return pairs.join(systems, "conv_id", "left").select(
        "conv_id", "turn", F.col("text").alias("instruction"), "input", "output"
    )


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return encode_pairs(instructions(spark, folder), vocabulary(spark, folder), key=["conv_id", "turn"])


# --- the same inputs as SQL ------------------------------------------------

_TOKENS = "list_filter(regexp_split_to_array({text}, '[ ' || chr(10) || ']+'), lambda x: x <> '')"


def sql_tokens(text: str) -> str:
    return _TOKENS.format(text=text)


def sql_vocab(cap: int | None) -> str:
    """The CTE ``vocab``; without a cap all words."""
    cut = "" if cap is None else f"WHERE rn <= {cap - 4}"
    return f"""
words AS (SELECT unnest({sql_tokens('text')}) AS token FROM documents),
counted AS (
  SELECT token, count(*) AS n FROM words
  WHERE token NOT IN ('<unk>', '<s>', '</s>', '<pad>') GROUP BY token),
vocab AS (
  SELECT token, CAST(rn + 3 AS INTEGER) AS id
  FROM (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS rn FROM counted)
  {cut}
  UNION ALL SELECT * FROM (VALUES ('<unk>', 0), ('<s>', 1), ('</s>', 2), ('<pad>', 3)) s(token, id))"""


SQL_VOCAB = sql_vocab(VOCAB_ROWS)

SQL_LINES = """
lines AS (
  SELECT source, doc_id, CAST(i AS BIGINT) AS line_no, text,
         row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1 AS row_idx,
         count(*) OVER (PARTITION BY source) AS n_rows
  FROM (SELECT source, doc_id, unnest(p) AS text, generate_subscripts(p, 1) - 1 AS i
        FROM (SELECT source, doc_id, string_split(
                CASE WHEN right(text, 1) = chr(10) THEN left(text, length(text) - 1) ELSE text END,
                chr(10)) AS p
              FROM documents WHERE text <> '')))"""


def sql_encode(name: str, source: str, key: str, *, text: str = "text", bos: bool = True, eos: bool = False) -> str:
    """A CTE ``name`` with the columns of ``source`` and ``input_ids``; needs
    the CTE ``vocab``."""
    head = "[1]" if bos else "CAST([] AS INTEGER[])"
    end = "[2]" if eos else "CAST([] AS INTEGER[])"
    same = " AND ".join(f"b.{k.strip()} = s.{k.strip()}" for k in key.split(","))
    return f"""
{name}_t AS (
  SELECT {key}, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
  FROM (SELECT {key}, {sql_tokens(text)} AS toks FROM {source})),
{name}_b AS (
  SELECT {key}, list(coalesce(v.id, 0) ORDER BY pos) AS ids
  FROM {name}_t LEFT JOIN vocab v USING (token) GROUP BY {key}),
{name} AS (
  SELECT s.*, list_concat(list_concat({head}, coalesce(b.ids, CAST([] AS INTEGER[]))), {end}) AS input_ids
  FROM {source} s LEFT JOIN {name}_b b ON {same})"""


SQL_ENCODED_LINES = f"{SQL_VOCAB},{SQL_LINES},{sql_encode('enc', 'lines', 'doc_id, line_no', eos=True)}"
SQL_ENCODED_DOCS = f"{SQL_VOCAB},{sql_encode('enc', 'documents', 'doc_id', eos=True)}"

SQL_INSTRUCTIONS = """
systems AS (SELECT conv_id, arg_max(text, turn) AS input FROM conversations WHERE role = 'system' GROUP BY conv_id),
following AS (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
instr AS (
  SELECT f.conv_id, f.turn, f.text AS instruction, s.input, f.next_text AS output
  FROM following f LEFT JOIN systems s USING (conv_id)
  WHERE f.role = 'user' AND f.next_role = 'assistant')"""

def _sql_text(text: str) -> str:
    """A string constant; newlines as ``chr(10)``."""
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


SQL_PROMPT = f"""{_sql_text(T.PROMPT_OPEN + T.SYSTEM_MESSAGE + T.PROMPT_MIDDLE)}
  || CASE WHEN coalesce(input, '') <> '' THEN instruction || chr(10) || input ELSE instruction END || {_sql_text(T.PROMPT_CLOSE)}"""

SQL_PAIRS = f"""{SQL_VOCAB},{SQL_INSTRUCTIONS},
texts AS (SELECT conv_id, turn, {SQL_PROMPT} AS prompt, coalesce(output, 'None') AS answer FROM instr),
{sql_encode('src', 'texts', 'conv_id, turn', text='prompt').strip()},
{sql_encode('tgt', 'texts', 'conv_id, turn', text='answer', bos=False, eos=True).strip()},
pairs AS (
  SELECT s.conv_id, s.turn, s.input_ids AS source_ids, t.input_ids AS target_ids
  FROM src s JOIN tgt t ON s.conv_id = t.conv_id AND s.turn = t.turn)"""


def sql_digest(ids: str) -> str:
    return f"md5(array_to_string({ids}, ','))"
