"""Vocabulary, encoding, decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.functions.arrays import mask_labels
from blockloom.operators import vocab as V
from blockloom.queries.registry import (
    SQL_ENCODED_DOCS,
    SQL_ENCODED_LINES,
    SQL_PAIRS,
    SQL_VOCAB,
    digest,
    encoded_docs,
    encoded_lines,
    lines,
    pairs,
    query,
    spread,
    sql_digest,
    sql_tokens,
    sql_vocab,
    table,
    trained_vocabulary,
    vocabulary,
)


@query("build_vocab", f"WITH {SQL_VOCAB} SELECT token, id FROM vocab")
def build_vocab(spark: SparkSession, d: str) -> DataFrame:
    return trained_vocabulary(spark, d).table


@query("build_vocab_uncapped", f"WITH {sql_vocab(None)} SELECT token, id FROM vocab")
def build_vocab_uncapped(spark: SparkSession, d: str) -> DataFrame:
    """Every word of the documents."""
    return trained_vocabulary(spark, d, None).table


#: Entries handed to every task where a query shows what a larger vocabulary does.
FEW = 1_000

_ENCODED = f"""WITH {SQL_ENCODED_LINES}
    SELECT doc_id, line_no, CAST(len(input_ids) AS INTEGER) AS n_ids, {sql_digest('input_ids')} AS ids_md5 FROM enc"""


@query("encode", _ENCODED)
def encode(spark: SparkSession, d: str) -> DataFrame:
    return encoded_lines(spark, d).select(
        "doc_id", "line_no", F.size("input_ids").alias("n_ids"), digest(F.col("input_ids")).alias("ids_md5")
    )


@query("encode_patched", _ENCODED)
def encode_patched(spark: SparkSession, d: str) -> DataFrame:
    """As ``encode``, with a vocabulary of more entries than tasks are handed."""
    ids = V.encode(lines(spark, d), vocabulary(spark, d), key=["doc_id", "line_no"], add_eos=True, broadcast_rows=FEW)
    return ids.select("doc_id", "line_no", F.size("input_ids").alias("n_ids"), digest(F.col("input_ids")).alias("ids_md5"))


_LABELS = f"""{SQL_PAIRS},
labelled AS (
  SELECT conv_id, turn, list_concat(list_transform(source_ids, lambda x: -100), target_ids) AS labels FROM pairs),
pos AS (SELECT conv_id, turn, unnest(labels) AS id, generate_subscripts(labels, 1) AS pos FROM labelled)"""


_SHOWN = f"""WITH {_LABELS}
    SELECT conv_id, turn, CAST(count(*) AS INTEGER) AS n,
      string_agg(CASE WHEN id = -100 THEN 'igx' ELSE token END, '|' ORDER BY pos) AS shown
    FROM pos LEFT JOIN vocab USING (id) GROUP BY conv_id, turn"""


def _shown(spark: SparkSession, d: str, broadcast_rows: int) -> DataFrame:
    labels = pairs(spark, d).select(
        "conv_id", "turn", mask_labels(F.col("source_ids"), F.col("target_ids")).alias("labels")
    )
    shown = V.decode(labels, vocabulary(spark, d), ids="labels", key=["conv_id", "turn"], broadcast_rows=broadcast_rows)
    return shown.select(
        "conv_id", "turn", F.size("tokens").alias("n"), F.array_join("tokens", "|").alias("shown")
    )


@query("decode_tokens", _SHOWN)
def decode_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _shown(spark, d, V.BROADCAST_ROWS)


@query("decode_tokens_patched", _SHOWN)
def decode_tokens_patched(spark: SparkSession, d: str) -> DataFrame:
    """As ``decode_tokens``, with a vocabulary of more entries than tasks are handed."""
    return _shown(spark, d, FEW)


@query(
    "decode_text_uncapped",
    f"SELECT doc_id, md5(array_to_string({sql_tokens('text')}, ' ')) AS text_md5 FROM documents",
)
def decode_text_uncapped(spark: SparkSession, d: str) -> DataFrame:
    """Every document there and back: no word is unknown."""
    vocab = vocabulary(spark, d, None)
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    ids = V.encode(docs, vocab, key=["doc_id"], add_bos=False, broadcast_rows=FEW)
    texts = V.decode_text(ids, vocab, ids="input_ids", key=["doc_id"], broadcast_rows=FEW)
    return texts.select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "decode_text",
    f"""WITH {_LABELS}
    SELECT conv_id, turn, string_agg(token, ' ' ORDER BY pos) AS text
    FROM (SELECT conv_id, turn, pos, CASE WHEN id = -100 THEN 0 ELSE id END AS id FROM pos)
    LEFT JOIN vocab USING (id) GROUP BY conv_id, turn""",
)
def decode_text(spark: SparkSession, d: str) -> DataFrame:
    labels = pairs(spark, d).select(
        "conv_id", "turn", mask_labels(F.col("source_ids"), F.col("target_ids")).alias("labels")
    )
    return V.decode_text(labels, vocabulary(spark, d), ids="labels", key=["conv_id", "turn"])


@query(
    "overlong_report",
    f"""WITH {SQL_ENCODED_DOCS}
    SELECT source, count(*) AS n_overlong, max(len(input_ids)) AS longest
    FROM enc WHERE len(input_ids) > 512 GROUP BY source""",
)
def overlong_report(spark: SparkSession, d: str) -> DataFrame:
    return V.overlong(encoded_docs(spark, d), 512)


@query(
    "resolve_block_size",
    """SELECT doc_id, CAST(CASE WHEN n_chars % 3 = 0 THEN 1024 ELSE least(n_chars, 2048) END AS BIGINT) AS block_size
       FROM documents""",
)
def resolve_block_size(spark: SparkSession, d: str) -> DataFrame:
    """Each document asks for a block size, a third of them for none."""
    asked = F.when(F.col("n_chars") % 3 != 0, F.col("n_chars"))
    return table(spark, d, "documents").select("doc_id", V.resolve_block_size(asked, 2048).cast("bigint").alias("block_size"))
