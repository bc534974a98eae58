"""The operators as queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm.bin_packing import pack_documents
from blockloom.llm.common import table
from blockloom.llm.decontaminate import contamination
from blockloom.llm.html_extract import extract_text
from blockloom.llm.line_dedup import without_repeats
from blockloom.llm.ngram_join import similar_documents
from blockloom.llm.periodic_runs import periodic_runs
from blockloom.llm.pii import personal_spans
from blockloom.llm.quality import quality_verdicts
from blockloom.llm.secret_scan import joined, secret_spans
from blockloom.llm.sharding import document_shards
from blockloom.llm.token_files import token_file_digests
from blockloom.llm.toxicity import held_out, toxicity, train
from blockloom.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("tkey")


SQL_OP1 = r"""
WITH dw AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)),
n AS (SELECT doc_id, count(*) AS n_words FROM dw GROUP BY doc_id),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[j:j + k - 1], ' ') AS words
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS j FROM iw WHERE len(w) > 0)),
dg AS (
  SELECT k, doc_id, i, words FROM (
    SELECT k, doc_id, i, count(*) OVER w AS c, string_agg(word, ' ') OVER w AS words
    FROM dw, (SELECT DISTINCT k FROM win WHERE k = 13)
    WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) WHERE c = k
  UNION ALL
  SELECT k, doc_id, i, words FROM (
    SELECT s.k, doc_id, i, array_to_string(list_slice(list(word) OVER w, 1, s.k), ' ') AS words, count(*) OVER w AS c
    FROM dw, (SELECT DISTINCT k FROM win WHERE k < 13) s
    WINDOW w AS (PARTITION BY s.k, doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)) WHERE c >= k),
m AS (SELECT doc_id, i, k, item_id FROM dg JOIN win USING (k, words)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, list_sort(list(DISTINCT coalesce(CAST(item_id AS VARCHAR), ''))) AS ids FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(n_words, 0) AS contaminated
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""


QUERIES: dict[str, Query] = {"op1_decontaminate": op1_decontaminate}
ORACLES: dict[str, str] = {"op1_decontaminate": SQL_OP1}


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_verdicts(table(spark, folder, "documents")).drop("tkey", "distance")


QUERIES["op10_quality"] = op10_quality


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return document_shards(table(spark, folder, "documents"))


QUERIES["op4_sharding"] = op4_sharding


def _counts(*kinds: str) -> list[Column]:
    """Base spans of each kind."""
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return list(map(of, kinds))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_spans(table(spark, folder, "documents"))
    return found.select("doc_id", *_counts("assign", "access", "hex"), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


QUERIES["op7_secrets"] = op7_secrets


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_spans(table(spark, folder, "documents"))
    return found.select("doc_id", *_counts("email", "ip", "card", "phone"), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


QUERIES["op6_pii"] = op6_pii


def op2_html(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


QUERIES["op2_html"] = op2_html


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_file_digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), "byte_bpe", 0)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), "word_bpe", 1)


QUERIES["op5_token_files"] = op5_token_files
QUERIES["op8_packing"] = op8_packing


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(table(spark, folder, "documents")).drop("tkey")


SQL_OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(min(r.c), d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id, n.n"""

QUERIES["op3_ngram_join"] = op3_ngram_join
ORACLES["op3_ngram_join"] = SQL_OP3


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"), short=True).select("doc_id", "n_lines", "n_removed", "text")


QUERIES["op9_line_dedup"] = op9_line_dedup


def _planted_period(ids: pa.Array, first: np.ndarray) -> np.ndarray:
    """Every tenth document, told by its id's checksum, repeats a stretch of its words to its end."""
    source = np.arange(first[-1])
    for d, doc_id in enumerate(ids.to_pylist()):
        n = int(first[d + 1] - first[d])
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if n and h % 10 == 0:
            g = h // 10
            a = g % n
            source[first[d] + a : first[d + 1]] = first[d] + a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return source


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(table(spark, folder, "documents"), rewrite=_planted_period)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.shorter")).alias("period"),
        F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES["op13_periodic_runs"] = op13_periodic_runs


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


QUERIES["op11_whitening"] = op11_whitening


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    scored = toxicity(documents, train(documents, table(spark, folder, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES["op12_toxicity"] = op12_toxicity
