"""From raw documents to packed training sequences, in five stored stages."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from blockloom.llm.bin_packing import pack_documents
from blockloom.llm.common import table
from blockloom.llm.decontaminate import drop_contaminated
from blockloom.llm.line_dedup import dedup_lines
from blockloom.llm.ngram_join import one_of_each
from blockloom.llm.quality import keep_good
from blockloom.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are no outlier of their language and source."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line but the first of its component goes, and with its last line a document."""
    return dedup_lines(docs, short=True)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return one_of_each(docs, gram=5, similar=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces of sequences of 4,096 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), "word_bpe", 1)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: The stages are fitted, hashed and searched, which SQL cannot say; the tests of the
#: operators hold each against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
