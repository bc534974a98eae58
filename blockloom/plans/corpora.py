"""Sources to stored, mixed and split corpora.

Each source is processed and stored once; mixing and splitting read the stored
results, so other weights never mean tokenising again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.operators.instruct import END_TOKENS, instruction_examples
from blockloom.operators.packing import copy_labels, pack_blocks, with_scope
from blockloom.operators.sampling import SEED, check_weight, mix, split_and_shuffle
from blockloom.operators.vocab import Vocabulary, encode
from blockloom.sources.readers import Source, load_source, read_instructions
from blockloom.sources.writers import materialize_once, write_corpus, write_provenance

#: Sources processed at the same time; Spark shares the cluster among them.
PARALLEL_SOURCES = 8


def fingerprint(vocab: Vocabulary) -> int:
    """One number that changes with any entry of the vocabulary."""
    return vocab.table.agg(F.bit_xor(F.xxhash64("token", "id"))).first()[0]


def _named(sources: Sequence[Source]) -> dict[str, Source]:
    """Sources by file stem; equal stems are told apart by their path."""
    stems = [s.stem for s in sources]
    named = {}
    for source in sources:
        name = source.stem
        if stems.count(name) > 1:
            name += "-" + hashlib.md5(f"{source.path}{source.options}".encode()).hexdigest()[:8]
        if name in named:
            raise ValueError(f"source {source.path} is given twice; use its weight instead")
        named[name] = source
    return named


def _process(
    spark: SparkSession, sources: Sequence, out_dir: str, key: dict, build: Callable[[Source], DataFrame]
) -> tuple[DataFrame, dict[str, float]]:
    named = _named([Source.of(s) for s in sources])
    for source in named.values():
        check_weight(source.weight)

    def one(item: tuple[str, Source]) -> DataFrame:
        name, source = item
        facts = key | {"path": source.path, "options": source.options}
        result = lambda: build(source).withColumn("source", F.lit(name))
        return materialize_once(spark, f"{out_dir}/single/{name}", facts, result)

    with ThreadPoolExecutor(PARALLEL_SOURCES) as pool:
        tables = list(pool.map(one, named.items()))
    # One scan over all sources, however many there are.
    merged = spark.read.schema(tables[0].schema).parquet(*[f"{out_dir}/single/{name}/data" for name in named])
    return merged, {name: s.weight for name, s in named.items()}


def merge_sources(
    stored_sources: DataFrame,
    weights: dict[str, float],
    *,
    key: Sequence[str],
    test: float | int | None,
    seed: int = SEED,
) -> DataFrame:
    """Mix, split and shuffle stored sources, told apart by ``source``.

    ``place`` is the row's place in the shuffled order of its split.  Mixing is a
    filter, so that the rows are exchanged once.
    """
    mixed = mix(stored_sources, weights, key=["source", *key], seed=seed)
    return split_and_shuffle(mixed, test=test, key=["source", *key, "copy_no"], seed=seed)


def _finish(
    spark: SparkSession, single: DataFrame, weights: dict, out_dir: str, facts: dict, *, key, test, seed: int
) -> DataFrame:
    merged = merge_sources(single, weights, key=key, test=test, seed=seed)
    rows = merged.select(F.col("place").alias("row_idx"), "input_ids", "labels", "split")
    write_corpus(rows, f"{out_dir}/merged", placed=True)
    write_provenance(spark, f"{out_dir}/provenance", facts | {"weights": weights, "test": str(test), "seed": seed})
    return merged


def build_pretraining_corpus(
    spark: SparkSession,
    sources: Sequence,
    out_dir: str,
    vocab: Vocabulary,
    *,
    block_size: int = 1024,
    test: float | int | None = 0.002,
    seed: int = SEED,
    workers: int = 32,
    batch_rows: int = 1000,
    keep_tail: bool = False,
    merge: bool = True,
) -> DataFrame | None:
    """Text sources to blocks: ``single/<source>`` and ``merged/train|test``.

    Returns the merged corpus, or nothing with ``merge=False``.
    """
    facts = {
        "kind": "blocks",
        "vocabulary": fingerprint(vocab),
        "block_size": block_size,
        "workers": workers,
        "batch_rows": batch_rows,
        "keep_tail": keep_tail,
    }

    def build(source: Source) -> DataFrame:
        rows = load_source(spark, source)
        ids = encode(rows, vocab, key=["file", "row_idx"], keep=["n_rows"], add_bos=True, add_eos=True)
        scoped = with_scope(ids, workers=workers, batch_rows=batch_rows)
        scope = ["file", "shard", "batch"]
        blocks = pack_blocks(
            scoped, block_size=block_size, scope=scope, keep_tail=keep_tail, scope_rows=batch_rows
        )
        return copy_labels(blocks)

    single, weights = _process(spark, sources, out_dir, facts, build)
    if not merge:
        return None
    key = ["file", "shard", "batch", "block"]
    return _finish(spark, single, weights, out_dir, facts, key=key, test=test, seed=seed)


def build_instruction_corpus(
    spark: SparkSession,
    sources: Sequence,
    out_dir: str,
    vocab: Vocabulary,
    *,
    max_len: int = 4096,
    max_target: int = 512,
    mode: str = "head_tail",
    test: float | int | None = 0.05,
    seed: int = SEED,
    merge: bool = True,
) -> DataFrame | None:
    """Instruction sources to masked examples, stored and merged likewise."""
    facts = {
        "kind": "examples",
        "vocabulary": fingerprint(vocab),
        "max_len": max_len,
        "max_target": max_target,
        "mode": mode,
        "end_tokens": END_TOKENS,
    }

    def build(source: Source) -> DataFrame:
        rows = read_instructions(spark, source.path)
        return instruction_examples(
            rows, vocab, key=["file", "row_idx"], max_len=max_len, max_target=max_target, mode=mode
        )

    single, weights = _process(spark, sources, out_dir, facts, build)
    if not merge:
        return None
    return _finish(spark, single, weights, out_dir, facts, key=["file", "row_idx"], test=test, seed=seed)
