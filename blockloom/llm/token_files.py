"""Token files compressed by Re-Pair grammars, with random access.

Documents are range-partitioned and sorted by id; each partition is a shard of
blocks. In a block frequent pairs of ids are replaced by nonterminals, again and
again, and the rules are stored with their expansion lengths: a token's place is
found by adding lengths, and only the symbols around it are expanded.

A file is a Parquet file with one row per block:

========== =========================================================
shard      number of the range of ids, ascending
block      number within the shard, ascending
doc_ids    the documents in order
doc_ends   where each ends, in tokens from the block's beginning
n_tokens   tokens of the block
base       first nonterminal; smaller symbols are token ids
rules      pairs of symbols, unsigned 32-bit, little-endian
lengths    tokens that each rule expands to, likewise
symbols    the compressed sequence, likewise
========== =========================================================
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from blockloom.llm.common import text_key
from blockloom.llm.token_ids import encoder
from blockloom.session import scratch_path

#: Tokens after which a block ends, at the next end of a document.
BLOCK_TOKENS = 1 << 18
#: Rounds of replacement, pairs replaced in one, and the least number of places of a pair.
ROUNDS, PAIRS, LEAST = 6, 8192, 4
TEXTS = 256

_FIELDS = [
    ("shard", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int64())), ("n_tokens", pa.int64()),
    ("base", pa.int64()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary()),
]
SCHEMA = "shard int, block int, doc_ids array<long>, doc_ends array<long>, n_tokens long, base long, rules binary, lengths binary, symbols binary"


_SLOT_BITS = 20


def _slot(pairs: np.ndarray) -> np.ndarray:
    return (pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def compress(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Base, rules, expansion lengths and symbols of a block of ids.

    Each round replaces the most frequent pairs together; where places overlap,
    the left one of two is replaced."""
    base = int(ids.max()) + 1 if len(ids) else 0
    symbols = ids.astype(np.uint64)
    rules: list[np.ndarray] = []
    lengths = np.zeros(0, np.uint32)
    made = 0
    for _ in range(ROUNDS):
        if len(symbols) < 2:
            break
        pairs = symbols[:-1] << np.uint64(32) | symbols[1:]
        ordered = np.sort(pairs)
        edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        counts = np.diff(np.append(edges, len(ordered)))
        often = np.flatnonzero(counts >= LEAST)
        if not len(often):
            break
        if len(often) > PAIRS:
            often = often[np.argsort(-counts[often], kind="stable")[:PAIRS]]
        chosen = np.sort(ordered[edges[often]])
        # the chosen pairs by a hash; of two with the same one waits for the next round
        slots = np.full(1 << _SLOT_BITS, -1, np.int32)
        slots[_slot(chosen)] = np.arange(len(chosen))
        at = slots[_slot(pairs)]
        hit = chosen[at] == pairs  # an empty slot, -1, looks at the last pair, which is no harm
        # every second place of a run of neighbouring hits
        places = np.flatnonzero(hit)
        starts = np.append(True, np.diff(places) > 1)
        run_start = places[np.flatnonzero(starts)][np.cumsum(starts) - 1]
        places = places[(places - run_start) % 2 == 0]
        used, rule = np.unique(at[places], return_inverse=True)
        symbols[places] = np.uint64(base + made) + rule.astype(np.uint64)
        symbols = np.delete(symbols, places + 1)
        new = np.stack([chosen[used] >> np.uint64(32), chosen[used] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
        sizes = np.where(new >= base, lengths[np.maximum(new.astype(np.int64) - base, 0)] if made else 1, 1).astype(np.uint32)
        lengths = np.append(lengths, sizes.sum(axis=1, dtype=np.uint32))
        rules.append(new)
        made += len(new)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return base, table, lengths, symbols.astype(np.uint32)


def expand(symbols: np.ndarray, base: int, rules: np.ndarray) -> np.ndarray:
    """Symbols as ids again: nonterminals give way to their pairs until none is left."""
    while True:
        made = symbols >= base
        if not made.any():
            return symbols
        width = 1 + made.astype(np.int64)
        at = (np.cumsum(width) - width)[made]
        pairs = rules[symbols[made] - np.uint32(base)]
        symbols = np.repeat(symbols, width)
        symbols[at], symbols[at + 1] = pairs[:, 0], pairs[:, 1]


def _stored(row: dict) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    read = lambda b: np.frombuffer(b, "<u4")
    return read(row["symbols"]), row["base"], read(row["rules"]).reshape(-1, 2), read(row["lengths"])


def read_range(row: dict, low: int, high: int) -> np.ndarray:
    """Tokens ``low`` to ``high`` of a stored block, expanding only what covers them."""
    symbols, base, rules, lengths = _stored(row)
    size = np.ones(len(symbols), np.int64)
    made = symbols >= base
    size[made] = lengths[symbols[made] - np.uint32(base)]
    ends = np.cumsum(size)
    low, high = max(0, low), min(high, int(ends[-1]) if len(ends) else 0)
    if low >= high:
        return np.zeros(0, np.uint32)
    first, last = np.searchsorted(ends, low, side="right"), np.searchsorted(ends, high, side="left")
    begin = int(ends[first] - size[first])
    return expand(symbols[first : last + 1], base, rules)[low - begin : high - begin]


def write_token_files(documents: DataFrame, path: str, tokenizer: str, rule: str | None, end: int) -> None:
    """Encode every text, append ``end``, and write the files in ascending id order.

    Null texts are empty: their document is the end id alone. Null ids come first;
    rows of one id are ordered by their texts' hash, and repeated rows are written
    each. An empty table writes no block.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, rule)
        shard = TaskContext.get().partitionId()
        parts: list[np.ndarray] = []
        ids: list[int | None] = []
        ends: list[int] = []
        block = 0

        def flush() -> pa.RecordBatch:
            nonlocal block
            base, rules, lengths, symbols = compress(np.concatenate(parts))
            values = (shard, block, list(ids), list(ends), ends[-1], base, rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), symbols.astype("<u4").tobytes())
            parts.clear(), ids.clear(), ends.clear()
            block += 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(values, _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])

        closing = np.array([end], np.uint32)
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS):
                some = batch.slice(a, TEXTS)
                for doc, found in zip(some.column(0).to_pylist(), coder.encode(some.column(1).to_pylist()), strict=True):
                    parts += [found, closing]
                    ids.append(doc)
                    ends.append((ends[-1] if ends else 0) + len(found) + 1)
                    if ends[-1] >= BLOCK_TOKENS:
                        yield flush()
        if ids:
            yield flush()

    spark = documents.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), text_key().alias("tkey"), F.rand(1).alias("salt"))
    ranged = keyed.repartitionByRange(shards, "doc_id", "tkey", "salt").sortWithinPartitions("doc_id", "tkey", "salt").select("doc_id", "text")
    ranged.mapInArrow(pack, SCHEMA).write.option("compression", "zstd").parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            symbols, base, rules, _ = _stored(row)
            raw = expand(symbols, base, rules).astype("<u4").tobytes()
            ends = row["doc_ends"]
            starts = [0, *ends[:-1]]
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()),
                    pa.array([b - a for a, b in zip(starts, ends, strict=True)], pa.int64()), pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ],
                names=["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold, per document: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32`` of its ids."""
    files = spark.read.schema(SCHEMA).parquet(path)
    blocks = files.select("shard", "block", "n_tokens")
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens")).select("shard", before(W.orderBy("shard")).alias("shard_start"))  # a row per shard
    starts = blocks.select("shard", "block", before(W.partitionBy("shard").orderBy("block")).alias("block_start")).join(shards, "shard")
    documents = files.drop("n_tokens").mapInArrow(_digests, "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return documents.join(starts, ["shard", "block"]).select("doc_id", (F.col("shard_start") + F.col("block_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_file_digests(documents: DataFrame, tokenizer: str, rule: str | None, end: int) -> DataFrame:
    """Write the files to a new folder in the shared space and read them back."""
    spark = documents.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(documents, path, tokenizer, rule, end)
    return read_documents(spark, path)
