"""Best-fit packing improved by swaps.

Documents become pieces of at most ``CAPACITY`` tokens. Pieces are dealt into
groups of bounded size at random; a group is packed best-fit, longest first, and
then searched: the least filled sequence gives documents to fuller ones by
moves, one-for-one, two-for-one and one-for-two exchanges, each of which raises
the sum of squared fills, until it is empty or nothing helps. The least filled
sequences of many groups meet again on a next level, until one group is left.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from blockloom.llm.common import keep, release
from blockloom.llm.token_ids import encoder

CAPACITY = 4096
#: Pieces of a group on average, open sequences that a group hands on, groups that meet.
GROUP_PIECES, HANDED_ON, MEET = 16_000, 16, 32
#: Steps of one group's search; sizes that fill no sequence well could go on for long.
ATTEMPTS = 5_000
TEXTS = 256

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, tokenizer: str, rule: str | None, end: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Documents' ids with ``end`` appended, cut only where longer than ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, rule)
        closing = np.array([end], np.uint32)
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS):
                some = batch.slice(a, TEXTS)
                rows: list[tuple] = []
                for doc, found in zip(some.column(0).to_pylist(), coder.encode(some.column(1).to_pylist()), strict=True):
                    ids = np.concatenate([found, closing])
                    for i, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at : at + capacity]
                        rows.append((doc, i, at, len(part), zlib.crc32(part.astype("<u4").tobytes()), part))
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                if with_ids:
                    names, arrays = [*names, "ids"], [*arrays, pa.array([r[5] for r in rows], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    picked = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return picked.mapInArrow(cut, _PIECES + (", ids array<long>" if with_ids else ""))


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each size: longest first, into the fullest bin with room."""
    bins = np.zeros(len(sizes), np.int64)
    room: list[tuple[int, int]] = []  # (free, bin), ascending
    made = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, made
            made += 1
        bins[i] = b
        if free > size:
            insort(room, (free - size, b))
    return bins


def _pairs_of(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.triu_indices(len(members), 1)
    return members[a], members[b]


def improve(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Local search from a packing; bins are emptied, never added."""
    bins = bins.copy()
    fill = np.bincount(bins, weights=sizes).astype(np.int64)
    least = -(-int(sizes.sum()) // capacity)
    stuck = np.zeros(len(fill), bool)
    for _ in range(ATTEMPTS):
        used = np.flatnonzero(fill > 0)
        if len(used) <= least:
            return bins  # no packing has fewer
        able = used[(fill[used] < capacity) & ~stuck[used]]
        if len(able) < 2:
            return bins
        poor = int(able[np.argmin(fill[able])])
        if _give(sizes, bins, fill, poor, capacity):
            stuck[:] = False  # others may find a partner now
        else:
            stuck[poor] = True
    return bins


def _give(sizes: np.ndarray, bins: np.ndarray, fill: np.ndarray, poor: int, capacity: int) -> bool:
    """One step by which ``poor`` hands as much as possible to fuller bins; false if there is none."""
    own = np.flatnonzero(bins == poor)
    open_bins = np.flatnonzero((fill >= fill[poor]) & (fill < capacity))
    open_bins = open_bins[open_bins != poor]
    if not len(open_bins) or not len(own):
        return False
    free = capacity - fill
    # a move: the largest document that fits, into the fullest bin it fits
    for x in own[np.argsort(-sizes[own])]:
        fits = open_bins[free[open_bins] >= sizes[x]]
        if len(fits):
            to = int(fits[np.argmin(free[fits])])
            _shift(sizes, bins, fill, [x], to)
            return True
    is_open = np.zeros(len(fill), bool)
    is_open[open_bins] = True
    theirs = np.flatnonzero(is_open[bins])
    room, back = free[bins[theirs]], sizes[theirs]
    best: tuple[int, list[int], list[int]] = (0, [], [])
    singles = [([int(x)], int(sizes[x])) for x in own]
    doubles = [([int(x), int(y)], int(sizes[x] + sizes[y])) for x, y in zip(*_pairs_of(own), strict=True)] if len(own) < 64 else []
    for given, weight in singles + doubles:
        gain = np.where((weight > back) & (weight - back <= room), weight - back, 0)
        i = int(np.argmax(gain))
        if gain[i] > best[0]:
            best = (int(gain[i]), given, [int(theirs[i])])
    # one for two of theirs: the pairs of each open bin
    order = theirs[np.argsort(bins[theirs], kind="stable")]
    for skip in range(1, 8):
        first, second = order[:-skip], order[skip:]
        together = bins[first] == bins[second]
        first, second = first[together], second[together]
        if not len(first):
            break
        both, space = sizes[first] + sizes[second], free[bins[first]]
        for given, weight in singles:
            gain = np.where((weight > both) & (weight - both <= space), weight - both, 0)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (int(gain[i]), given, [int(first[i]), int(second[i])])
    if not best[0]:
        return False
    _, given, taken = best
    to = int(bins[taken[0]])
    _shift(sizes, bins, fill, taken, poor)
    _shift(sizes, bins, fill, given, to)
    return True


def _shift(sizes: np.ndarray, bins: np.ndarray, fill: np.ndarray, items: list, to: int) -> None:
    for i in items:
        fill[bins[i]] -= sizes[i]
        fill[to] += sizes[i]
        bins[i] = to


def _pack_group(capacity: int, last: bool):
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_row", ignore_index=True)
        sizes = part["length"].to_numpy(np.int64)
        bins = improve(sizes, best_fit(sizes, capacity), capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        poorest = np.argsort(np.where((fill > 0) & (fill < capacity), fill, capacity + 1), kind="stable")
        handed = np.zeros(len(fill), bool)
        handed[[b for b in poorest[:HANDED_ON] if 0 < fill[b] < capacity]] = not last
        return part.assign(_bin=bins, _open=handed[bins])

    return pack


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (rows with a ``length`` of 1 to ``capacity``) with ``sequence_id``
    and ``offset``; every row is in exactly one sequence.

    Rows are stored with a number each, by which they are dealt into groups, so
    equal rows and hot ids spread evenly. Group sizes do not grow with the input.
    """
    own = [c for c in found.columns if c not in ("sequence_id", "offset")]
    todo = keep(found.select(*own, F.monotonically_increasing_id().alias("_row")), "pieces")
    groups = max(1, -(-todo.count() // GROUP_PIECES))
    schema = f"{', '.join(f'`{n}` {t}' for n, t in todo.dtypes)}, _group long, _bin long, _open boolean"
    open_rows = todo.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    closed, level = [], 0
    while True:
        packed = keep(open_rows.groupBy("_group").applyInPandas(_pack_group(capacity, groups == 1), schema), "packed")
        number = (F.lit(level) * (1 << 56) + F.col("_group") * (1 << 20) + F.col("_bin")).cast("long")
        closed.append(packed.where(~F.col("_open")).withColumn("sequence_id", number).drop("_bin", "_open", "_group"))
        if level == 0:
            release(todo)
        if groups == 1:
            break
        groups, level = -(-groups // MEET), level + 1
        open_rows = packed.where("_open").drop("_bin", "_open").withColumn("_group", F.pmod("_group", F.lit(groups)))
    whole = closed[0]
    for more in closed[1:]:
        whole = whole.unionByName(more)

    before = F.sum("length").over(W.partitionBy("sequence_id").orderBy("_row").rowsBetween(W.unboundedPreceding, -1))
    return whole.withColumn("offset", F.coalesce(before, F.lit(0)).cast("long")).select(*own, "sequence_id", "offset")


def pack_documents(documents: DataFrame, tokenizer: str, rule: str | None, end: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with their sequences and places.

    Null and empty texts are the end id alone. Rows of one id are packed each.
    An empty table gives no row; columns besides doc_id and text are ignored.
    """
    return pack(pieces(documents, tokenizer, rule, end, capacity, with_ids), capacity)
