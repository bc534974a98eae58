"""Benchmark decontamination by winnowing.

From every ``WINDOW - GRAM + 1`` consecutive k-gram hashes the smallest is kept
(the rightmost of equal ones). Two texts that share ``WINDOW`` words in a row
keep the same k-gram inside them, so joining the kept hashes and extending every
hit to both sides finds all shared windows. Items shorter than a window are one
window as a whole and are looked up by the hash of all their words.

Documents are read once. A bit table of fixed size, made from the benchmark's
hashes, drops most document hashes before anything is shuffled; what passes is
joined exactly and then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from blockloom.llm.common import _MIX, ALNUM, Words, bit_table, has_bit, keep, mix, release, rows_by_key, same, sliced, text_key

WINDOW = 13
GRAM = 9
#: Words kept on either side of a k-gram: no window around it reaches further.
SIDE = WINDOW - GRAM

_SCAN = "doc_id long, tkey long, n_words long, fp long, at array<int>, before int, context string"
_ITEMS = "item string, fp long, length int, before int, context string"


def _kept_grams(words: Words) -> np.ndarray:
    """Word numbers at which a winnowed k-gram begins."""
    grams = words.grams(GRAM)
    span = WINDOW - GRAM + 1
    n = max(0, len(words.hash) - WINDOW + 1)
    if not n:
        return np.zeros(0, np.int64)
    least = grams[:n].copy()
    for i in range(1, span):
        np.minimum(least, grams[i : i + n], out=least)
    valid = words.inside(WINDOW)
    chosen = np.zeros(len(grams), bool)
    for i in range(span - 1, -1, -1):
        hit = valid & (grams[i : i + n] == least)
        chosen[i : i + n] |= hit
        valid &= ~hit
    return np.flatnonzero(chosen)


def _whole(hashes: np.ndarray) -> np.ndarray:
    """Hash of short items, told apart from k-grams; one row of word hashes each."""
    k = hashes.shape[-1]
    return mix((hashes * _MIX[16 : 16 + k]).sum(axis=-1, dtype=np.uint64) + np.uint64(k))


def _scan_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = batch.column(0).to_pylist()
        for a, _, data, offsets in sliced(batch.column(1)):
            words = Words(data, offsets, ALNUM)
            rows = []
            grams = words.grams(GRAM)
            for i in _kept_grams(words):
                d = words.doc[i]
                low, high = max(words.first[d], i - SIDE), min(words.first[d + 1], i + WINDOW)
                rows.append((items[a + d], grams[i].astype(np.int64), WINDOW, i - low, words.text(low, high)))
            for d in np.flatnonzero((words.count > 0) & (words.count < WINDOW)):
                low, high = words.first[d], words.first[d + 1]
                rows.append((items[a + d], _whole(words.hash[low:high]).astype(np.int64), high - low, 0, words.text(low, high)))
            yield _batch(rows, ["item", "fp", "length", "before", "context"], [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string()])


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def item_fingerprints(benchmark: DataFrame) -> DataFrame:
    """One row per kept k-gram of an item, with the words around it; the whole
    item where it is shorter than a window. Ids are strings, a null id ''."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return items.mapInArrow(_scan_items, _ITEMS).distinct()


def _scan_documents(documents: DataFrame, prints: DataFrame) -> DataFrame:
    """For each document a row with its number of words and rows for the kept
    hashes that may be the benchmark's."""
    shared = documents.sparkSession.sparkContext.broadcast(bit_table(prints, "fp"))
    lengths = sorted(r.length for r in prints.select("length").where(F.col("length") < WINDOW).distinct().collect())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value

        names = ["doc_id", "tkey", "n_words", "fp", "at", "before", "context"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.string()]
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, _, data, offsets in sliced(batch.column(2)):
                words = Words(data, offsets, ALNUM)
                rows = [(ids[a + d], keys[a + d], n, None, None, None, None) for d, n in enumerate(words.count.tolist())]
                at = _kept_grams(words)
                prints_here = words.grams(GRAM)[at]
                passed = has_bit(table, prints_here)
                for i, h in zip(at[passed].tolist(), prints_here[passed].astype(np.int64).tolist(), strict=True):
                    d = words.doc[i]
                    low, high = max(words.first[d], i - SIDE), min(words.first[d + 1], i + WINDOW)
                    rows.append((ids[a + d], keys[a + d], None, h, [i - words.first[d]], i - low, words.text(low, high)))
                for k in lengths:
                    places: dict[tuple[int, int], list[int]] = {}
                    n = max(0, len(words.hash) - k + 1)
                    total = np.zeros(n, np.uint64)
                    for j in range(k):
                        total += words.hash[j : j + n] * _MIX[16 + j]
                    hashes = mix(total + np.uint64(k))
                    for i in np.flatnonzero(has_bit(table, hashes) & words.inside(k)).tolist():
                        places.setdefault((int(words.doc[i]), int(hashes[i])), []).append(i)
                    for (d, h), found in places.items():
                        rows.append((ids[a + d], keys[a + d], None, h - (1 << 64) * (h >> 63), [i - words.first[d] for i in found], 0, words.text(found[0], found[0] + k)))
                yield _batch(rows, names, types)

    picked = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tkey"), F.coalesce("text", F.lit("")).alias("text"))
    return picked.mapInArrow(scan, _SCAN)


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates to runs of equal words at least a window long."""
    for batch in batches:
        x = batch.to_pydict()
        rows = []
        for doc, key, at, before, context, item, length, item_before, item_context in zip(*(x[c] for c in batch.schema.names), strict=True):
            ours, theirs = context.split(" "), item_context.split(" ")
            if length < WINDOW:
                rows += [(doc, key, item, i, i + length) for i in at] if ours == theirs else []
                continue
            a, b = before, item_before
            right = 0
            for p, q in zip(ours[a:], theirs[b:], strict=False):
                if p != q:
                    break
                right += 1
            if right < GRAM:
                continue  # equal hashes of different words
            left = 0
            while left < min(a, b) and ours[a - left - 1] == theirs[b - left - 1]:
                left += 1
            if left + right >= WINDOW:
                rows.append((doc, key, item, at[0] - left, at[0] + right))
        yield _batch(rows, ["doc_id", "tkey", "item", "low", "high"], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()])


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document row: ``doc_id``, ``tkey`` (hash of the text), ``n_words``,
    ``n_hit`` (words inside windows of items), ``n_items``, ``items_sha256``,
    ``contaminated`` (a hit, and a twentieth of the words or more are hit).

    Null and empty texts have no words and are clean. Rows with equal id and text
    each get their row, with equal values; a null id is a value of its own.
    Other columns of the inputs are ignored, whatever their names. An empty
    benchmark leaves everything clean.
    """
    prints = keep(item_fingerprints(benchmark), "item-prints")
    scanned = keep(_scan_documents(documents, prints), "document-prints")
    ours = scanned.where("fp is not null").select("doc_id", "tkey", "fp", "at", "before", "context")
    theirs = prints.select("fp", "item", "length", F.col("before").alias("item_before"), F.col("context").alias("item_context"))
    candidates = ours.join(theirs, "fp").select("doc_id", "tkey", "at", "before", "context", "item", "length", "item_before", "item_context")
    runs = candidates.mapInArrow(_extend, "doc_id long, tkey long, item string, low long, high long").distinct()
    runs = keep(runs, "hits")
    release(prints)
    by_document = W.partitionBy("doc_id", "tkey").orderBy("low", "high")
    reach = F.coalesce(F.max("high").over(by_document.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    hit = (
        runs.select("doc_id", "tkey", "low", "high").distinct()
        .select("doc_id", "tkey", F.greatest(F.lit(0), F.col("high") - F.greatest("low", reach)).alias("new"))
        .groupBy("doc_id", "tkey").agg(F.sum("new").alias("n_hit"))
    )
    items = runs.groupBy("doc_id", "tkey").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = hit.alias("h").join(items.alias("i"), same(F.col("h.doc_id"), F.col("i.doc_id")) & (F.col("h.tkey") == F.col("i.tkey"))).select(
        F.col("h.doc_id").alias("found_id"), F.col("h.tkey").alias("found_key"), "n_hit", "items"
    )
    base = scanned.where("fp is null").select("doc_id", "tkey", "n_words")
    joined = base.join(found, same(F.col("doc_id"), F.col("found_id")) & (F.col("tkey") == F.col("found_key")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(
        "doc_id",
        "tkey",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", F.array().cast("array<string>")), ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns and rows as they are, without contaminated ones."""
    return rows_by_key(documents, contamination(documents, benchmark).where("contaminated"), "left_anti")
