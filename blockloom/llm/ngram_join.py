"""N-gram Jaccard join by rare-first prefix filtering.

Texts with equal sets of shingles form a class; classes are joined.

1. A class with too many shingles that no other class has cannot link: counted
   on the shingles in a fixed part of the hash range, this leaves out most
   classes, and never one that links.
2. The shingles of the rest are ordered by how many classes have them, rare
   first. Linked sets share a shingle within their prefixes, the first
   ``n - ceil(T n) + 1`` of that order. Shingles of one class only are not joined
   but hold their places.
3. Prefix entries are joined on the shingle under the length filter and the
   positional filter: what follows two places bounds the overlap. Sets are also
   cut by the shingle's bits into parts that are counted; parts bound the
   overlap of suffixes.
4. Each pair is verified once on the whole sets.

Components need no pair within a component found before. Every bucket's
entries are first paired with its most central one, then only pairs across the
components of those links are joined. No link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import SPACED, Words, bit_table, has_bit, keep, mix, release, rows_by_key, same, sliced, text_key
from blockloom.llm.components import components, first_pairs, remaining_pairs

GRAM = 4
#: Similarity in hundredths.
SIMILAR = 85
#: Part of the hash range that step 1 counts.
SAMPLED = 0.25
#: Parts for the suffix filter.
PARTS = 16


def _sets(words: Words, gram: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    grams = words.grams(gram)
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if high - low >= gram:
            yield np.unique(grams[low : high - gram + 1])
        elif high > low:  # fewer words: the whole sequence
            yield mix((words.hash[low:high] * np.arange(3, 3 + 2 * (high - low), 2, dtype=np.uint64)).sum(dtype=np.uint64, keepdims=True) + np.uint64(high - low))
        else:
            yield np.zeros(0, np.uint64)


def _class(shingles: np.ndarray) -> int:
    """A set's hash, which names its class."""
    return int(mix(mix(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles)))[0].astype(np.int64))


def _list_array(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _picked(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tkey"), F.coalesce("text", F.lit("")).alias("text"))


def _classes(documents: DataFrame, gram: int) -> DataFrame:
    """``doc_id``, ``tkey``, ``class`` and ``n_shingles`` of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(_class(s), len(s)) for _, _, data, offsets in sliced(batch.column(2)) for s in _sets(Words(data, offsets, SPACED), gram)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c for c, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], names=["doc_id", "tkey", "class", "n_shingles"]
            )

    return _picked(documents).mapInArrow(scan, "doc_id long, tkey long, class long, n_shingles long")


def _sampled(documents: DataFrame, gram: int) -> DataFrame:
    """``class`` and each of its shingles in the lowest part of the hash range."""
    limit = np.uint64(int(SAMPLED * 2**64))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in sliced(batch.column(2)):
                sets = list(_sets(Words(data, offsets, SPACED), gram))
                low = [s[: np.searchsorted(s, limit)] for s in sets]
                of = np.repeat(np.array([_class(s) for s in sets], np.int64), [len(x) for x in low])
                flat = np.concatenate(low).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(flat)], names=["class", "shingle"])

    return _picked(documents).mapInArrow(scan, "class long, shingle long")


def _least_overlap(n: Column, m: Column, similar: int) -> Column:
    """What sets of these sizes share at least, if they link."""
    return F.ceil(similar * (n + m) / F.lit(100 + similar))


def _own_part(n: Column, similar: int) -> Column:
    """What a linked set has beyond the other at most."""
    return n - F.ceil(similar * n / F.lit(100))


def _arrays(documents: DataFrame, chosen: DataFrame, gram: int) -> DataFrame:
    """``node`` (class), its sorted ``shingles``, their number ``n`` and how many
    fall into each of the ``parts``, for the chosen rows (doc_id, tkey, class).
    A bit table of fixed size lets most other rows go before the exact join."""
    shared = documents.sparkSession.sparkContext.broadcast(bit_table(chosen, "class"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, data, offsets in sliced(batch.column(2)):
                sets = list(_sets(Words(data, offsets, SPACED), gram))
                names = np.array([_class(s) for s in sets], np.int64)
                kept = np.flatnonzero(has_bit(shared.value, names.view(np.uint64)))
                rows = pa.array(a + kept)
                parts = [np.bincount((sets[i] & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS) for i in kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows), pa.array(names[kept]), _list_array([sets[i] for i in kept]),
                        pa.array([len(sets[i]) for i in kept], pa.int64()), pa.array(parts, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "tkey", "node", "shingles", "n", "parts"],
                )

    found = _picked(documents).mapInArrow(scan, "doc_id long, tkey long, node long, shingles array<long>, n long, parts array<long>")
    named = chosen.select(F.col("doc_id").alias("of_id"), F.col("tkey").alias("of_key"), "class")
    on = (F.col("node") == F.col("class")) & (F.col("tkey") == F.col("of_key")) & same(F.col("doc_id"), F.col("of_id"))
    return found.join(named, on, "left_semi").drop("doc_id", "tkey").dropDuplicates(["node"])  # repeated rows have equal sets


def _entries(sets: DataFrame, similar: int) -> DataFrame:
    """Prefix entries: ``key`` (a shingle that several classes have), ``node``,
    ``n``, ``parts`` and ``place`` in the rare-first order."""
    each = sets.select("node", F.explode("shingles").alias("key"))
    often = each.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    shared = each.join(often, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("shared"))
    lone = F.col("n") - F.size("shared")  # shingles of this class alone come first
    prefix = F.slice("shared", F.lit(1), F.greatest(F.lit(0), _own_part(F.col("n"), similar) + 1 - lone).cast("int"))
    placed = shared.join(sets.drop("shingles"), "node").select("node", "n", "parts", lone.alias("lone"), F.posexplode(prefix).alias("at", "entry"))
    return placed.select("node", "n", "parts", (F.col("lone") + F.col("at")).alias("place"), F.col("entry.key").alias("key"))


def _may_link(similar: int) -> Column:
    """Length, positional and suffix filter between an entry and another (``p_``).

    A linked pair passes at its first common shingle, before which the two share
    nothing; other common shingles need not let it pass."""
    n, m = F.col("n"), F.col("p_n")
    need = _least_overlap(n, m, similar)
    after = F.least(n - F.col("place"), m - F.col("p_place"))
    parts = F.aggregate(F.zip_with("parts", "p_parts", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda a, x: a + x)
    return (100 * F.least(n, m) >= similar * F.greatest(n, m)) & (after >= need) & (parts >= need)


def _links(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    left, right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where(100 * both >= similar * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _members(documents: DataFrame, gram: int, similar: int) -> DataFrame:
    """``doc_id``, ``tkey``, ``n_shingles`` and ``component`` (of classes) of every row."""
    classes = keep(_classes(documents, gram), "classes")
    own = _sampled(documents, gram).groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low = high")
    lone = own.groupBy("low").agg(F.count("*").alias("lone"))
    sizes = classes.where("n_shingles > 0").groupBy("class").agg(F.min_by(F.struct("doc_id", "tkey"), F.struct("doc_id", "tkey")).alias("r"), F.max("n_shingles").alias("n"))
    chosen = keep(
        sizes.join(lone, F.col("class") == F.col("low"), "left").where(F.coalesce("lone", F.lit(0)) <= _own_part(F.col("n"), similar)).select("r.doc_id", "r.tkey", "class"), "chosen"
    )
    sets = keep(_arrays(documents, chosen, gram), "sets")
    entries = keep(_entries(sets, similar), "entries")
    release(chosen)
    near = keep(_links(first_pairs(entries, ["place", "n"], _may_link(similar)), sets, similar), "links")
    found = components(near)
    far = keep(_links(remaining_pairs(entries, found, _may_link(similar)), sets, similar), "links")
    if not far.isEmpty():
        release(found)
        found = components(near.unionByName(far))
    release(sets, entries, near, far)
    named = classes.join(found, F.col("class") == F.col("node"), "left").select("doc_id", "tkey", "n_shingles", F.coalesce("component", "class").alias("component"))
    named = keep(named, "members")
    release(classes, found)
    return named


def similar_documents(documents: DataFrame, gram: int = GRAM, similar: int = SIMILAR) -> DataFrame:
    """Per row ``doc_id``, ``tkey``, ``n_shingles`` and ``component_id``, the least
    id that links reach.

    Null and empty texts have no shingles and link with nothing; texts of fewer
    words than a shingle link with equal ones. Repeated rows each get their row;
    null ids never are the least. Other columns are ignored. Classes and shingles
    are told apart by 64-bit hashes.
    """
    named = _members(documents, gram, similar)
    least = named.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    linked = named.where("n_shingles > 0").join(least, "component").select("doc_id", "tkey", "n_shingles", F.col("least").alias("component_id"))
    return linked.unionByName(named.where("n_shingles = 0").select("doc_id", "tkey", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(documents: DataFrame, gram: int = GRAM, similar: int = SIMILAR) -> DataFrame:
    """The documents, columns as they are, one row of each component: the least
    id's, and of several texts under that id the one with the least text hash.
    Rows that link with nothing stay, empty ones included."""
    members = _members(documents, gram, similar).where("n_shingles > 0")
    best = members.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey")).alias("best"), F.count("*").alias("n"))
    extra = (
        members.alias("m").join(best.where("n > 1").alias("b"), F.col("m.component") == F.col("b.component"))
        .where(~(same(F.col("m.doc_id"), F.col("best.doc_id")) & (F.col("m.tkey") == F.col("best.tkey"))))
        .select(F.col("m.doc_id").alias("doc_id"), F.col("m.tkey").alias("tkey"))
    )
    kept = rows_by_key(documents, extra, "left_anti")
    again = members.groupBy("doc_id", "tkey").agg(F.count("*").alias("n")).where("n > 1")
    if again.isEmpty():
        return kept
    once = rows_by_key(kept, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return rows_by_key(kept, again, "left_anti").unionByName(once)
