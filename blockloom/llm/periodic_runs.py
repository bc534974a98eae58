"""Periodic runs of words, found by uniting suffix classes in the order of falling LCPs.

A run is a stretch of words with a smallest period q that is at least twice as
long and that no neighbour extends. Its first two periods begin at positions s
and s + q whose suffixes share length - q words, and no position in between shares
as many with them. So when the classes of suffixes are united from the longest
common prefix downwards, s and s + q become neighbours in their class's ordered
positions at exactly that level. The other way round, newly adjacent positions no
further apart than their common prefix always begin a stretch with the smallest
period; of those with one period and one end, the first is the run's beginning.

Texts are independent of each other. A task cuts its rows into slices of about
``SLICE_BYTES`` and sorts the suffixes of a slice's texts together, by doubling.
Only words that occur in a repeated stretch of ``level`` words take part: a run
of ``least`` words shares at least half of them between its first two periods.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import SPACED, Words, sliced, text_key

#: Shortest run that is reported.
LEAST = 12


@dataclass
class Runs:
    """Runs of some texts by text, start and period; ``start`` counts from the text's first word."""

    doc: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _repeated(word: np.ndarray, doc: np.ndarray, level: int) -> np.ndarray:
    """Positions of every stretch of ``level`` words that its text has more than once."""
    n = len(word) - level + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    gram = np.zeros(n, np.uint64)
    for i in range(level):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + (word[i : i + n] ^ (gram >> np.uint64(29)))
    gram ^= (doc[:n].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
    at = np.flatnonzero(doc[:n] == doc[level - 1 :])
    # a table of bits lets most stretches that occur once go before they are sorted
    cell = (gram[at] >> np.uint64(8)).astype(np.int64) & ((1 << 21) - 1)
    at = at[np.bincount(cell, minlength=1 << 21)[cell] > 1]
    order = at[np.argsort(gram[at], kind="stable")]
    equal = gram[order[1:]] == gram[order[:-1]]
    twin = np.zeros(len(order), bool)
    twin[1:] |= equal
    twin[:-1] |= equal
    return np.sort(order[twin])


def _suffixes(first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of all suffixes of ``first`` (ranks of single words), and the ranks of
    every 1, 2, 4, ... words. The last place has to be unlike all others."""
    rank, levels, step = first, [first], 1
    size = np.bincount(rank, minlength=len(rank))
    while True:
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            return np.argsort(rank), levels
        key = rank[tied].astype(np.int64) * len(rank) + rank[np.minimum(tied + step, len(rank) - 1)]
        order = np.argsort(key, kind="stable")
        key, tied = key[order], tied[order]
        new_group = np.ones(len(key), bool)
        new_group[1:] = key[1:] // len(rank) != key[:-1] // len(rank)
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        place = np.arange(len(key))
        begin = np.maximum.accumulate(np.where(new_group, place, 0))
        same = np.maximum.accumulate(np.where(new_key, place, 0))
        rank = rank.copy()
        rank[tied] = (key // len(rank)) + same - begin
        size = np.bincount(rank, minlength=len(rank))
        levels.append(rank)
        step *= 2


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` share."""
    out, last = np.zeros(len(a), np.int64), len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        out += (levels[k][np.minimum(a + out, last)] == levels[k][np.minimum(b + out, last)]).astype(np.int64) << k
    return out


def _seeds(a: list[int], b: list[int], lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Unite the classes of ``a`` and ``b``, pairs by falling ``lcp``; yields positions
    that become neighbours, no further apart than the pair's LCP, and that LCP."""
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for x, y, shared in zip(a, b, lcp):
        x, y = find(x), find(y)
        large, small = members.pop(x, None) or [x], members.pop(y, None) or [y]
        root = x
        if len(large) < len(small):
            large, small, root = small, large, y
        parent[x] = parent[y] = root
        gap = -1
        for i, p in enumerate(small):
            at = bisect_left(large, p)
            if at != gap:  # p opens a gap of the larger set; what came before it closed another
                if gap >= 0 and gap < len(large) and large[gap] - small[i - 1] <= shared:
                    yield small[i - 1], large[gap], shared
                if at and p - large[at - 1] <= shared:
                    yield large[at - 1], p, shared
                gap = at
        if gap < len(large) and large[gap] - small[-1] <= shared:
            yield small[-1], large[gap], shared
        if len(small) * 16 < len(large):
            for p in small:
                insort(large, p)
        else:
            large += small
            large.sort()
        members[root] = large


def find_runs(word: np.ndarray, first: np.ndarray, least: int = LEAST) -> Runs:
    """The runs of at least ``least`` words in texts given by their words' hashes;
    text d has the words ``first[d]`` to ``first[d + 1]``."""
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    level = max(1, least - least // 2)
    at = _repeated(word, doc, level)
    none = np.zeros(0, np.int64)
    if not len(at):
        return Runs(none, none, none, none)
    # what follows a repeated stretch decides where it ends, so `level` more words are kept and the place after them,
    # which stands for the cut; after a text's words there is a place for its end
    total = len(word) + len(count)
    ends = first[1:] + np.arange(len(count))
    marks = np.zeros(total + 1, np.int64)
    spot = at + doc[at]
    np.add.at(marks, spot, 1)
    np.add.at(marks, np.minimum(spot + level + 2, ends[doc[at]] + 1), -1)
    kept = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
    text = np.searchsorted(ends, kept)
    origin = kept - text  # the word's number
    cut = ends[text] == kept
    cut[:-1] |= kept[1:] != kept[:-1] + 1
    cut[-1] = True
    _, value = np.unique(word[origin[~cut]], return_inverse=True)
    # texts rank one after the other; every cut is a symbol of its own, and so is a last place for all that lies beyond
    n_values = int(value.max()) + 1
    key = np.empty(len(kept) + 1, np.int64)
    key[:-1][~cut] = text[~cut] * n_values + value
    key[:-1][cut] = n_values * len(count) + np.arange(int(cut.sum()))
    key[-1] = n_values * len(count) + len(kept)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(order), np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    suffix, levels = _suffixes(rank)
    lcp = _common(levels, suffix[:-1], suffix[1:])
    del levels
    joins = np.flatnonzero(lcp >= level)
    joins = joins[np.argsort(-lcp[joins], kind="stable")]
    place = np.append(origin, len(word))
    left, right = place[suffix[joins]], place[suffix[joins + 1]]
    found = np.array(list(_seeds(left.tolist(), right.tolist(), lcp[joins].tolist())), np.int64).reshape(-1, 3)
    if not len(found):
        return Runs(none, none, none, none)
    period, end = found[:, 1] - found[:, 0], found[:, 1] + found[:, 2]
    order = np.lexsort((found[:, 0], period, end))
    start, period, end = found[order, 0], period[order], end[order]
    head = np.ones(len(order), bool)
    head[1:] = (period[1:] != period[:-1]) | (end[1:] != end[:-1])
    start, period, end = start[head], period[head], end[head]
    long = end - start >= least
    start, period, end = start[long], period[long], end[long]
    order = np.lexsort((period, start))
    start, period, end = start[order], period[order], end[order]
    return Runs(doc[start], start - first[doc[start]], end - start, period)


def repeats(runs: Runs, first: np.ndarray) -> np.ndarray:
    """Which words lie in a run beyond its first period."""
    marks = np.zeros(int(first[-1]) + 1, np.int64)
    begin = first[runs.doc] + runs.start
    np.add.at(marks, begin + runs.period, 1)
    np.add.at(marks, begin + runs.length, -1)
    return np.cumsum(marks[:-1]) > 0


def _joined(words: Words, source: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Words ``source`` of the texts ``doc`` joined by single blanks: bytes and the texts' offsets."""
    size = words.end[source] - words.start[source]
    last = np.ones(len(source), bool)
    last[:-1] = doc[1:] != doc[:-1]
    width = size + ~last
    begin = np.cumsum(width) - width
    out = np.full(int(width.sum()), 32, np.uint8)
    into = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out[into] = words.data[into - np.repeat(begin - words.start[source], size)]
    total = np.bincount(doc, weights=width, minlength=n_docs).astype(np.int64)
    return out, np.concatenate(([0], np.cumsum(total)))


Rewrite = Callable[[np.ndarray, np.ndarray], np.ndarray]
_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
SCHEMA = "doc_id long, tkey long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _scan(least: int, rewrite: Rewrite | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in sliced(batch.column(2)):
                words = Words(data, offsets, SPACED, fold=False)
                source = np.arange(len(words.start))
                if rewrite:
                    source = rewrite(batch.column(0).slice(a, b - a), words.first)
                runs = find_runs(words.hash[source], words.first, least)
                stay = ~repeats(runs, words.first)
                raw, ends = _joined(words, source[stay], words.doc[stay], b - a)
                collapsed = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(raw)]).cast(pa.large_string()).cast(pa.string())
                at = np.searchsorted(runs.doc, np.arange(b - a + 1)).astype(np.int32)
                flat = pa.StructArray.from_arrays([pa.array(c) for c in (runs.start, runs.length, runs.period)], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(words.count.astype(np.int64)), pa.ListArray.from_arrays(pa.array(at), flat), collapsed],
                    names=["doc_id", "tkey", "n_words", "runs", "collapsed"],
                )

    return scan


def periodic_runs(documents: DataFrame, least: int = LEAST, rewrite: Rewrite | None = None) -> DataFrame:
    """Per row ``doc_id``, ``tkey`` (the text's hash), ``n_words``, ``runs`` (start,
    length, period by start, then period; words counted from 0) and ``collapsed``:
    the words but for each run's repetitions, joined by single blanks.

    ``rewrite`` may map a slice's words first: from its doc_ids and the places of
    their first words to the place of each word's source, within the same text.
    Null and empty texts have no words and no runs; rows are judged on their own,
    so repeated rows agree; an empty table gives none. Runs that tie in start are
    ordered by period. Other columns are ignored. A task holds one slice; a text
    beyond ``SLICE_BYTES`` is a slice of its own, and takes about 150 bytes a word,
    and 4 more for each doubling of its longest repetition.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tkey"), "text")
    return rows.mapInArrow(_scan(least, rewrite), SCHEMA)
