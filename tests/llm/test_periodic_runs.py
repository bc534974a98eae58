"""Periodic runs against the definition, word by word."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blockloom.llm.periodic_runs import find_runs, periodic_runs, repeats
from blockloom.llm.queries import QUERIES


def plain_runs(words, least=12):
    """(start, length, period) of every run, by trying all periods."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            stretch = (at, end + q)
            if stretch[1] - at >= max(least, 2 * q) and stretch not in found:
                found[stretch] = q  # of a stretch, the smallest period comes first
            at = end
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_collapse(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def found_in(texts, least=12):
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    hashes = np.array([w * 0x9E3779B97F4A7C15 % 2**64 for t in texts for w in t], np.uint64)
    runs = find_runs(hashes, first, least)
    rows = [[] for _ in texts]
    for d, *run in zip(runs.doc.tolist(), runs.start.tolist(), runs.length.tolist(), runs.period.tolist()):
        rows[d].append(tuple(run))
    gone = repeats(runs, first)
    return rows, [[w for w, g in zip(t, gone[a:]) if not g] for t, a in zip(texts, first)]


TEXT = st.lists(st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=9), st.integers(1, 8)), max_size=6).map(
    lambda parts: [w for unit, times in parts for w in unit * times]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4), st.sampled_from([2, 5, 12]))
def test_runs_are_those_of_the_definition(texts, least):
    rows, kept = found_in(texts, least)
    assert rows == [plain_runs(t, least) for t in texts]
    assert kept == [plain_collapse(t, r) for t, r in zip(texts, rows)]


def test_fibonacci_words_and_long_repetitions():
    fib = [1], [1, 2]
    while len(fib[1]) < 400:
        fib = fib[1], fib[1] + fib[0]
    rng = random.Random(5)
    unit = [rng.randrange(50) + 1 for _ in range(150)]
    texts = [fib[1], [7] * 500, [], [1], unit * 5 + unit[:60], unit + [9] + unit + [9] + unit[:40]]
    rows, _ = found_in(texts)
    assert rows == [plain_runs(t) for t in texts]
    assert (0, 500, 1) in rows[1] and (0, 810, 150) in rows[4]


def test_long_repeated_text_is_linear_enough():
    texts = [[1] * 200_000, [1 + (i * i) % 7 for i in range(100_000)]]
    rows, kept = found_in(texts)
    assert rows[0] == [(0, 200_000, 1)] and len(kept[0]) == 1
    assert rows[1] == [(0, 100_000, 7)] and len(kept[1]) == 7


def test_odd_rows(spark):
    schema = "doc_id long, text string, runs string, tkey int"
    rows = [(1, None, "x", 1), (2, "", None, 1), (None, "a\tb " * 9, "x", 2), (3, "a " * 12, "x", 3), (3, "a " * 12, "x", 3), (4, "A a " * 6, "x", 4), (5, " \n ", "x", 5)]
    out = {(r.doc_id, r.n_words): r for r in periodic_runs(spark.createDataFrame(rows, schema)).collect()}
    assert len(out) == 6  # rows of id 3 agree
    assert out[1, 0].runs == out[2, 0].runs == out[5, 0].runs == [] and out[1, 0].collapsed == ""
    assert [tuple(r) for r in out[None, 18].runs] == [(0, 18, 2)] and out[None, 18].collapsed == "a b"
    assert [tuple(r) for r in out[3, 12].runs] == [(0, 12, 1)]
    assert [tuple(r) for r in out[4, 12].runs] == [(0, 12, 2)] and out[4, 12].collapsed == "A a"
    assert periodic_runs(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(documents)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    planted = 0
    for row in documents:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        if len(words) > 3_000:
            continue
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = best[1] and 1000 * best[1] // best[2]
        digest = sha("".join(f"{a},{n},{q}\n" for a, n, q in runs))
        assert tuple(got[row.doc_id])[1:] == (len(runs), *best, milli, digest, sha(" ".join(plain_collapse(words, runs)))), row.doc_id
    assert planted > 5
