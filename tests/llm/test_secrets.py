"""What the Markov models add to the fixed patterns: planted keys, and ordinary tokens left alone."""

from __future__ import annotations

import random
import string


import numpy as np

from blockloom.llm.common import table
from blockloom.llm.secret_scan import _TOKEN, BUCKETS, LEAST_HELD, Words, _ordinary, _thresholds, secret_spans


FOLDER = "/root/testdata/sf0.01"


def test_planted_keys_are_found_and_ordinary_tokens_are_not(spark):
    rng = random.Random(11)
    docs = table(spark, FOLDER, "documents").select("doc_id", "text")
    given = docs.collect()
    mixed, capitals = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits
    keys, plain = {}, {}
    for n, row in enumerate(given[:600]):
        keys[row.doc_id] = "".join(rng.choices((mixed, mixed, capitals)[n % 3], k=12 + n % 29))
    usual = ["the.reading.of", "https://www.ererth.example.com/of/the/2024", "2024-01-31", "THERESTION", "theReadingOfThe", "1234567890123", "and/or/andthe", "er_the_inand_on"]
    for n, row in enumerate(given[600:]):
        plain[row.doc_id] = usual[n % len(usual)]
    rows = [(r.doc_id, f"{r.text}\nat {keys.get(r.doc_id) or plain[r.doc_id]} ") for r in given]
    spans = {r.doc_id: [s for s in r.spans if s.kind == "model"] for r in secret_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    texts = dict(rows)
    found = {d: {texts[d][s.start : s.end] for s in x} for d, x in spans.items()}
    by_size = {}
    for d, key in keys.items():
        by_size.setdefault(len(key) // 8 * 8, []).append(key in found[d])
    share = {size: sum(x) / len(x) for size, x in sorted(by_size.items())}
    wrong = [t for d, x in found.items() for t in x if t != keys.get(d)]
    print(share, len(wrong), wrong[:40])
    assert sum(k in found[d] for d, k in keys.items()) >= 0.9 * len(keys)
    assert len(wrong) <= 5 and not any(t in usual for t in wrong)


def test_ordinary_shapes():
    raw = b"the reading.of THE theReading 2024-01 a1b2c3 aBcDeF XmlName page1 a/b=c @mail1.x"
    words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), _TOKEN, fold=False)
    assert _ordinary(words).tolist() == [True, True, True, True, True, False, False, True, False, True, True]


def test_thresholds_by_length():
    low, lower = BUCKETS // 2 - 10, BUCKETS // 2 - 30
    counts = {2 * BUCKETS + low: LEAST_HELD, 2 * BUCKETS + lower: LEAST_HELD, 4 * BUCKETS + low: 5, 6 * BUCKETS + lower: LEAST_HELD}
    limits = _thresholds(counts)
    assert limits[0] == limits[1] == float("inf") and abs(limits[2] - 1.525) < 0.02
    assert limits[3] == limits[4] == limits[5] == limits[2] and limits[6] == limits[7] == 0
    assert set(_thresholds({})) == {float("inf")}
