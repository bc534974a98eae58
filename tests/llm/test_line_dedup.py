"""Fuzzy line deduplication: recall of the bands, and the query against all pairs."""

from __future__ import annotations

from collections import defaultdict

import numpy as np

from blockloom.llm import line_dedup
from blockloom.llm.queries import QUERIES


def test_recall_at_the_bound(spark):
    """Sets of similarity 0.8, exactly or just above, of 20 to 400 shingles."""
    rng = np.random.default_rng(5)
    rows = []
    for n in (20, 35, 50, 100, 200, 400):
        shared = int(np.ceil(2 * n * 0.8 / 1.8))
        for i in range(600):
            union = np.unique(rng.integers(-(2**63), 2**63 - 1, 2 * n - shared))
            rng.shuffle(union)
            sets = union[:n], np.concatenate([union[:shared], union[n:]])
            rows += [(n, i, side, sorted(map(int, s))) for side, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "size int, i int, side int, shingles array<long>")
    bands = defaultdict(list)
    for r in line_dedup._with_bands(df).collect():
        assert r.n == r.size
        bands[r["size"], r.i].append(set(r.bands))
    for n in (20, 35, 50, 100, 200, 400):
        met = np.mean([bool(a & b) for (size, _), (a, b) in bands.items() if size == n])
        assert met >= 0.985, (n, met)
    assert np.mean([bool(a & b) for a, b in bands.values()]) >= 0.995


def test_sketches_hold_back_no_link(spark):
    """Sets of similarity from a third to one: all that link pass, few of the unlike do."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(1500):
        n = int(rng.integers(16, 600))
        pool = rng.permutation(np.unique(rng.integers(-(2**63), 2**63 - 1, 2 * n)))
        shared = int(rng.integers(n // 2, n + 1)) if i % 3 else -(-8 * n // 9)
        sets = pool[:n], np.concatenate([pool[:shared], pool[n : 2 * n - shared]])
        rows += [(i, side, sorted(map(int, s))) for side, s in enumerate(sets)]
    df = line_dedup._with_sketch(spark.createDataFrame(rows, "i int, side int, shingles array<long>"))
    left, right = (df.where(f"side = {k}").select("i", df.n.alias(f"n_{c}"), df.sketch.alias(f"sketch_{c}")) for k, c in enumerate("ab"))
    passed = {r.i: r.may for r in left.join(right, "i").select("i", line_dedup._near("a", "b").alias("may")).collect()}
    sets = defaultdict(dict)
    for i, side, s in rows:
        sets[i][side] = set(s)
    similar = {i: len(s[0] & s[1]) / len(s[0] | s[1]) for i, s in sets.items()}
    link = {i for i, s in sets.items() if 100 * len(s[0] & s[1]) >= line_dedup.SIMILAR * len(s[0] | s[1])}
    assert len(passed) == 1500 and 300 < len(link) < 1200
    assert all(passed[i] for i in link)
    assert np.mean([passed[i] for i, x in similar.items() if x < 0.7]) < 0.05


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    documents = sorted(spark.read.parquet(f"{folder}/documents.parquet").collect(), key=lambda r: r.doc_id)
    long, sets, holding = {}, {}, defaultdict(list)
    for row in documents:
        for line in (row.text or "").split("\n"):
            if len(line) >= line_dedup.MIN_CHARS and line not in long:
                long[line] = line
                sets[line] = {line[i : i + line_dedup.SHINGLE] for i in range(max(1, len(line) - line_dedup.SHINGLE + 1))}

    def find(line):
        while long[line] != line:
            line = long[line]
        return line

    for line, own in sets.items():
        overlap = defaultdict(int)
        for shingle in own:
            for other in holding[shingle]:
                overlap[other] += 1
            holding[shingle].append(line)
        for other, both in overlap.items():
            if 100 * both >= line_dedup.SIMILAR * (len(own) + len(sets[other]) - both):
                long[find(line)] = find(other)
    seen, want = set(), {}
    for row in documents:
        lines = row.text.split("\n") if row.text else []
        kept = []
        for line in lines:
            name = find(line) if line in long else line
            if not line.strip() or name not in seen:
                kept.append(line)
            seen.add(name)
        want[row.doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept) if lines else row.text)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in QUERIES["op9_line_dedup"](spark, folder).collect()}
    assert got == want


def test_unlike_lines_of_one_bucket_are_no_rows(spark, monkeypatch):
    """Lines that share a passage, and with it bands, but differ in the rest: no pair of
    them is stored, and near copies among them still go."""
    rng = np.random.default_rng(9)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz      "))
    text = lambda n: "".join(rng.choice(letters, n))
    passage = text(120)
    unlike = [passage + text(80) for _ in range(150)]
    copies = [line[:-1] + "#" for line in unlike[:20]]
    stored = []

    def keep(df, label):
        out = line_keep(df, label)
        stored.append((label, out.count()))
        return out

    line_keep = line_dedup.keep
    monkeypatch.setattr(line_dedup, "keep", keep)
    rows = list(enumerate(unlike + copies))
    gone = {r.doc_id for r in line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert gone == set(range(150, 170))
    pairs = [n for label, n in stored if label == "pairs"]
    assert len(pairs) == 2 and sum(pairs) <= 100, stored


def test_two_unlike_lines_of_a_bucket_are_no_entries(spark):
    """Sets of a tenth and of four fifths, one bucket a pair: the unlike are held back, by size
    or by their stretches' first hashes; the similar stay, at any size and as repeated rows."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(1200):
        n = int(rng.integers(16, 600))
        pool = rng.permutation(np.unique(rng.integers(-(2**63), 2**63 - 1, 2 * n)))
        shared = -(-8 * n // 9) if i % 2 else n // 5
        sets = pool[:n], np.concatenate([pool[:shared], pool[n : 2 * n - shared]])
        rows += [(i, 2 * i + side, sorted(map(int, s))) for side, s in enumerate(sets)]
    rows += [(1200, 2400, list(range(100))), (1200, 2401, list(range(10))), (1201, 2402, [7, 8])]
    shared = line_dedup._with_bands(spark.createDataFrame(rows, "key long, node long, shingles array<long>")).drop("bands")
    entries = line_dedup._entries(shared.unionByName(shared.where("key % 3 = 0 or key = 1201"))).collect()
    held = defaultdict(list)
    for r in entries:
        held[r.key].append((r.node, r.rank))
    assert all(sorted(held[i]) == [(2 * i, -1 - (i % 3 == 0)), (2 * i + 1, -1 - (i % 3 == 0))] for i in range(1, 1200, 2))
    assert sum(i in held for i in range(0, 1200, 2)) < 60
    assert 1200 not in held and 1201 not in held


def test_a_bucket_is_held_against_its_first_once(spark, monkeypatch):
    """Two lines of a bucket are compared once; of three, the two that are not the first meet again."""
    rng = np.random.default_rng(13)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz      "))
    lines = ["".join(rng.choice(letters, 150)) for _ in range(30)]
    rows = [(3 * i, line) for i, line in enumerate(lines)] + [(3 * i + 1, line + "#") for i, line in enumerate(lines)]
    rows += [(3 * i + 2, line + "+") for i, line in enumerate(lines) if i < 10]
    asked = []
    again = line_dedup.remaining_pairs

    def remaining_pairs(entries, *rest):
        asked.extend(r["count"] for r in entries.groupBy("key").count().collect())
        return again(entries, *rest)

    monkeypatch.setattr(line_dedup, "remaining_pairs", remaining_pairs)
    gone = {r.doc_id for r in line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert gone == {i for i, _ in rows if i % 3}
    assert set(asked) == {1, 2} and asked.count(1) > asked.count(2)
