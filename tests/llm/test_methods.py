"""The methods inside the operators, against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blockloom.llm import boosting, line_dedup, pii, quality
from blockloom.llm.bin_packing import best_fit, improve
from blockloom.llm.common import ALNUM, SPACED, Words, bit_table, has_bit, sliced
from blockloom.llm.components import components
from blockloom.llm.decontaminate import GRAM, WINDOW, _kept_grams
from blockloom.llm.pii import BASE, luhn, matches, running_total
from blockloom.llm.sharding import communication_matrix
from blockloom.llm.token_files import compress, expand, read_range
from blockloom.llm.token_ids import Encoder

PIECES = ["'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "a", "Bc", "s", "é", "É", "1", "²", "12", "!", "?!", "\xa0", "ª", "ß", "Ŀ", "日本", "́", "'S", "<|endoftext|>", "İ"]


@pytest.fixture(scope="module")
def encoders():
    return {r: Encoder(public_tokenizers.path(f"{r}_{n}.json"), r) for r, n in (("byte_bpe", "50k"), ("word_bpe", "49k"))}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES) | st.text(max_size=3), max_size=15).map("".join), min_size=1, max_size=5))
def test_remembered_ids_are_the_librarys(encoders, texts):
    for e in encoders.values():
        plain = [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in e.encode(texts)] == plain == [x.tolist() for x in e.encode(texts)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6) | st.integers(0, 50_000), max_size=400))
def test_grammar_round_trip(ids):
    ids = np.array(ids * 3, np.uint32)
    base, rules, lengths, symbols = compress(ids)
    assert expand(symbols, base, rules).tolist() == ids.tolist()
    row = {"symbols": symbols.tobytes(), "base": base, "rules": rules.tobytes(), "lengths": lengths.tobytes()}
    for a, b in ((0, len(ids)), (1, 7), (len(ids) // 2, len(ids) // 2 + 5), (5, 5), (3, 10**9)):
        assert read_range(row, a, b).tolist() == ids[a:b].tolist()
    assert len(symbols) <= len(ids)


def test_grammar_compresses():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    _, rules, _, symbols = compress(ids)
    assert len(symbols) + 2 * len(rules) < len(ids) / 10


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB1 é,\n\x00", max_size=30) | st.none(), max_size=8), st.integers(1, 40))
def test_words(texts, limit):
    got = []
    for _, _, data, offsets in sliced(pa.array(texts, pa.string()), limit):
        w = Words(data, offsets, ALNUM)
        got += [[w.text(i, i + 1) for i in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        assert len(set(zip(w.hash.tolist(), [w.text(i, i + 1) for i in range(len(w.doc))], strict=True))) == len(set(w.hash.tolist()))
    fold = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    wanted = ["".join(c if c.isalnum() else " " for c in fold(t)).split() for t in texts]
    assert got == wanted


def test_winnowing_meets_in_every_window():
    """The same window of words keeps the same gram wherever it stands."""
    rng = random.Random(3)
    for _ in range(200):
        shared = [rng.choice("abc") for _ in range(WINDOW)]
        kept = []
        for _ in range(2):
            head = [rng.choice("abcdef") for _ in range(rng.randint(0, 20))]
            text = " ".join(head + shared + [rng.choice("abcdef") for _ in range(rng.randint(0, 20))])
            data = np.frombuffer(text.encode(), np.uint8)
            w = Words(data, np.array([0, len(data)]), SPACED)
            grams = w.grams(GRAM)
            kept.append({int(grams[i]) for i in _kept_grams(w) if len(head) <= i <= len(head) + WINDOW - GRAM})
        assert kept[0] & kept[1]


def test_communication_matrix_is_exact_and_uniform():
    counts = [7, 0, 20, 13]
    seen = Counter()
    for seed in range(400):
        m = np.array(communication_matrix(counts, 3, seed))
        assert m.sum(axis=1).tolist() == counts and sorted(m.sum(axis=0)) == [13, 13, 14]
        seen[m[0, 0]] += 1
    mean = sum(k * n for k, n in seen.items()) / 400
    assert abs(mean - 7 * 14 / 40) < 0.25


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_local_search_only_improves(sizes):
    sizes = np.array(sizes)
    start = best_fit(sizes, 100)
    after = improve(sizes, start, 100)
    fill = np.bincount(after, weights=sizes)
    assert fill.max() <= 100 and (fill > 0).sum() <= len(set(start.tolist()))
    assert (fill**2).sum() >= (np.bincount(start, weights=sizes) ** 2).sum()


def test_local_search_empties_a_bin():
    sizes = np.array([6, 3, 5, 4, 2])  # 6+3 | 5+4 | 2 of capacity 10
    assert len(set(improve(sizes, np.array([0, 0, 1, 1, 2]), 10).tolist())) == 2


def test_boosting_learns_and_says_the_same(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 10, (2000, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 6)).astype(float)
    trees = boosting.fit(x, y)
    odds = boosting.log_odds(trees, x)
    assert ((odds > 0) == y).mean() > 0.98
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x[:50]], "f0 double, f1 double, f2 double, f3 double")
    said = [r[0] for r in rows.select(boosting.score(trees, lambda f: F.col(f"f{f}"))).collect()]
    assert np.allclose(sorted(said), sorted(odds[:50]))
    cut = boosting.threshold(odds, y, 0.99)
    assert y[odds >= cut].mean() >= 0.99


def test_matches_have_their_places(spark):
    texts = ["a@b.c_d@e.f x", "", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111 5", "+1 (2) 3.4-5678 +9", "é1.2.3.4é@x.y" * 50, "1" * 3000]
    import re

    df = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for kind, pattern in plain.items():
        for r in df.select("text", matches(F.col("text"), BASE[kind]).alias("m")).collect():
            assert [(m.start, m.end, m.value) for m in r.m] == [(m.start(), m.end(), m[0]) for m in re.finditer(pattern, r.text)]


def test_running_total_and_luhn(spark):
    arrays = [[], [5], [1, 2], list(range(1, 40))]
    got = spark.createDataFrame([(a,) for a in arrays], "a array<int>").select("a", running_total(F.col("a")).alias("t")).collect()
    assert all(list(r.t) == np.cumsum(r.a).tolist() for r in got)
    rows = spark.createDataFrame([("4111111111111111", True), ("4111111111111112", False)], "d string, ok boolean")
    assert all(r.l == r.ok for r in rows.select("ok", luhn(F.col("d")).alias("l")).collect())


def test_bit_table(spark):
    values = np.random.default_rng(2).integers(-(2**63), 2**63, 3000)
    bits = bit_table(spark.createDataFrame([(int(v),) for v in values], "h long"), "h")
    assert has_bit(bits, values.view(np.uint64)).all()
    assert has_bit(bits, np.random.default_rng(3).integers(0, 2**64, 10_000, dtype=np.uint64)).mean() < 0.01


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_minhash_bands_find_similar_lines(spark):
    """Recall of the bands, and their keys' precision, on lines of known similarity."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    rows = []
    for i in range(300):
        line = [rng.choice(words) for _ in range(40)]
        near = list(line)
        near[rng.randrange(40)] = "changed"
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(near))]
    df = spark.createDataFrame(rows, "i int, line string").withColumn("shingles", line_dedup._shingles("line")).withColumn("s", F.col("shingles"))
    got = {r.i: (set(r.s), set(r.bands)) for r in line_dedup._with_bands(df).collect()}
    similar = [i for i in range(300) if len(got[2 * i][0] & got[2 * i + 1][0]) >= 0.8 * len(got[2 * i][0] | got[2 * i + 1][0])]
    assert len(similar) > 250 and sum(bool(got[2 * i][1] & got[2 * i + 1][1]) for i in similar) >= 0.98 * len(similar)
    assert not any(got[2 * i][1] & got[2 * i + 2][1] for i in range(299))


def test_line_components_against_all_pairs(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(400)]
    base = [[rng.choice(words) for _ in range(20)] for _ in range(12)]
    lines = []
    for i in range(120):
        line = list(rng.choice(base))
        if i % 3:
            line[rng.randrange(20)] = rng.choice(words)
        lines.append(" ".join(line))
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    sets = {r.doc_id: set(r.s) for r in docs.withColumn("s", line_dedup._shingles("text")).collect()}
    first = list(range(120))
    for i in range(120):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = first[i], first[j]
                first = [min(a, b) if f in (a, b) else f for f in first]
    gone = {r.doc_id for r in line_dedup.repeated_lines(docs).collect()}
    assert gone == {i for i in range(120) if first[i] != i}


def test_line_shingles_are_characters(spark):
    """Every place of a line begins a shingle, in any script."""
    lines = ["first line that is long enough", "https://a.example/x?y=1", "ខ្ញុំស្រឡាញ់ភាសាខ្មែរណាស់", "日本語の文章です。短い文", "a\U0001f600b\U0001f600c\U0001f600d", "abc", "aaaaaaaaaaaaaaaaaaaaaaaa"]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, line string").withColumn("s", line_dedup._shingles("line")).collect()
    for r in rows:
        assert list(r.s) == sorted(r.s) and len(r.s) == len({r.line[i : i + 5] for i in range(max(1, len(r.line) - 4))})


def test_short_near_copies_of_lines_go(spark):
    """A changed word or letter of a short line, and of lines without blanks."""
    pairs = [
        ("first line that is long enough to count here", "first line that is long enough to count here x"),
        ("Inenen edingon aterin solumde marita pelon at orinre", "Inenen edingon aterin solumde marita pelon that orinre"),
        ("https://www.site.example/archive/2024/entries/of/the/month/index.html", "https://www.site.example/archive/2024/entries/of/the/month/index.htm"),
        ("ខ្ញុំស្រឡាញ់ភាសាខ្មែរណាស់ហើយចង់រៀនវាឱ្យបានល្អជាងនេះទៀត", "ខ្ញុំស្រឡាញ់ភាសាខ្មែរណាស់ហើយចង់រៀនវាឱ្យបានល្អជាងនេះ"),
    ]
    rows = [(2 * i + j, x) for i, pair in enumerate(pairs) for j, x in enumerate(pair)]
    gone = line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in gone) == [1, 3, 5, 7]


def test_robust_estimate_against_numpy(spark):
    """Concentration steps on a contaminated sample come near the clean part's moments."""
    rng = np.random.default_rng(4)
    d = len(quality.NAMES)
    clean = rng.normal(0, 1, (800, d)) @ rng.normal(0, 1, (d, d)) + np.arange(d)
    bad = rng.normal(40, 1, (150, d))
    rows = [("g", *map(int, np.round(r * quality.UNIT))) for r in np.vstack([clean, bad])]
    vectors = spark.createDataFrame(rows, "g string, " + ", ".join(f"{n} long" for n in quality.NAMES))
    found = quality.robust_estimates(vectors).collect()[0]
    assert np.allclose([found[f"m{i}"] for i in range(d)], clean.mean(axis=0), atol=0.4)
    factor = np.array([[found[f"l{i}{j}"] if j <= i else 0 for j in range(d)] for i in range(d)])
    floors = np.diag([quality.FLOORS[n] ** 2 for n in quality.NAMES])
    assert 0.3 < np.linalg.det(factor @ factor.T) / np.linalg.det(np.cov(clean.T) + floors) < 3


def test_chi_squared():
    assert abs(quality._quantile(0.95, 5) - 11.0705) < 1e-3 and abs(quality._chi2(3.841459, 1) - 0.95) < 1e-6


def test_sample_of_candidates_is_the_least_hashes(spark, monkeypatch):
    texts = [(i % 700, f"call +1 202 555 {i % 700:04d} or 10.0.{i % 250}.7 now") for i in range(2100)]
    found = pii.candidates(spark.createDataFrame(texts, "doc_id long, text string").repartition(6))
    monkeypatch.setattr(pii, "TRAIN_ROWS", 10**6)
    everything = pii._sample(found, "base")
    assert len(everything) == 4200
    for size in (1, 50, 3000, 4200):
        monkeypatch.setattr(pii, "TRAIN_ROWS", size)
        assert pii._sample(found, "base") == everything[:size]
    assert pii._sample(found.limit(0), "base") == []


def test_trees_come_from_all_candidates(spark, monkeypatch):
    """Counted on the driver or by aggregations, every candidate has its weight; no sample is drawn."""
    rows = [(i, f"call +49 30 {1000000 + 37 * i % 900000} or x{i % 9}@y{i % 5}.org, no. {i % 50}-{10 + i % 17}-{i % 90}, tel. {i}.{i % 7}", None) for i in range(300)]
    found = pii.candidates(spark.createDataFrame(rows, "doc_id long, text string, lang string")).cache()
    monkeypatch.setattr(pii, "_sample", lambda *_: pytest.fail("a sample"))
    monkeypatch.setattr(boosting, "TREES", 2)
    counted = pii.vectors(found)
    assert counted.agg(F.sum("n")).first()[0] == found.agg(F.sum(F.size("base") + F.size("proposed"))).first()[0]
    few = pii.train(found)
    monkeypatch.setattr(pii, "FEW_VECTORS", 0)
    many = pii.train(found)
    assert few and many and few[1] == many[1]
    values = found.select(F.explode(F.concat("base", "proposed")).alias("s"))
    odds = [F.round(boosting.score(m[0], lambda f: F.col("s")[pii.FEATURES[f]]), 9) for m in (few, many)]
    assert values.where(odds[0] != odds[1]).isEmpty()
