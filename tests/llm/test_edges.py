"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from blockloom.llm.bin_packing import pack_documents
from blockloom.llm.decontaminate import contamination, drop_contaminated
from blockloom.llm.html_extract import extract_text
from blockloom.llm.line_dedup import dedup_lines, without_repeats
from blockloom.llm.ngram_join import one_of_each, similar_documents
from blockloom.llm.pii import personal_spans
from blockloom.llm.quality import keep_good, quality_verdicts
from blockloom.llm.queries import QUERIES
from blockloom.llm.secret_scan import secret_spans
from blockloom.llm.sharding import document_shards, shuffle_into_shards
from blockloom.llm.token_files import token_file_digests

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 5000}x{i}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog and runs far away into the dark green forest tonight"
ROWS = [
    (1, PROSE, "en", "a", 9),
    (1, PROSE, "en", "a", 9),  # a repeated row
    (2, PROSE, None, None, None),
    (None, PROSE + " once more", "en", "a", 1),
    (3, None, "en", "a", 0),
    (4, "", "en", None, 0),
    (5, LONG, "de", "b", 1),
    (6, "日本語の文章です。 mail me at a@b.co, +1 (555) 555-1234, 10.0.0.1, 4111111111111111", "ja", "c", 1),
    (6, "other text under the same id: token = 0123456789abcdef0123456789abcdef", "ja", "c", 1),
    (7, "\n\n \n", "en", "a", 3),
    (8, "word", "en", "a", 4),
    (9, "word", "en", "a", 4),
]
BENCH = [(1, PROSE), (2, None), (None, "word"), (3, ""), (4, "nothing that occurs anywhere in these few documents of ours at all")]


@pytest.fixture(scope="module")
def docs(spark):
    clash = ["n_words", "fp", "tkey", "item", "bands", "node", "key", "component", "shard", "slot", "_row", "_bin", "length", "g", "base", "spans", "kept", "gone", "n_lines"]
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *(F.lit("x").alias(c) for c in clash)).repartition(3)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string").withColumn("doc_id", F.lit(1))


BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PER_ROW = {
    "contamination": lambda d, b: contamination(d, b),
    "similar": lambda d, b: similar_documents(d),
    "shards": lambda d, b: document_shards(d),
    "token_files": lambda d, b: token_file_digests(d, BYTE, "byte_bpe", 0),
    "pii": lambda d, b: personal_spans(d),
    "secrets": lambda d, b: secret_spans(d),
    "lines": lambda d, b: without_repeats(d),
    "quality": lambda d, b: quality_verdicts(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_every_row_and_none_of_no_rows(docs, bench, name):
    assert PER_ROW[name](docs.limit(0), bench.limit(0)).collect() == []
    rows = PER_ROW[name](docs, bench).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)


def test_empty_tables_of_the_rest(spark, docs, bench):
    none = docs.limit(0)
    assert pack_documents(none, WORD, "word_bpe", 1).collect() == []
    assert dedup_lines(none).collect() == [] and one_of_each(none).collect() == [] and keep_good(none).collect() == []
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_contamination_by_hand(docs, bench):
    rows = contamination(docs, bench).collect()
    got = {(r.doc_id, r.n_words): (r.n_hit, r.n_items, r.contaminated) for r in rows}
    n = len(PROSE.split())
    assert got[1, n] == got[2, n] == (n, 1, True) and got[None, n + 2] == (n, 1, True)
    assert got[3, 0] == got[4, 0] == got[7, 0] == (0, 0, False)
    assert got[8, 1] == got[9, 1] == (1, 1, True) and got[5, 60_000][0] == 0
    left = [r.doc_id for r in drop_contaminated(docs, bench).collect()]
    assert sorted(map(str, left)) == ["3", "4", "5", "6", "6", "7"]
    assert drop_contaminated(docs, bench).columns == docs.columns


def test_similar_by_hand(docs):
    rows = similar_documents(docs).collect()
    got = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    n = len(PROSE.split()) - 3
    assert got[1, n] == got[2, n] == 1 and got[None, n + 2] == 1
    assert got[8, 1] == 8 and got[9, 1] == 8
    assert got[3, 0] == 3 and got[4, 0] == 4 and got[7, 0] == 7
    left = sorted(str(r.doc_id) for r in one_of_each(docs).collect())
    assert left == ["1", "3", "4", "5", "6", "6", "7", "8"]


def test_lines_by_hand(spark, docs):
    a = "first line that is long enough to count here and then goes on for quite a few more words than the other ones do"
    b = "second line that is long enough to count too"
    near = a + " x"
    rows = [(1, f"{a}\nshort\n{b}"), (2, f"{b}\nshort\n{near}"), (3, f"{a}"), (4, None), (5, "")]
    got = {r.doc_id: r for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "short" and got[3].text == ""
    assert (got[2].n_lines, got[2].n_removed) == (3, 2) and got[4].text is None and got[5].text == ""
    kept = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit(0)))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5] and kept.columns == ["doc_id", "text", "n_chars"]


def test_exact_repeats_of_short_lines_go(spark, tmp_path):
    """In the query and with ``short``; blank lines and near copies of short lines stay."""
    long = "a line that is long enough to be compared by its shingles"
    rows = [(1, f"Les.\n\n{long}\nchapter 1"), (2, "Les.\n\nchapter 2\nLes."), (3, f"短い文。\n \n{long}"), (4, "短い文。\n "), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in QUERIES["op9_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: (4, 0, rows[0][1]), 2: (4, 2, "\nchapter 2"), 3: (3, 1, "短い文。\n "), 4: (2, 1, " "), 5: (0, 0, None), 6: (0, 0, "")}
    assert sorted(r.doc_id for r in dedup_lines(df, short=True).collect()) == [1, 2, 3, 5, 6]


def test_quality_of_nulls(docs):
    rows = quality_verdicts(docs).collect()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (3, 4, 7, 8))
    assert [r.doc_id for r in keep_good(docs).collect()] == [5] and keep_good(docs).columns == docs.columns


def test_packing_keeps_every_row(docs):
    rows = pack_documents(docs, WORD, "word_bpe", 1, capacity=64).collect()
    whole = [r for r in rows if r.piece == 0]
    assert len(whole) == len(ROWS) and max(r.length for r in rows) == 64
    assert sum(r.length == 1 for r in whole) == 3  # null, empty and blank texts


def test_shards_of_any_rows(docs):
    rows = shuffle_into_shards(docs, 5).collect()
    assert len(rows) == len(ROWS) and {r.shard for r in rows} == set(range(5))
    assert [len([r for r in rows if r.shard == s]) for s in range(5)] == [3, 3, 2, 2, 2]


def test_spans_by_hand(docs):
    spans = {tuple(s.kind for s in r.base) for r in personal_spans(docs).collect() if r.doc_id == 6}
    assert spans == {("email", "ip", "card", "phone"), ()}
    secrets = {tuple(s.kind for s in r.base) for r in secret_spans(docs).collect() if r.doc_id == 6}
    assert secrets == {(), ("assign", "hex")}


def test_html_by_hand(spark):
    page = (
        "<html><head><title>T</title></head><body><header><h2>Site</h2></header><nav><a href='/'>Home</a></nav><div class='cookie-notice'>We use cookies</div>"
        "<main><article><header><h1>Title &amp; more</h1><p>by me</p></header><p>One\n two<br>three<p>Four <b>five</b><ul><li>six<li>seven</ul>"
        "<aside>see also</aside><form><p>mail</p></form><script>var x='<p>no</p>'</script><!-- <p>no</p> --><section class='comments'><p>first!</p></section>"
        "</article></main><footer>&copy; us</footer></body></html>"
    )
    bare = "<div>Same menu of the site</div><p>Text number {} of this page.</p><div>Same foot of the site</div>"
    rows = [(1, "http://a.example/x", page), (2, None, None), (3, "bad url", ""), (4, "http://a.example/y", "plain & simple")]
    rows += [(10 + i, f"http://b.example/{i}", bare.format(i)) for i in range(12)]
    got = {r.page_id: r for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "Title & more\n\nOne two three\n\nFour five\n\nsix\n\nseven" and got[1].n_chars == len(got[1].text)
    assert got[2].text == "" and got[3].text == "" and got[4].text == "plain & simple"
    assert all(got[10 + i].text == f"Text number {i} of this page." for i in range(12))
