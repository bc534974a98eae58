"""Main text of pages: what the counting of subtrees changes, and what it leaves alone."""

from __future__ import annotations

import random
import time
from collections import defaultdict

import pytest

from blockloom.llm import html_extract as h
from blockloom.llm.common import keep, table

SCHEMA = "page_id long, url string, html string"


def prose(seed: int, words: int = 80) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(words)]


def test_article_keeps_blocks_named_like_site_parts():
    page = (
        "<body><nav>menu</nav><div class='sidebar'>side</div><article><h1>One</h1><section id='discussion'><p>Two</p></section><h2 id='search'>Three</h2>"
        "<p class='side'>Four</p><h2 id='related'>Five</h2><table class='toc'><tr><td>Six</td></tr></table><div class='share-price'>Seven</div><p>Eight</p><p>Nine</p>"
        "<div class='ad'>no</div><section class='comments'><p>no</p></section><div class='post share'>no</div></article></body>"
    )
    assert h.main_text(page).split("\n\n") == "One Two Three Four Five Six Seven Eight Nine".split()


def test_parts_of_an_article_stay_together():
    page = "<main><article><p>short</p></article><article><p>the longer part</p></article><article class='comment'><p>no</p></article></main><div><article><p>else</p></article></div>"
    assert h.main_text(page) == "short\n\nthe longer part"


def test_headings_of_nested_headers_come_once():
    page = "<article><header><header><h1>a<h2>b</h2></h1></header><p>by</p></header><p>text</p></article>"
    assert h.main_text(page).split("\n\n") == ["a", "b", "text"]


@pytest.mark.parametrize("tag", ["<div>", "<div class=content>", "<p><span>", "<ul><li>", "<table><tr><td>", "</x><b>", "<article>", "<header>", "<main>"])
def test_deep_pages_take_linear_time(tag):
    page = "<body>" + tag * 100_000 + "end"
    start = time.perf_counter()
    assert h.main_text(page, frozenset([1])) in ("end", "")
    h.subtrees(page)
    assert time.perf_counter() - start < 30


def site() -> list[tuple[int, str, str]]:
    """A host whose articles hold notices under names of no meaning, a quoted line, and
    copies; and one whose pages are near copies of one article."""
    rows = []
    for i in range(40):
        quote = "<p>A licence line that several articles quote.</p>" if i % 4 == 0 else ""
        own = " ".join(prose(i))
        page = f"<body><article><h1>T{i}</h1><div class='q{7}'><p>Read it in our app.</p></div><p>{own}</p>{quote}<p>Copyright of the house.</p></article><div class=zz>Foot</div></body>"
        rows += [(100 * i + copy, f"http://a.example/{i}", page) for copy in range(1 + 5 * (i == 3))]
    base = [prose(1000 + k, 30) for k in range(10)]
    for i in range(60):
        changed = [list(b) for b in base]
        changed[i % 10][i % 30] = f"other{i}"
        body = "".join(f"<section class=x><p>{' '.join(b)}</p></section>" for b in changed)
        rows.append((10_000 + i, f"http://copies.example/{i}", f"<body><article>{body}</article></body>"))
    return rows


def expected(row: tuple[int, str, str]) -> list[str]:
    number = row[0] // 100
    if number >= 100:
        return h.main_text(row[2]).split("\n\n")
    return [f"T{number}", " ".join(prose(number)), *(["A licence line that several articles quote."] if number % 4 == 0 else [])]


@pytest.mark.parametrize("most_sent", [h.SENT_NUMBERS, 0])
def test_template_goes_and_copied_articles_stay(spark, most_sent):
    rows = site()
    pages = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("page_id", "page_id").selectExpr("*", "'x' AS host", "1 AS page", "2 AS template", "3 AS article").repartition(5)
    got = {r.page_id: r.text.split("\n\n") for r in h.extract_text(pages, most_sent).collect()}
    assert got == {row[0]: expected(row) for row in rows}


def brute_templates(pages: list[tuple[str, str]]) -> set[tuple[str, int]]:
    """Stories by comparing all pairs of a host's articles by their bands, subtrees counted in a dictionary."""
    by_host = defaultdict(dict)
    for host, page in pages:
        containers, units, text = h.subtrees(page)
        by_host[host][page] = (containers, units, text, set(h.band_keys([text])[0]))
    out = set()
    for host, found in by_host.items():
        story = {p: p for p in found}

        def root(p, story=story):
            while story[p] != p:
                p = story[p]
            return p

        names = sorted(found)
        for i, p in enumerate(names):
            for q in names[:i]:
                if found[p][2] == found[q][2] or found[p][3] & found[q][3]:
                    story[root(p)] = root(q)
        total = len({root(p) for p in names})
        counts = [defaultdict(set), defaultdict(set)]
        for p in names:
            for kind in (0, 1):
                for x in found[p][kind]:
                    counts[kind][x].add(root(p))
        out |= {(host, x) for x, s in counts[0].items() if len(s) >= h.MIN_ARTICLES}
        out |= {(host, x) for x, s in counts[1].items() if len(s) >= h.MIN_PROSE and len(s) > h.PROSE_SHARE * total}
    return out


def test_templates_equal_a_count_by_hand(spark):
    given = table(spark, "/root/testdata/sf0.001", "pages").select("page_id", "url", "html").union(spark.createDataFrame(site(), SCHEMA))
    found = {(r.host, r.subtree) for r in h.templates(keep(h.elements(given), "elements")).collect()}
    plain = [(r.host, r.html or "") for r in given.select(h.host().alias("host"), "html").collect()]
    assert found == brute_templates(plain) and any(x[0] == "a.example" for x in found)


def test_near_copies_share_a_band():
    rng = random.Random(5)
    hits = 0
    for i in range(200):
        text = prose(5000 + i, 200)
        other = list(text)
        for at in rng.sample(range(200), 3):  # up to 15 of 196 shingles change: similarity 0.86
            other[at] = "changed"
        a, b = h.band_keys([" ".join(text), " ".join(other)])
        hits += bool(set(a) & set(b))
    assert hits >= 195
    assert h.band_keys(["", "few words", " ".join(prose(1))])[:2] == [[], []]
