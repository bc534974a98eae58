"""Main text of web pages: site templates out, then the article's blocks.

Every element subtree is hashed and counted per host, once for each different
article it stands beside: pages whose articles are near copies count as one.
Containers with ``MIN_ARTICLES`` articles are template at any size of the host;
paragraphs, lists and tables, which articles also quote from each other, where
they stand with more than ``PROSE_SHARE`` of the host's articles. Template is
deleted, within the article too. From what is left the article is taken, without
the elements that are no article text by their tag, role or class.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import SENT_NUMBERS, SPACED, Words, keep, mix, release, sliced
from blockloom.llm.components import components

#: A container is template beside so many different articles of its host.
MIN_ARTICLES = 5
#: A paragraph, list or table is template with more than this share of its host's articles, and so many at least.
PROSE_SHARE, MIN_PROSE = 0.5, 10
#: Articles are near copies by their five-word shingles: one of ``BANDS`` bands of ``ROWS`` minima is the same,
#: which similarity 0.8 reaches with 0.958 and 0.9 with 0.999. Shorter ones than ``MIN_WORDS`` are compared whole.
SHINGLE, BANDS, ROWS, MIN_WORDS = 5, 8, 5, 40

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
#: Never article text.
OUT = frozenset("script style textarea title noscript iframe noembed noframes template svg math canvas object audio video map form button select option datalist input nav aside footer menu dialog head".split())
ROLES_OUT = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist tooltip".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody tfoot thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p pre blockquote li dd dt figcaption td th tr table ul ol dl b i em strong a span code br u s sub sup small q cite mark".split())
#: What of it is counted: neither headings nor parts of a sentence, a list or a table, which recur by themselves.
UNITS = frozenset("p pre blockquote table ul ol dl".split())
#: An open element that the key's start tag ends.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
_P_SCOPE = ("table", "td", "th", "button", "object", "caption")
_HINTS = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|adv|advert|adverts|advertisement|advertising|adsense|sponsor|sponsored|promo|promotion|banner|cookie|cookies|consent|gdpr|notice|notices|"
    r"newsletter|subscribe|subscription|signup|share|sharing|social|sidebar|side|rail|menu|menus|nav|navbar|navigation|breadcrumb|breadcrumbs|footer|foot|header|masthead|topbar|"
    r"comment|comments|commentlist|disqus|replies|reply|respond|discussion|related|recommended|recommendations|popup|modal|overlay|toolbar|pagination|pager|"
    r"login|search|widget|widgets|copyright|skip|paywall|alert|toc)(?:$|[^a-z])|cookie|sidebar|navbar|advert|newsletter|commentlist|comment-"
)
_CONTENT = re.compile(r"(?:^|[^a-z])(?:article|articlebody|content|entry|post|story|main|maincontent)(?:$|[^a-z])")
#: Within a marked article only whole class names of containers tell: words of them may be the article's own.
_SURE = re.compile(
    r"(?:^|\s)(?:ads?|adv|advert\w*|adsense|ad-[\w-]+|sponsored[\w-]*|promo|cookie-[\w-]+|notice|site-notice|newsletter[\w-]*|subscribe|signup|share|sharing|"
    r"share-(?:bar|buttons?|links?|tools?)|social(?:-[\w-]+)?|sidebar|breadcrumbs?|nav|navbar|navigation|menu|comments?|comment-?list|comments?-[\w-]+|"
    r"disqus[\w-]*|replies|respond|related-(?:posts|articles|links|stories)|recommended|recommendations)(?:$|\s)"
)
_HOLDERS = frozenset("div section article ul ol".split())


class Node:
    __slots__ = ("tag", "attributes", "children", "hash", "place")

    def __init__(self, tag: str, attributes: str = "", place: int = 0):
        self.tag, self.attributes, self.children, self.hash, self.place = tag, attributes, [], 0, place

    def named(self) -> dict[str, str]:
        return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(self.attributes)} if self.attributes.strip() else {}


def parse(page: str) -> Node:
    """A tree of elements and strings; left-out end tags as browsers have them."""
    root = Node("#page")
    stack = [root]
    places: defaultdict[str, list[int]] = defaultdict(list)  # of a tag's open elements in the stack
    at, n = 0, len(page)
    low = None

    def last(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def end_from(i: int) -> None:
        for open_node in stack[i:]:
            places[open_node.tag].pop()
        del stack[i:]

    def begin(node: Node) -> None:
        places[node.tag].append(len(stack))
        stack.append(node)

    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            text = m[0]
            if text[0] != "<" or text == "<":
                stack[-1].children.append(text)
            continue
        tag = name.lower()
        if m[1]:
            if places[tag]:
                end_from(places[tag][-1])
            elif tag == "br":
                stack[-1].children.append(Node("br"))
            continue
        if tag in BLOCKS and places["p"] and places["p"][-1] > last(_P_SCOPE):
            end_from(places["p"][-1])
        if tag in _ENDS:
            first = last(_ENDS[tag])
            if first > last(_SCOPE[tag]):
                while first > 1 and stack[first - 1].tag in _ENDS[tag]:
                    first -= 1
                end_from(first)
        elif tag == "body" and len(stack) > 1 and stack[-1].tag == "head":
            end_from(len(stack) - 1)
        node = Node(tag, m[3], at)
        stack[-1].children.append(node)
        if tag in RAW:
            if low is None:
                low = page.lower() if len(page.lower()) == n else page
            end = low.find("</" + tag, at)
            if end < 0:
                at = n
            else:
                node.children.append(page[at:end])
                close = page.find(">", end)
                at = n if close < 0 else close + 1
        elif tag not in VOID and not m[3].endswith("/"):
            begin(node)
        elif tag not in VOID and tag not in ("svg", "path", "circle", "rect", "use", "g"):
            begin(node)  # a slash does not end an HTML element
    return root


def _walk(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if c.__class__ is Node)


def _hash_all(root: Node) -> None:
    """Hash every subtree: tag, strings without their spacing, children."""
    order = list(_walk(root))
    for node in reversed(order):
        parts = [node.tag]
        for c in node.children:
            if c.__class__ is Node:
                parts.append(f"\x01{c.hash:x}")
            elif t := _SPACE.sub(" ", c).strip():
                parts.append("\x02" + t)
        node.hash = xxhash.xxh64_intdigest("".join(parts)) - (1 << 63)


def _outside(node: Node, inside: bool = False) -> bool:
    """No article text by tag or role, nor by class or id: outside a marked article
    words of both on all but prose, within one whole class names of containers."""
    if node.tag in OUT:
        return True
    if not node.attributes or node.tag in ("html", "body", "main"):
        return False
    named = node.named()
    if named.get("role", "").lower() in ROLES_OUT or "hidden" in named or named.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", named.get("style", "")):
        return True
    if inside or node.tag == "article":
        return node.tag in _HOLDERS and bool(_SURE.search(named.get("class", "").lower()))
    if node.tag in PROSE and node.tag not in ("ul", "ol", "table"):
        return False
    return bool(_HINTS.search(f"{named.get('class', '')} {named.get('id', '')}".lower()))


def _article(root: Node) -> tuple[list[Node], bool]:
    """The elements that hold the article, the longest first, and whether the page
    marks them. Of several ``article`` elements, those beside the longest belong to
    it; of equally long ones the first is taken."""
    order: list[Node] = []
    above: dict[int, Node] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        order.append(node)
        for c in reversed(node.children):
            if c.__class__ is Node and not _outside(c):
                above[id(c)] = node
                stack.append(c)
    lengths: dict[int, int] = {}
    for node in reversed(order):
        lengths[id(node)] = sum(lengths.get(id(c), 0) if c.__class__ is Node else len(c) for c in node.children)
    marked: list[Node] = []
    mains: list[Node] = []
    others: list[Node] = []
    body = root
    within: set[int] = set()
    for node in order:
        if id(above.get(id(node))) in within:
            within.add(id(node))
        elif node.tag == "article":
            marked.append(node)
            within.add(id(node))
        elif node.tag == "body":
            body = node
        elif node.tag == "main" or (node.attributes and node.named().get("role") == "main"):
            mains.append(node)
        elif node.tag in ("div", "section") and node.attributes:
            named = node.named()
            if _CONTENT.search(f"{named.get('class', '')} {named.get('id', '')} {named.get('itemprop', '')}".lower()):
                others.append(node)
    if marked:
        best = max(marked, key=lambda x: lengths[id(x)])
        return [best, *(x for x in marked if x is not best and above[id(x)] is above[id(best)])], True
    if mains:
        return [max(mains, key=lambda x: lengths[id(x)])], True
    if others:
        best = max(others, key=lambda x: lengths[id(x)])
        if 2 * lengths[id(best)] > lengths[id(body)]:
            return [best], False
    return [body], False


def _candidates(root: Node, article: Node) -> tuple[set[int], set[int]]:
    """Hashes of a page's containers and of its prose that may be template: all but
    the article's main element and what holds it."""
    above: dict[int, Node] = {}
    order = list(_walk(root))
    for node in order:
        for c in node.children:
            if c.__class__ is Node:
                above[id(c)] = node
    holders = set()
    up: Node | None = article
    while up is not None:
        holders.add(id(up))
        up = above.get(id(up))
    containers: set[int] = set()
    prose: set[int] = set()
    for node in order:
        if id(node) not in holders and node.children and node.tag not in ("html", "head", "body"):
            if node.tag in UNITS:
                prose.add(node.hash)
            elif node.tag not in PROSE and node.tag not in OUT:
                containers.add(node.hash)
    return containers, prose


def subtrees(page: str) -> tuple[set[int], set[int], str]:
    """Hashes of a page's containers and prose that may be template, and its article's text."""
    root = parse(page)
    _hash_all(root)
    article, marked = _article(root)
    return *_candidates(root, article[0]), "\n\n".join(_blocks(article, marked, frozenset()))


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """The article's blocks, joined by empty lines."""
    root = parse(page)
    if template:
        _hash_all(root)
    article, marked = _article(root)
    return "\n\n".join(_blocks(article, marked, template))


def _top_headings(header: Node) -> list[Node]:
    found, stack = [], [header]
    while stack:
        node = stack.pop()
        if node.tag in HEADINGS:
            found.append(node)
        else:
            stack.extend(c for c in reversed(node.children) if c.__class__ is Node)
    return found


def _blocks(article: list[Node], marked: bool, template: frozenset[int]) -> list[str]:
    """The blocks of the article's elements, in page order, without template."""
    blocks: list[str] = []
    now: list[str] = []

    def close() -> None:
        if now:
            text = " ".join(html.unescape("".join(now)).split())
            if text:
                blocks.append(text)
            now.clear()

    main = article[0]
    # depth first without recursion; None ends a block
    stack: list = list(reversed(sorted(article, key=lambda x: x.place)))
    while stack:
        node = stack.pop()
        if node is None:
            close()
        elif node.__class__ is str:
            now.append(node)
        elif node is not main and (_outside(node, marked) or (template and node.hash in template)):
            now.append(" ")
        else:
            tag = node.tag
            children = node.children
            if tag == "header":
                children = _top_headings(node) if marked else []
            if tag in BLOCKS or node is main:
                close()
                stack.append(None)
            elif tag in ("br", "td", "th"):
                now.append(" ")
            stack.extend(reversed(children))
    close()
    return blocks


def host(url: str = "url") -> Column:
    """The host of an address, '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


_SEEDS = np.random.default_rng(7).integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)


def band_keys(texts: list[str]) -> list[list[int]]:
    """A key for every band of the texts' five-word shingles; none of texts under ``MIN_WORDS`` words."""
    out: list[list[int]] = [[] for _ in texts]
    for at, _, data, offsets in sliced(pa.array(texts, pa.string())):
        words = Words(data, offsets, SPACED)
        grams, doc = words.grams(SHINGLE)[words.inside(SHINGLE)], words.doc[: max(0, len(words.doc) - SHINGLE + 1)][words.inside(SHINGLE)]
        if not len(grams):
            continue
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        keys = np.zeros((len(first), BANDS), np.uint64)
        for b in range(BANDS):
            for r in range(ROWS):
                keys[:, b] = mix(keys[:, b] ^ np.minimum.reduceat(mix(grams ^ _SEEDS[b * ROWS + r]), first))
            keys[:, b] = mix(keys[:, b] + np.uint64(b))
        for d, row in zip(doc[first].tolist(), keys.view(np.int64).tolist(), strict=True):
            if words.count[d] >= MIN_WORDS:
                out[at + d] = row
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = pa.list_(pa.int64())
    for batch in batches:
        found = [subtrees(page.as_py()) for page in batch.column(2)]
        texts = [text for _, _, text in found]
        article = [xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(article, pa.int64())]
            + [pa.array(x, hashes) for x in (band_keys(texts), [list(c) for c, _, _ in found], [list(p) for _, p, _ in found])],
            names=["host", "page", "article", "bands", "containers", "prose"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py(), frozenset(t.as_py() or ())) for page, t in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def elements(pages: DataFrame) -> DataFrame:
    """Of every different page of a host: ``host``, ``page`` (its hash), ``article`` (that of
    host and article text), ``bands``, and the hashes of its ``containers`` and ``prose``."""
    sited = pages.select(host().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    named = sited.select("host", F.xxhash64("host", "html").alias("page"), "html")
    found = named.mapInArrow(_count, "host string, page long, article long, bands array<long>, containers array<long>, prose array<long>")
    return found.withColumn("article", F.xxhash64("host", "article")).withColumn("bands", F.transform("bands", lambda b: F.xxhash64("host", b)))


def templates(found: DataFrame) -> DataFrame:
    """``host`` and ``subtree`` of all template among the stored ``elements``."""
    banded = found.select("article", F.explode("bands").alias("band")).distinct()
    least = banded.groupBy("band").agg(F.min("article").alias("least"))
    alike = banded.join(least, "band").where("article <> least").select(F.col("article").alias("a"), F.col("least").alias("b")).distinct()
    joined = components(alike)
    named = found.join(joined, F.col("article") == F.col("node"), "left").withColumn("story", F.coalesce("component", "article"))
    total = named.groupBy("host").agg(F.countDistinct("story").alias("stories"))

    def counted(column: str) -> DataFrame:
        beside = named.select("host", "story", F.explode(column).alias("subtree")).distinct()
        return beside.groupBy("host", "subtree").agg(F.count("*").alias("n"))

    containers = counted("containers").where(F.col("n") >= MIN_ARTICLES).select("host", "subtree")
    prose = counted("prose").where(F.col("n") >= MIN_PROSE).join(total, "host").where(F.col("n") > PROSE_SHARE * F.col("stories"))
    out = keep(containers.unionByName(prose.select("host", "subtree")), "templates")
    release(joined)
    return out


def extract_text(pages: DataFrame, most_sent: int = SENT_NUMBERS) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row.

    Null and empty pages give an empty text, a null address counts for the host
    ''. Repeated rows each get their text and count once, as do near copies of
    an article. Hosts of fewer than ``MIN_ARTICLES`` articles have no template.
    Nesting may be of any depth. Other columns are ignored, whatever their names.
    Up to ``most_sent`` template hashes are sent to the tasks as lists of their
    hosts; beyond that each page meets its own ones by a join.
    """
    found = keep(elements(pages), "elements")
    recurring = templates(found)
    sited = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host().alias("host"))
    if recurring.count() <= most_sent:
        lists = recurring.groupBy("host").agg(F.sort_array(F.collect_list("subtree")).alias("template"))
        joined = sited.join(F.broadcast(lists), "host", "left")
        release(found)
    else:
        own = found.dropDuplicates(["page"]).select("host", "page", F.explode(F.concat("containers", "prose")).alias("subtree"))
        lists = own.join(recurring, ["host", "subtree"], "left_semi").groupBy("page").agg(F.sort_array(F.collect_set("subtree")).alias("template"))
        joined = sited.withColumn("page", F.xxhash64("host", "html")).join(lists, "page", "left")
    kinds = dict(pages.dtypes)
    out = joined.select("page_id", "url", "html", "template").mapInArrow(_extract, f"page_id {kinds['page_id']}, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
