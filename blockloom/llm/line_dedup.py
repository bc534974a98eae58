"""Fuzzy line deduplication by MinHash.

A line's set holds its character shingles: ``SHINGLE`` characters from every
character on, blanks included. One hash orders the set, and
its range is cut into ``BANDS`` stretches: from each stretch's first hash the
``ROWS`` next ones, the range taken as a circle, make a band. Each of them is
the same in two sets with the probability of their Jaccard similarity. Lines
that share a band and whose sets are of like size are compared as whole sets.
Linked lines are joined by distributed union-find, and of each component the
first line stays.

Only DataFrame functions are used; no row leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blockloom.llm.common import keep, release, same, sent, text_key
from blockloom.llm.components import components, remaining_pairs
from blockloom.llm.quality import let

SHINGLE = 5
#: Stretches are told by the hash's four leading bits. Similarity 0.8 is found with
#: probability 1 - (1 - 0.8**5)**16 > 0.998, 0.9 with more than 0.9999; lines of a
#: fifth, as most of one language have, meet with 0.005.
BANDS, ROWS = 16, 5
SIMILAR = 80
#: Of a bucket's only two lines, so many stretches have to begin with the same hash, as far as
#: four bits tell. Similarity 0.8 has fewer with a probability under 0.00002, 0.1 with 0.93.
ALIKE = 6
#: Shorter lines are compared whole, if they take part: a set of so few shingles is no measure of likeness.
MIN_CHARS = 20


def _lines(documents: DataFrame, short: bool = False) -> DataFrame:
    """``doc_id``, ``tkey``, ``at``, ``line`` and its hash ``node`` of all lines
    that take part; with ``short`` also of those under ``MIN_CHARS`` characters
    that are not blank."""
    split = documents.select("doc_id", text_key().alias("tkey"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    long = F.length("line") >= MIN_CHARS
    return split.where(long | F.col("line").rlike(r"\S") if short else long).withColumn("node", F.xxhash64("line"))


def _shingles(line: str) -> Column:
    """The distinct hashes of a line's shingles, ascending. A shorter line is one
    shingle. Four bytes a character make every place a fixed one, so that nothing
    is sought from the line's beginning and the steps stay linear at any length."""
    at = F.sequence(F.lit(1), 4 * F.greatest(F.length(line) - SHINGLE, F.lit(0)) + 1, F.lit(4))
    hashes = let(F.encode(F.col(line), "UTF-32"), lambda raw: F.transform(at, lambda i: F.xxhash64(F.substring(raw, i, F.lit(4 * SHINGLE)))))
    return F.sort_array(F.array_distinct(hashes))


def _with_stretches(lines: DataFrame) -> DataFrame:
    """``n``, the size of the sorted set ``shingles``, and ``at0`` and so on: the place at
    which each stretch begins, the end last. Steps are columns of their own, so that they are compiled."""
    limits = [F.lit((b - BANDS // 2) * (2**64 // BANDS)) for b in range(BANDS)]
    # the stretches' limits sorted in among the hashes: a limit's place less those before it is its stretch's beginning
    out = lines.withColumn("among", F.sort_array(F.concat(F.col("shingles"), F.array(*limits)))).withColumn("n", F.size("shingles"))
    for b in range(BANDS):
        out = out.withColumn(f"at{b}", (F.array_position("among", limits[b]) - b).cast("int"))
    return out.withColumn(f"at{BANDS}", F.col("n") + 1)


def _with_bands(lines: DataFrame) -> DataFrame:
    """``n``, ``bands``: the keys, one of each stretch that has a hash, and ``firsts``:
    four bits of each stretch's first hash, zeros where it has none."""
    own = [c for c in lines.columns if c != "shingles"]
    out = _with_stretches(lines).withColumn("circle", F.concat("shingles", F.slice("shingles", 1, ROWS - 1)))

    def key(b: int) -> Column:
        at = F.col(f"at{b}")
        # (48 bits are exchanged; what meets by chance is compared as sets in any case)
        return F.when(at < F.col(f"at{b + 1}"), F.xxhash64(F.lit(b), F.slice("circle", at, F.lit(ROWS))).bitwiseAND(-(1 << 16)))

    def first(b: int) -> Column:
        at = F.col(f"at{b}")
        return F.when(at < F.col(f"at{b + 1}"), F.shiftleft(F.get("shingles", at - 1).bitwiseAND(15), 4 * b)).otherwise(F.lit(0).cast("long"))

    firsts = reduce(Column.bitwiseOR, map(first, range(BANDS)))
    return out.select(*own, "n", firsts.alias("firsts"), F.array_compact(F.array(*map(key, range(BANDS)))).alias("bands"))


def _may_link(n: str = "n", p_n: str = "p_n") -> Column:
    """Whether the sizes of an entry and another (``p_``) allow a link."""
    return 100 * F.least(n, p_n) >= SIMILAR * F.greatest(n, p_n)


def _alike(firsts: str, p_firsts: str) -> Column:
    """Whether enough stretches of two lines begin alike."""
    apart = F.col(firsts).bitwiseXOR(F.col(p_firsts))
    any_bit = reduce(Column.bitwiseOR, (F.shiftrightunsigned(apart, k) for k in range(4)))
    return BANDS - F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111))) >= ALIKE


def _entries(shared: DataFrame) -> DataFrame:
    """``key``, ``node``, ``n`` and ``rank`` (fewer for more lines) of the entries that may have a link
    in their bucket, and ``p_node`` and ``p_n`` of the bucket's first by rank. Most buckets of unlike
    lines hold two by chance; they go here, before they are pairs."""
    bucket = W.partitionBy("key")
    each = _of_like_size(shared).groupBy("key", "node", "n", "firsts").agg((-F.count("*")).alias("rank"))
    own = F.struct("node", "n", "firsts")
    first = F.min(F.struct("rank", "node", "n")).over(bucket)
    held = each.withColumns({"m": F.count("*").over(bucket), "a": F.min(own).over(bucket), "b": F.max(own).over(bucket), "p": first})
    two = (F.col("m") == 2) & _may_link("a.n", "b.n") & _alike("a.firsts", "b.firsts")
    return held.where((F.col("m") > 2) | two).select("key", "node", "n", "rank", F.col("p.node").alias("p_node"), F.col("p.n").alias("p_n"))


def _first_pairs(entries: DataFrame) -> DataFrame:
    """Pairs (a, b) of every bucket's first node with its others, which know it: nothing is joined."""
    beside = entries.where("node <> p_node").where(_may_link())
    return beside.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()


def _of_like_size(shared: DataFrame) -> DataFrame:
    """The entries beside which, by size, one stands in their bucket whose size allows a
    link. Between two of like size all others are so too: whatever is dropped has no link there."""
    by_size = W.partitionBy("key").orderBy("n", "node")
    beside = shared.withColumns({"before": F.lag("n").over(by_size), "after": F.lead("n").over(by_size)})
    # (least and greatest pass over nulls, which stand where a bucket ends)
    like = [F.col(other).isNotNull() & _may_link("n", other) for other in ("before", "after")]
    return beside.where(like[0] | like[1]).drop("before", "after")


def _with_sketch(lines: DataFrame) -> DataFrame:
    """``n`` and ``sketch``: 64 cells of each stretch, a bit for each with an odd number of hashes."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(x, 54).bitwiseAND(63).cast("int"))

    def word(b: int) -> Column:
        inside = F.slice("shingles", F.col(f"at{b}"), F.col(f"at{b + 1}") - F.col(f"at{b}"))
        return F.aggregate(inside, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(bit(x))).alias(f"s{b}")

    own = [c for c in lines.columns if c != "shingles"]
    return _with_stretches(lines).select(*own, "n", F.struct(*map(word, range(BANDS))).alias("sketch"))


def _sketches_allow(n: str, sketch: str, p_n: str, p_sketch: str) -> Column:
    """Whether the sketches of two sets allow a link. A cell that differs holds a hash
    of one set only, and similar sets have at most (100 - SIMILAR) / (100 + SIMILAR)
    of both sizes of such hashes: no pair that links is held back."""
    apart = sum((F.bit_count(F.col(f"{sketch}.s{w}").bitwiseXOR(F.col(f"{p_sketch}.s{w}"))) for w in range(BANDS)), F.lit(0))
    return (100 + SIMILAR) * apart <= (100 - SIMILAR) * (F.col(n) + F.col(p_n))


def _near(a: str, b: str) -> Column:
    """Whether the sketches of a pair's two sets allow a link."""
    return _sketches_allow(f"n_{a}", f"sketch_{a}", f"n_{b}", f"sketch_{b}")


def _texts(entries: DataFrame, lines: DataFrame) -> DataFrame:
    """``node``, ``line``, ``n`` and ``sketch`` of each line that shares a band, shingled once for all its pairs."""
    asked = entries.select("node").distinct()
    found = lines.join(sent(asked, asked.count()), "node", "left_semi")
    texts = found.groupBy("node").agg(F.first("line").alias("line"))
    return keep(_with_sketch(texts.select("node", "line", _shingles("line").alias("shingles"))), "texts")


def _near_pairs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sketches allow a link."""
    side = lambda node: texts.select(F.col("node").alias(node), *(F.col(c).alias(f"{c}_{node}") for c in ("n", "sketch")))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_near("a", "b")).select("a", "b")


def _links(near: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are similar; lines are shingled again for each pair.
    Lines move, not their sets, which are eight times as large, and only those of a pair."""
    line = lambda node: texts.select(F.col("node").alias(node), F.col("line").alias(f"l{node}"))
    sets = near.join(line("a"), "a").join(line("b"), "b").select("a", "b", _shingles("la").alias("sa"), _shingles("lb").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    sized = sets.select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).alias("n"))
    return keep(sized.where(100 * F.col("both") >= SIMILAR * (F.col("n") - F.col("both"))).select("a", "b"), "links")


def repeated_lines(documents: DataFrame, short: bool = False) -> DataFrame:
    """``doc_id``, ``tkey`` and ``at`` of each line that goes: all but the first
    of its component, in the order of document ids (nulls last), text hashes and
    line numbers. Of a repeated row, one row's lines are the first. With ``short``,
    lines under ``MIN_CHARS`` characters go where they are exact repeats."""
    lines = _lines(documents).select("node", "line")
    banded = _with_bands(lines.select("node", _shingles("line").alias("shingles")))
    # one exchange brings a band's entries together; those of a single line go there
    bucket = W.partitionBy("key")
    # (a plain explode would have all of the above evaluated once more, to see whether there are bands)
    each = banded.select("node", "n", "firsts", F.explode_outer("bands").alias("key"))
    shared = each.withColumns({"low": F.min("node").over(bucket), "high": F.max("node").over(bucket)}).where("low <> high")
    entries = keep(_entries(shared), "entries")
    texts = _texts(entries, lines)
    near_pairs = keep(_near_pairs(_first_pairs(entries), texts), "pairs")
    near = _links(near_pairs, texts)
    found = components(near)
    # A bucket's first has been held against all others, so it needs no more, nor do buckets of two.
    # (other entries of a bucket in several components meet all others: what the sketches hold back never is a row)
    others = entries.where("node <> p_node").select("key", "node", "n")
    allowed = _may_link() & _sketches_allow("n", "sketch", "p_n", "p_sketch")
    far_pairs = keep(remaining_pairs(others, found, allowed, texts.select("node", "sketch")), "pairs")
    release(entries, near_pairs)
    if not far_pairs.isEmpty():
        far = _links(far_pairs, texts)
        release(found)
        found = components(near.unionByName(far))
        release(far)
    release(texts, far_pairs, near)
    named = _lines(documents, short).select("doc_id", "tkey", "at", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey", "at")
    first = named.groupBy("component").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return named.join(first, "component").where(place > F.col("first")).select("doc_id", "tkey", "at")


def without_repeats(documents: DataFrame, short: bool = False) -> DataFrame:
    """The documents with ``n_lines`` (all lines), ``n_removed`` and ``text``
    without its repeated lines; other columns as they are.

    Null and empty texts have no lines and stay. Lines under ``MIN_CHARS``
    characters stay unless ``short``: then exact repeats of them go, but for blank
    lines. Rows with equal id and text lose the same lines:
    their first lines stay in each.
    """
    gone = repeated_lines(documents, short).groupBy("doc_id", "tkey").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    gone = keep(gone, "gone")
    removed = gone.agg(F.sum(F.size("gone") + 2)).first()[0]
    on = same(F.col("d.doc_id"), F.col("z.doc_id")) & (F.xxhash64(F.col("d.text")) == F.col("z.tkey"))
    own = [F.col(f"d.`{c}`") for c in documents.columns if c not in ("text", "n_lines", "n_removed")]
    lines = F.split("d.text", "\n", -1)
    n_lines = F.when(F.length("d.text") > 0, F.size(lines)).otherwise(0)
    # both lists ascend, so a line number counts as gone by its place in a set difference
    rest = let(
        F.struct(lines.alias("x"), F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "z.gone").alias("stay")), lambda v: F.array_join(F.transform(v["stay"], lambda i: F.get(v["x"], i)), "\n")
    )
    joined = documents.alias("d").join(sent(gone, removed or 0).alias("z"), on, "left")
    return joined.select(
        *own,
        F.when(F.col("z.gone").isNull(), F.col("d.text")).otherwise(rest).alias("text"),
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("z.gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def dedup_lines(documents: DataFrame, short: bool = False) -> DataFrame:
    """The documents with their columns, repeated lines out, ``n_chars`` anew;
    those that lost every line are gone."""
    changed = without_repeats(documents, short).where("n_removed = 0 or text rlike '\\\\S'")
    out = {c: F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in documents.columns}
    return changed.select(*out.values())
