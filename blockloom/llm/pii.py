"""Personal data: broad generators, boosted trees on format and context, calibrated cut.

Fixed patterns give the base spans, which always stay. Wider generators propose
further and overlapping spans: any number with separators and long runs of digits
within it, anything around an at sign, spelled-out addresses. Trees are trained on all candidates but
a held-out quarter, those that pass the fixed checks being positive; a candidate beyond the base is
added where the trees' log odds exceed a threshold that keeps the held-out ones precise.

Spans are found, described, counted and scored by SQL functions; Python sees
counts only, on the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm import boosting
from blockloom.llm.common import keep, release, text_key
from blockloom.llm.quality import let

KINDS = ("email", "ip", "card", "phone")

# The fixed patterns, in a form whose matching time is linear: runs are taken
# whole (possessive), and a match starts at a run's start or where the last ended.
_AT = r"(?:(?<![A-Za-z0-9._%+-])|\G)"
BASE = {
    "email": _AT + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "number": r"(?:(?<![0-9])|\G)[+(]{0,2}[0-9]++(?:[\x20().-]{1,3}+[0-9]++)*+",
    "run": r"(?<![0-9])[0-9]{13,19}+(?![0-9])",
    "address": r"(?:(?<![^\s@])|\G)[^\s@]++@[^\s@]++",
    "spelled": r"(?i)(?<![\w.+-])[\w.+-]{1,64}+\x20?[\[(]\x20?at\x20?[\])]\x20?[\w-]++(?:\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[\w-]++)*+",
}
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
HINT = r"(?i)\b(tel|phone|call|fax|mobile|mail|e-?mail|contact|card|visa|account|ip|host|address|ssn)\b"
#: Characters of context on either side.
SIDE = 24
#: Digits of a proposed number.
MIN_DIGITS, MAX_DIGITS = 5, 19
#: Features beyond this count as this in training.
MOST = 255
#: Up to so many different candidates are collected, with their numbers, to train on the driver.
FEW_VECTORS = 20_000
#: Held-out candidates are told apart by steps of this size of their log odds.
STEP = 2**-10
#: Candidates that ``_sample`` takes; training takes all.
TRAIN_ROWS = 10_000
PRECISION = 0.98

FEATURES = ("digits", "letters", "length", "separators", "dots", "at", "plus", "luhn", "octets", "groups", "longest", "left", "right", "hint")


def running_total(numbers: Column) -> Column:
    """Prefix sums of an array of integers by doubling steps: n log n at any length."""

    def step(a: Column, k: Column) -> Column:
        return F.transform(a, lambda x, i: x + F.coalesce(F.get(a, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(numbers))).cast("int") - 1)
    return F.when(F.size(numbers) > 1, F.aggregate(steps, numbers, step)).otherwise(numbers)


def matches(text: Column, pattern: str) -> Column:
    """All matches with their places: array of start, end (code points), value,
    and what stands ``before`` and ``after`` as far as the next matches. What lies
    between matches gives the distances, so no position is sought in the text."""

    def place(found: Column) -> Column:
        values, gaps = found["values"], found["gaps"]
        steps = F.transform(values, lambda v, i: F.length(F.get(gaps, i)) + F.length(v))
        span = lambda ends: lambda v, i: F.struct(
            (F.get(ends, i) - F.length(v)).cast("long").alias("start"), F.get(ends, i).cast("long").alias("end"), v.alias("value"),
            F.right(F.get(gaps, i), F.lit(SIDE)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
        )
        return let(running_total(steps), lambda ends: F.transform(values, span(ends)))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"), F.split(text, pattern, -1).alias("gaps"))
    empty = F.array().cast("array<struct<start: bigint, end: bigint, value: string, before: string, after: string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), let(found, place)).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    each = F.split(F.reverse(digits), "")
    double = lambda x: F.when(2 * x > 9, 2 * x - 9).otherwise(2 * x)
    worth = F.transform(each, lambda c, i: let(F.coalesce(c.try_cast("int"), F.lit(0)), lambda x: F.when(i % 2 == 1, double(x)).otherwise(x)))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(OCTETS)
    if kind == "card":
        return let(_digits(value), lambda d: F.length(d).between(16, 19) & luhn(d))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _side(c: Column) -> Column:
    """The kind of a neighbouring character: 0 none, 1 blank, 2 letter or digit, 3 other."""
    return F.when(F.length(c) == 0, 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}\p{N}]"), 2).otherwise(3)


def _describe(span: Column, kind: Column) -> Column:
    v = span["value"]
    digits = F.length(_digits(v))
    runs = F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))
    number = lambda c: F.when(c, 1).otherwise(0)
    values = (
        digits,
        F.length(F.regexp_replace(v, r"[^\p{L}]", "")),
        F.length(v),
        F.length(F.regexp_replace(v, r"[^\x20().-]", "")),
        F.length(F.regexp_replace(v, r"[^.]", "")),
        number(v.contains("@")),
        number(v.startswith("+")),
        number((digits >= 12) & luhn(_digits(v))),
        number(v.rlike(OCTETS)),
        F.size(runs),
        F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)),
        _side(F.right(span["before"], F.lit(1))),
        _side(span["after"]),
        number(span["before"].rlike(HINT)),
    )
    return F.struct(kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"), *(x.cast("int").alias(n) for x, n in zip(values, FEATURES, strict=True)))


def _base(text: Column) -> Column:
    def of(kind: str) -> Column:
        passed = F.filter(matches(text, BASE[kind]), lambda s: _passes(kind, s["value"]))
        return F.transform(passed, lambda s: _describe(s, F.lit(kind)))

    return F.concat(*map(of, KINDS))


def _proposed(text: Column) -> Column:
    """Wide candidates; the kind of a number follows its shape."""
    shape = lambda v: F.when(F.regexp_count(v, F.lit(r"\.")) == 3, "ip").when(F.length(_digits(v)) >= 14, "card").otherwise("phone")
    numbers = F.filter(matches(text, WIDE["number"]), lambda s: F.length(_digits(s["value"])).between(MIN_DIGITS, MAX_DIGITS))
    return F.concat(
        *(F.transform(x, lambda s: _describe(s, shape(s["value"]))) for x in (numbers, matches(text, WIDE["run"]))),
        *(F.transform(matches(text, WIDE[k]), lambda s: _describe(s, F.lit("email"))) for k in ("address", "spelled")),
    )


def candidates(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``tkey``, ``base`` and ``proposed`` spans with their features, a row per row."""
    picked = documents.select("doc_id", text_key().alias("tkey"), F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    worth = text.rlike(r"[0-9@]|(?i)[\[(]\x20?at\x20?[\])]")
    none = f"array<struct<kind: string, start: bigint, end: bigint, {', '.join(f'{f}: int' for f in FEATURES)}>>"
    some = lambda spans: F.when(worth, spans).otherwise(F.array().cast(none))
    overlaps = lambda s, b: (b["start"] < s["end"]) & (s["start"] < b["end"])
    found = picked.select("doc_id", "tkey", some(_base(text)).alias("base"), some(_proposed(text)).alias("wide"))
    return found.select("doc_id", "tkey", "base", F.filter("wide", lambda s: ~F.exists("base", lambda b: overlaps(s, b))).alias("proposed"))


def _sample(found: DataFrame, column: str) -> list[tuple[int, ...]]:
    """For a look at candidates, not for training: the ``TRAIN_ROWS`` of the least hashes, hash modulo 4, features.
    Only hashes below a bound are ordered, so that the tasks together send about
    twice the sample, whatever their number. Where repeated rows leave less than
    the sample below the bound, it is doubled."""
    order = F.xxhash64("doc_id", "tkey", "s.start", "s.kind")
    spans = found.select("doc_id", "tkey", F.explode(column).alias("s")).select(order.alias("o"), *(F.col(f"s.{f}") for f in FEATURES))
    total = found.agg(F.sum(F.size(column))).first()[0] or 0
    width = 2**64 * 2 * TRAIN_ROWS // max(total, 1)
    while True:
        near = spans if width >= 2**64 else spans.where(F.col("o") < width - 2**63)
        rows = near.orderBy("o", *FEATURES).limit(TRAIN_ROWS).collect()
        if len(rows) >= min(TRAIN_ROWS, total):
            return [(r.o & 3, *(r[f] for f in FEATURES)) for r in rows]
        width *= 2


def vectors(found: DataFrame) -> DataFrame:
    """All candidates, counted: ``label`` (1 base, 0 proposed), ``held`` (out of
    training, a quarter by hash), features, and ``n``, how many are alike in these."""
    held = F.xxhash64("doc_id", "tkey", "s.start", "s.kind").bitwiseAND(3) == 0
    alike = [F.least(F.col(f"s.{f}"), F.lit(MOST)).alias(f) for f in FEATURES]
    each = [
        found.select("doc_id", "tkey", F.explode(column).alias("s")).select(F.lit(label).alias("label"), held.alias("held"), *alike)
        for label, column in ((1, "base"), (0, "proposed"))
    ]
    return each[0].unionByName(each[1]).groupBy("label", "held", *FEATURES).agg(F.count("*").alias("n"))


def train(found: DataFrame) -> tuple[list[boosting.Tree], float] | None:
    """Trees and threshold from all candidates; none where a label is missing or
    nothing is precise enough. Up to ``FEW_VECTORS`` different ones are counted
    on the driver, more by an aggregation a pass."""
    table = keep(vectors(found), "vectors")
    sizes = {(r.held, r.label): r.vectors for r in table.groupBy("held", "label").agg(F.count("*").alias("vectors")).collect()}
    model = None
    if sizes.get((False, 0)) and sizes.get((False, 1)) and len(sizes) > 2:
        model = _from_few(table) if sum(sizes.values()) <= FEW_VECTORS else _from_many(table)
    release(table)
    return model


def _from_few(table: DataFrame) -> tuple[list[boosting.Tree], float] | None:
    data = np.array(sorted(map(tuple, table.select("held", "label", "n", *FEATURES).collect())), np.float64)
    held = data[:, 0] == 1
    taught, kept = data[~held], data[held]
    trees = boosting.fit(taught[:, 3:], taught[:, 1], taught[:, 2])
    return _with_cut(trees, np.floor(boosting.log_odds(trees, kept[:, 3:]) / STEP), kept[:, 1], kept[:, 2])


def _from_many(table: DataFrame) -> tuple[list[boosting.Tree], float] | None:
    trees = boosting.fit_table(table.where("not held"), FEATURES, MOST)
    odds = boosting.score(trees, lambda f: F.col(FEATURES[f]))
    cells = table.where("held").groupBy(F.floor(odds / STEP).alias("step")).agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n"))
    step, right, n = np.array([tuple(r) for r in cells.collect()], np.float64).T
    return _with_cut(trees, step, right / n, n)


def _with_cut(trees: list[boosting.Tree], step: np.ndarray, right: np.ndarray, n: np.ndarray) -> tuple[list[boosting.Tree], float] | None:
    """The threshold in steps of log odds, so that held-out candidates make few."""
    cut = boosting.threshold(step, right, PRECISION, n)
    return None if cut is None else (trees, cut * STEP)


def personal_spans(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``tkey``, ``base`` and ``spans``: arrays of kind, start
    and end (code points, end exclusive) by kind, then start.

    Null and empty texts have no spans. Repeated rows agree. Where no candidate
    beyond the base exists to learn from, none is added. Columns besides doc_id
    and text are ignored.
    """
    found = keep(candidates(documents), "candidates")
    model = train(found)
    place = lambda s: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    bare = lambda c: F.transform(F.array_sort(F.transform(c, place)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    added = F.slice("proposed", 1, 0)
    if model:
        trees, cut = model
        feature = lambda s: lambda f: s[FEATURES[f]]
        added = F.filter("proposed", lambda s: boosting.score(trees, feature(s)) >= cut)
    return found.select("doc_id", "tkey", bare(F.col("base")).alias("base"), bare(F.array_distinct(F.concat("base", added))).alias("spans"))
