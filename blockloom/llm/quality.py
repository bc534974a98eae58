"""Quality rules: fixed rules first, then robust multivariate outliers.

Each text gives a vector of transformed statistics. Per language and source the
minimum-covariance-determinant estimate of centre and scatter is found by
concentration steps from a median start: measure everyone's distance, keep the
closest three quarters, estimate again. A step is one aggregation: moments are
summed per group and distance bucket, so the cut and the new estimate come out
of the same small table. Vectors are fixed-point numbers, sums are therefore
exact and do not depend on how rows are partitioned.

Only DataFrame functions are used; no row leaves the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from blockloom.llm.common import keep, release, rows_by_key, same, text_key

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Fixed-point unit of the vectors.
UNIT = 1024
#: Smallest scale each statistic is given, added to the scatter. It keeps groups
#: without any spread, such as texts without symbols, from rejecting the first
#: text that differs a little.
FLOORS = {"symbols": 1.0, "word_length": 0.15, "repeats": 0.1, "dup_lines": 0.1, "capitals": 0.07}
NAMES = tuple(FLOORS)
#: Share of a group that the estimate rests on.
CORE = 0.75
STEPS = 5
#: Groups below this many texts are pooled per language, then over all languages.
MIN_GROUP = 200
#: Of the chi-squared distribution.
LEVEL = 0.9999


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""
    n = F.size(words)
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(
        F.array().cast("array<bigint>")
    )

    def places(found: Column) -> Column:
        def doubled(pairs: Column) -> Column:
            here = lambda j: F.get(pairs, j)["h"]
            again = F.filter(
                pairs, lambda p, j: (F.when(j > 0, here(j - 1) == p["h"]).otherwise(False)) | F.coalesce(here(j + 1) == p["h"], F.lit(False))
            )
            return F.sort_array(F.transform(again, lambda p: p["i"]))

        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.array().cast("array<int>")).otherwise(let(pairs, doubled))

    return F.aggregate(
        let(windows, places),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )


def text_statistics(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``tkey``, ``lang``, ``source``, the counted statistics and the base rule, a row per row."""
    text = F.col("text")
    picked = documents.select("doc_id", "lang", "source", text_key().alias("tkey"), F.coalesce("text", F.lit("")).alias("text"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    measured = picked.select(
        "doc_id",
        "tkey",
        "lang",
        "source",
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeated(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("own"))).alias("l"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    )
    return measured.select(
        "doc_id", "tkey", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", (F.col("l.n") - F.col("l.own")).alias("n_dup_lines"), "w.n_repeat_words",
        F.col("l.n").alias("n_lines"), "n_capitals",
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _vector() -> list[Column]:
    """The transformed statistics as fixed-point numbers."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    parts = {
        "symbols": F.log1p(1000 * F.col("n_symbols") / n),
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "repeats": F.col("n_repeat_words") / n,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "capitals": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
    }
    return [F.round(parts[k] * UNIT).cast("long").alias(k) for k in NAMES]


def _groups(vectors: DataFrame) -> DataFrame:
    """The group each language and source is estimated in, small ones pooled."""
    by_source = vectors.groupBy("lang", "source").agg(F.count("*").alias("n"))
    pooled = F.col("n") < MIN_GROUP
    per_language = F.sum(F.when(pooled, F.col("n"))).over(W.partitionBy("lang"))
    name = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    return by_source.select(
        F.col("lang").alias("of_lang"),
        F.col("source").alias("of_source"),
        F.when(~pooled, name("lang", "source")).when(per_language >= MIN_GROUP, name("lang")).otherwise("rest").alias("g"),
    )


def _factor(cell: Callable[[int, int], Column]) -> dict[tuple[int, int], Column]:
    """Expressions of the lower Cholesky factor's entries over columns ``l<i><j>`` made so far."""
    out = {}
    for j in range(len(NAMES)):
        for i in range(j, len(NAMES)):
            rest = cell(i, j)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out[i, j] = F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}")
    return out


def _with_distance(df: DataFrame) -> DataFrame:
    """``d2``, the squared Mahalanobis distance of a vector from its group's
    estimate, by forward substitution: one column a step, so that each step's
    expression stays small."""
    own = df.columns
    for i, name in enumerate(NAMES):
        rest = F.col(name) / UNIT - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        df = df.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return df.select(*own, sum(F.col(f"y{i}") * F.col(f"y{i}") for i in range(len(NAMES))).alias("d2"))


def _chi2(x: float, d: int) -> float:
    """Distribution function of chi-squared, by its series."""
    a, term, total = d / 2, 1.0, 1.0
    for k in range(1, 1000):
        term *= x / 2 / (a + k)
        total += term
    return min(1.0, total * math.exp(a * math.log(x / 2) - x / 2 - math.lgamma(a + 1)))


def _quantile(p: float, d: int) -> float:
    low, high = 1e-9, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, d) < p else (low, mid)
    return (low + high) / 2


def _estimate(moments: DataFrame, inflate: float) -> DataFrame:
    """Centres ``m<i>`` and factors ``l<i><j>`` from exact sums ``n s<i> q<i><j>``."""
    d = range(len(NAMES))
    mean = moments.select("g", *(c for c in moments.columns if c != "g"), *((F.col(f"s{i}") / F.col("n") / UNIT).alias(f"m{i}") for i in d))

    def scatter(i: int, j: int) -> Column:
        spread = F.col(f"q{i}{j}") / F.col("n") / (UNIT * UNIT) - F.col(f"m{i}") * F.col(f"m{j}")
        return inflate * spread + (FLOORS[NAMES[i]] ** 2 if i == j else 0)

    out = mean
    for (i, j), cell in _factor(scatter).items():
        out = out.withColumn(f"l{i}{j}", cell)
    return out.select("g", *(f"m{i}" for i in d), *(f"l{i}{j}" for i in d for j in range(i + 1)))


def robust_estimates(vectors: DataFrame) -> DataFrame:
    """Centre and scatter per group of ``vectors`` (``g`` and the statistics)."""
    d = range(len(NAMES))
    inflate = CORE / _chi2(_quantile(CORE, len(NAMES)), len(NAMES) + 2)
    # values are fixed-point and bounded, so the exact percentiles hold bounded maps
    start = vectors.groupBy("g").agg(*(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(c) for c in NAMES))
    scale = lambda c: F.sqrt(F.pow((F.get(c, 2) - F.get(c, 0)) / (1.349 * UNIT), 2) + FLOORS[c] ** 2)
    estimate = keep(
        start.select("g", *((F.get(NAMES[i], 1) / UNIT).alias(f"m{i}") for i in d), *((scale(NAMES[i]) if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in d for j in range(i + 1))),
        "start",
    )
    sums = [f"s{i}" for i in d] + [f"q{i}{j}" for i in d for j in range(i + 1)]
    for _ in range(STEPS):
        at = _with_distance(vectors.join(estimate, "g")).withColumn("bucket", F.least(F.floor(64 * F.log2(1 + 16 * F.col("d2"))), F.lit(4095)))
        cells = at.groupBy("g", "bucket").agg(
            F.count("*").alias("n"),
            *(F.sum(NAMES[i]).alias(f"s{i}") for i in d),
            *(F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"q{i}{j}") for i in d for j in range(i + 1)),
        )
        nearer = F.sum("n").over(W.partitionBy("g").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
        core = cells.select("*", F.coalesce(nearer, F.lit(0)).alias("nearer"), F.sum("n").over(W.partitionBy("g")).alias("all")).where(F.col("nearer") < F.ceil(CORE * F.col("all")))
        moments = core.groupBy("g").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in sums))
        before, estimate = estimate, keep(_estimate(moments, inflate), "estimate")
        release(before)
    return estimate


def quality_verdicts(documents: DataFrame) -> DataFrame:
    """The statistics of every row with ``base_failed`` and ``kept``.

    Null texts count as empty: no words, so the base rule fails. Null languages
    and sources form groups of their own. Repeated rows each get their row. A
    group of fewer than twenty texts after pooling rejects nothing beyond the
    base rule. Columns other than doc_id, text, lang and source are ignored.
    """
    measured = keep(text_statistics(documents), "text-statistics")
    vectors = measured.where("not base_failed").select("lang", "source", *_vector())
    groups = keep(_groups(vectors), "groups")
    same_group = same(F.col("lang"), F.col("of_lang")) & same(F.col("source"), F.col("of_source"))
    grouped = keep(vectors.join(groups, same_group).select("g", *NAMES), "vectors")
    enough = grouped.groupBy("g").agg(F.count("*").alias("size")).where("size >= 20")
    estimate = keep(robust_estimates(grouped).join(enough, "g").drop("size"), "estimates")
    release(grouped)
    found = _with_distance(measured.select("*", *_vector()).join(groups, same_group, "left").join(estimate, "g", "left"))
    limit = _quantile(LEVEL, len(NAMES))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= limit, F.lit(True))
    return found.select(
        "doc_id", "tkey", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.round("d2", 3).alias("distance")
    )


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents, rows and columns as they are, without rejected ones."""
    return rows_by_key(documents, quality_verdicts(documents).where(~F.col("kept")), "left_anti")
