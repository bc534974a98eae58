"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positive examples; every other text is unlabelled,
toxic ones among them. With p the share of toxic texts, the risk of calling clean
texts toxic is that of all unlabelled texts less p times that of the positives.
On finite samples this estimate can fall below zero, which is how such learners
overfit; a step then goes the other way, until it is not negative any more.

A text is the set of its words, folded into ``2**BITS`` cells by their hashes. The
classifier, a linear one under the logistic loss, sees the cells whose share among
the positives differs significantly from that among the unlabelled texts. It is
fitted on the driver from a sample of distinct texts, ``POSITIVES`` and
``UNLABELLED`` at most, those of the least hashes; every text is scored whole where
it lies. Identical texts count once in the sample and in the share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import ALNUM, Words, keep, release, same, sliced, text_key

BITS = 20
#: Texts to fit from, at most.
POSITIVES, UNLABELLED = 4_096, 16_384
#: Standard errors by which a cell's shares have to differ, positive texts that
#: have it at least, and cells the classifier sees at most.
SIGNIFICANT, LEAST_TEXTS, CELLS = 4.0, 2, 4_096
STEPS, RATE, SHRINK = 500, 0.05, 1e-4
#: Bounds of the share of toxic texts, however few labels there are.
PRIOR_RANGE = (0.001, 0.5)


@dataclass
class Classifier:
    """A weight per cell, and the log-odds of a text without any weighted one."""

    weights: np.ndarray
    bias: float
    prior: float


def _cells(words: Words) -> np.ndarray:
    return (words.hash >> np.uint64(64 - BITS)).astype(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text's distinct cells, ascending."""
    for batch in batches:
        for a, b, data, offsets in sliced(batch.column(1)):
            words = Words(data, offsets, ALNUM)
            each = np.unique(words.doc * (1 << BITS) + _cells(words))
            at = np.searchsorted(each, np.arange(b - a + 1) << BITS).astype(np.int32)
            cells = pa.ListArray.from_arrays(pa.array(at), pa.array((each & ((1 << BITS) - 1)).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), cells], names=["tkey", "cells"])


def _least(keys: DataFrame, most: int) -> DataFrame:
    """The rows of the ``most`` least hashes of ``tkey``. What the driver is sent
    for that does not grow with the table: most rows go before by a bound."""
    n = keys.count()
    hashed = keys.withColumn("drawn", F.xxhash64("tkey", F.lit(7)))
    if n > most:
        bound = int((2 * most + 100) / n * 2**62)
        hashed = hashed.where(F.shiftrightunsigned("drawn", 2) <= min(bound, 2**62))
    return hashed.orderBy(F.shiftrightunsigned("drawn", 2), "tkey").limit(most).drop("drawn")


def _sample(documents: DataFrame, keys: DataFrame, most: int) -> list[np.ndarray]:
    """The cells of at most ``most`` of the texts in ``keys`` (doc_id, tkey)."""
    picked = F.broadcast(_least(keys, most).alias("k"))
    on = (F.col("d.tkey") == F.col("k.tkey")) & same(F.col("d.doc_id"), F.col("k.doc_id"))
    texts = documents.select("doc_id", text_key().alias("tkey"), "text").alias("d").join(picked, on, "left_semi")
    found = texts.select("tkey", "text").mapInArrow(_features, "tkey long, cells array<int>").dropDuplicates(["tkey"])
    return [np.asarray(c, np.int64) for c in found.orderBy("tkey").toPandas()["cells"]]


class _Rows:
    """Texts as rows of the chosen cells: row and column of each entry."""

    def __init__(self, texts: list[np.ndarray], column: np.ndarray):
        kept = [column[t][column[t] >= 0] for t in texts]
        self.n = len(kept)
        self.row = np.repeat(np.arange(self.n), [len(k) for k in kept])
        self.col = np.concatenate([np.zeros(0, np.int64), *kept])

    def odds(self, theta: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=theta[self.col], minlength=self.n) + theta[-1]

    def by_column(self, g: np.ndarray, cells: int) -> np.ndarray:
        """Sums of the rows' values by column, and of all."""
        return np.append(np.bincount(self.col, weights=g[self.row], minlength=cells), g.sum())


def _counts(texts: list[np.ndarray]) -> np.ndarray:
    return np.bincount(np.concatenate([np.zeros(0, np.int64), *texts]), minlength=1 << BITS)


def choose_cells(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Cells whose share differs by ``SIGNIFICANT`` standard errors, the surest first."""
    a, c = _counts(positive), _counts(unlabelled)
    n, m = len(positive), len(unlabelled)
    share = (a + c) / (n + m)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n + 1 / m))
    differ = (a / n - c / m) / error
    sure = np.flatnonzero((np.abs(differ) >= SIGNIFICANT) & ((a >= LEAST_TEXTS) | (differ < 0)))
    return sure[np.argsort(-np.abs(differ[sure]), kind="stable")][:CELLS]


def fit_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Classifier:
    """The linear classifier of least non-negative risk, by Adam. Steps are on all
    texts: on small batches chance alone brings the corrected risk below zero.
    Without texts of either kind it knows nothing and calls none toxic."""
    weights = np.zeros(1 << BITS)
    if not positive or not unlabelled:
        return Classifier(weights, -np.inf, prior)
    chosen = choose_cells(positive, unlabelled)
    column = np.full(1 << BITS, -1, np.int64)
    column[chosen] = np.arange(len(chosen))
    p, u = _Rows(positive, column), _Rows(unlabelled, column)
    theta = np.append(np.zeros(len(chosen)), np.log(prior / (1 - prior)))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        gradient = _risk_gradient(theta, p, u, prior)
        gradient[:-1] += SHRINK * theta[:-1]
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient**2 - square)
        rate = RATE * (1 - (step - 1) / STEPS)
        theta = theta - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights[chosen] = theta[:-1]
    return Classifier(weights, float(theta[-1]), prior)


def _risk_gradient(theta: np.ndarray, p: _Rows, u: _Rows, prior: float) -> np.ndarray:
    """Gradient of prior R_p(+) + max(0, R_u(-) - prior R_p(-)); where the second
    part is negative, that of its negation alone."""
    cells = len(theta) - 1
    z_p, z_u = p.odds(theta), u.odds(theta)
    chance_p, chance_u = (np.exp(-np.logaddexp(0, -z)) for z in (z_p, z_u))
    clean = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
    slope = u.by_column(chance_u / u.n, cells) - prior * p.by_column(chance_p / p.n, cells)
    if clean < 0:
        return -slope
    return prior * p.by_column((chance_p - 1) / p.n, cells) + slope


def held_out(doc_id: str = "doc_id") -> Column:
    """Every fifth id by checksum; a null id too, as no label can be its."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def train(documents: DataFrame, labels: DataFrame, prior: float | None = None) -> Classifier:
    """Fit from documents that are not held out. ``labels`` has doc_id and toxic; an
    id with several labels is toxic if one says so, null labels say nothing.
    Without ``prior``, the share of toxic texts is that among the labelled ones."""
    told = labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    texts = documents.where("length(text) > 0").where(~held_out()).select("doc_id", text_key().alias("tkey"))
    known = texts.withColumn("doc_id", F.col("doc_id").cast("long")).join(told, "doc_id", "left")
    keys = keep(known.groupBy("tkey").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")), "keys")
    if prior is None:
        share = keys.agg(F.avg("toxic")).first()[0]
        prior = share or 0.0
    prior = float(np.clip(prior, *PRIOR_RANGE))
    positive = _sample(documents, keys.where("toxic = 1").select("doc_id", "tkey"), POSITIVES)
    unlabelled = _sample(documents, keys.select("doc_id", "tkey"), UNLABELLED)
    release(keys)
    return fit_pu(positive, unlabelled, prior)


def toxicity(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """``doc_id``, ``tkey`` and ``score`` (the chance of toxic) of every row.

    Null and empty texts score like a text without any telling word; rows are
    scored on their own and by their text alone, so repeated rows agree. Other
    columns are ignored; an empty table gives none.
    """
    shared = documents.sparkSession.sparkContext.broadcast((classifier.weights, classifier.bias))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            for a, b, data, offsets in sliced(batch.column(2)):
                words = Words(data, offsets, ALNUM)
                cells = _cells(words)
                telling = np.flatnonzero(weights[cells])
                each = np.unique(words.doc[telling] * (1 << BITS) + cells[telling])
                odds = np.bincount(each >> BITS, weights=weights[each & ((1 << BITS) - 1)], minlength=b - a) + bias
                score = np.exp(-np.logaddexp(0, -odds))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(score)], names=["doc_id", "tkey", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tkey"), "text")
    return rows.mapInArrow(scan, "doc_id long, tkey long, score double")
