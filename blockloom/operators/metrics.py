"""Evaluation metrics over prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.functions.arrays import argmax_index


def argmax_ids(df: DataFrame, *, logits: str = "logits", out: str = "pred") -> DataFrame:
    """The index of the largest logit; of equal ones the first."""
    return df.withColumn(out, argmax_index(F.col(logits)))


def token_accuracy(df: DataFrame, *, preds: str = "preds", labels: str = "labels", by: Sequence[str] = ()) -> DataFrame:
    """Next-token accuracy: prediction ``i`` against label ``i + 1``.

    Ignored labels count like any other.  Hits are added up per row, so no
    token becomes a row of its own.
    """
    n = F.greatest(F.size(labels) - 1, F.lit(0))
    hit = F.zip_with(F.slice(preds, 1, n), F.slice(labels, 2, n), lambda p, l: p == l)
    rows = df.select(
        *by,
        n.cast("bigint").alias("_n"),
        F.size(F.filter(hit, lambda h: h)).cast("bigint").alias("_hits"),
    )
    return rows.groupBy(*by).agg(
        F.sum("_hits").alias("n_correct"),
        F.sum("_n").alias("n_tokens"),
        (F.sum("_hits") / F.sum("_n")).alias("accuracy"),
    )


def accuracy(
    df: DataFrame,
    *,
    pred: str = "pred",
    label: str = "label",
    normalize: bool = True,
    weight: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Share of equal pairs, or their number with ``normalize=False``; each
    pair may carry a weight."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    hits = F.sum(F.when(F.col(pred) == F.col(label), w).otherwise(0.0))
    return df.groupBy(*by).agg((hits / F.sum(w) if normalize else hits).alias("accuracy"))


def perplexity(df: DataFrame, *, loss: str = "loss", by: Sequence[str] = ()) -> DataFrame:
    """``exp`` of the mean loss; beyond the range of doubles it is infinite."""
    return df.groupBy(*by).agg(F.avg(loss).alias("eval_loss"), F.exp(F.avg(loss)).alias("perplexity"))
