"""Whitening against a full eigendecomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from blockloom.llm import whitening
from blockloom.llm.queries import QUERIES
from blockloom.llm.whitening import principal_components, whiten

SCHEMA = "vec_id long, embedding array<float>, id string, wide int"


def plain(vectors, k=8):
    """Deviations, whitened rows and shares of the trace, from the whole covariance."""
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = (n * x - sums) / n
    cov = centred.T @ centred / n
    values, q = np.linalg.eigh(cov)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    return deviation, centred @ q / np.sqrt(values), values / np.trace(cov)


def check(rows, vectors, k=8, atol=1e-8):
    deviation, white, explained = plain(vectors, k)
    assert len(rows) == len(vectors) * k
    got = np.zeros_like(white)
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.n == len(vectors) and r.deviation == deviation[r.vec_id]
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
        assert r.identity_error <= 1e-9
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < atol


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_equals_full_decomposition(spark, folder):
    rows = QUERIES["op11_whitening"](spark, folder).collect()
    check(rows, [r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()])


def test_many_dimensions_with_a_steep_and_a_flat_spectrum(spark):
    rng = np.random.default_rng(3)
    for spread in (np.geomspace(3, 0.01, 100), np.concatenate([[2.0, 1.9, 1.8], np.full(97, 0.5)])):
        vectors = (rng.standard_normal((600, 100)) * spread).astype(np.float32)
        rows = whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(5), components=3).collect()
        check(rows, vectors, 3)


def test_filter_needs_fewer_passes_than_plain_iteration(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((500, 80)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    passes = principal_components(frame, components=2).passes
    monkeypatch.setattr(whitening, "MAX_PASSES", 2)
    with pytest.raises(RuntimeError, match="residual"):
        principal_components(frame, components=2)
    assert passes < 60


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 0.5], [0.25, 1.0, -1.0], [0.0, 0.0, 3.0], [1.0, 2.0, 0.5], [-2.0, 1.5, 1e-9]]
    odd = [None, [1.0, None, 2.0], [nan, 0.0, 0.0], [0.0, inf, 0.0], [0.0, 0.0, -inf], [1.0], []]
    rows = [(i, v, "x", None) for i, v in enumerate(good)] + [(90 + i, v, None, 3) for i, v in enumerate(odd)]
    out = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    check(out, good, 3)
    assert out[0].whitened is not None and [r.whitened for r in out if r.vec_id == 0] == [r.whitened for r in out if r.vec_id == 3]
    again = whiten(spark.createDataFrame([(None, v, "x", 1) for v in good], SCHEMA)).collect()
    assert {r.vec_id for r in again} == {None} and len(again) == 15
    doubles = whiten(spark.createDataFrame([(i, v) for i, v in enumerate(good)], "vec_id int, embedding array<double>")).collect()
    check(doubles, good, 3)


def test_no_variance_gives_no_component(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(i, [2.0, 3.0]) for i in range(4)]):
        assert whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(6)]
    out = whiten(spark.createDataFrame(line, "vec_id long, embedding array<float>")).collect()
    assert {r.component for r in out} == {1} and abs(out[0].explained - 1) < 1e-12


def test_deviation_is_exact_or_null(spark):
    rows = [(0, [1e12, 0.0]), (1, [-1e12, 1.0]), (2, [3.0, 2.0])]
    out = {r.vec_id: r for r in whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert out[0].deviation is None and out[0].identity_error < 1e-9
    assert math.isclose(out[0].whitened, -out[1].whitened, rel_tol=1e-9)


def test_sums_of_many_tasks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((90, 6)).astype(np.float32)
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 12)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    check(whiten(frame.repartition(8), components=2).collect(), vectors, 2)
