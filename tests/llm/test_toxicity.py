"""Positive-unlabelled learning: its gradient, what it learns, and held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from blockloom.llm import toxicity as tox
from blockloom.llm.queries import QUERIES
from blockloom.llm.toxicity import _risk_gradient, _Rows, fit_pu, toxicity, train

SCHEMA = "doc_id long, text string, score double, tkey string"


def texts_of(rng, n, toxic_share):
    """Sets of cells; toxic ones (cells 0 to 4 are telling) among them."""
    toxic = rng.random(n) < toxic_share
    sets = [np.unique(np.concatenate([rng.integers(100, 3000, 40), rng.integers(0, 5, 2) if t else rng.integers(50, 60, 1)])) for t in toxic]
    return sets, toxic


def test_gradient_is_that_of_the_risk():
    rng = np.random.default_rng(0)
    column = np.arange(1 << tox.BITS)
    column[8:] = -1
    p, u = (_Rows([np.flatnonzero(rng.random(8) < 0.4) for _ in range(n)], column) for n in (20, 50))
    theta = rng.standard_normal(9)

    def risk(t, part):
        z = lambda x: np.array([t[x.col[x.row == i]].sum() for i in range(x.n)]) + t[-1]
        clean = np.logaddexp(0, z(u)).mean() - prior * np.logaddexp(0, z(p)).mean()
        return -clean if part else prior * np.logaddexp(0, -z(p)).mean() + clean, clean

    for prior in (0.2, 0.95):
        negative = risk(theta, False)[1] < 0
        numeric = [(risk(theta + e, negative)[0] - risk(theta - e, negative)[0]) / 2e-6 for e in 1e-6 * np.eye(9)]
        assert np.allclose(_risk_gradient(theta, p, u, prior), numeric, atol=1e-6)
    # positives of the telling cells only, so that the corrected part falls below zero
    p, prior = _Rows([np.arange(4)] * 20, column), 0.95
    theta = np.array([2.0, 2, 2, 2, 0, 0, 0, 0, -6])
    assert risk(theta, False)[1] < 0
    numeric = [(risk(theta + e, True)[0] - risk(theta - e, True)[0]) / 2e-6 for e in 1e-6 * np.eye(9)]
    assert np.allclose(_risk_gradient(theta, p, u, prior), numeric, atol=1e-5)


def test_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(1)
    positive, _ = texts_of(rng, 200, 1.0)
    unlabelled, _ = texts_of(rng, 3000, 0.15)
    fresh, toxic = texts_of(rng, 2000, 0.15)
    model = fit_pu(positive, unlabelled, 0.15)
    called = np.array([model.weights[t].sum() + model.bias >= 0 for t in fresh])
    assert called[toxic].mean() > 0.98 and called[~toxic].mean() < 0.01


def test_without_examples_nothing_is_toxic():
    model = fit_pu([], [np.array([1])], 0.1)
    assert not model.weights.any() and model.bias == -np.inf


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op12_toxicity"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    held = [(got[r.doc_id], r.toxic) for r in labels if got[r.doc_id].held_out]
    caught = np.mean([r.predicted for r, t in held if t])
    wrong = np.mean([r.predicted for r, t in held if not t])
    assert caught >= 0.8 and wrong <= 0.01, (caught, wrong)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    first = train(documents, labels)
    other = train(documents.selectExpr("doc_id", "text", "'x' as lang").repartition(7), labels.selectExpr("doc_id", "if(crc32(string(doc_id)) % 5 = 0, 1 - toxic, toxic) as toxic"))
    assert np.array_equal(first.weights, other.weights) and first.bias == other.bias and first.weights.any()


def test_sample_bounds(spark, monkeypatch):
    keys = spark.range(5_000).selectExpr("id as doc_id", "xxhash64(id) as tkey")
    hashed = sorted((r.h % 2**64 >> 2, r.tkey) for r in keys.selectExpr("tkey", "xxhash64(tkey, 7) as h").collect())
    assert sorted(r.tkey for r in tox._least(keys, 100).collect()) == sorted(k for _, k in hashed[:100])
    assert tox._least(keys, 9_000).count() == 5_000


def test_odd_rows(spark):
    rows = [(1, None, 0.5, "x"), (2, "", 0.5, None), (None, "bad word", 1.0, "x"), (3, "Bad WORD", 1.0, "x"), (3, "Bad WORD", 1.0, "x"), (4, "fine", 0.0, "x")]
    documents = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    model = train(documents, labels)
    out = toxicity(documents, model).collect()
    assert len(out) == 6 and len({r.score for r in out if r.doc_id == 3}) == 1
    assert {r.score for r in out if r.doc_id in (1, 2)} == {r.score for r in out if r.doc_id == 4}
    empty = spark.createDataFrame([], SCHEMA)
    none = train(empty, labels)
    assert toxicity(empty, none).collect() == [] and {r.score for r in toxicity(documents, none).collect()} == {0.0}


@pytest.mark.parametrize("prior", [0.0, 1.0])
def test_prior_is_kept_in_bounds(spark, prior):
    documents = spark.createDataFrame([(i, f"w{i % 3} x") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, toxic int")
    assert tox.PRIOR_RANGE[0] <= train(documents, labels, prior).prior <= tox.PRIOR_RANGE[1]
