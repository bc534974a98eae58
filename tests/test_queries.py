"""Every query against its SQL twin, and the entry point."""

import pytest

import __spark_entry__ as entry_point
from blockloom.queries import ORACLES, QUERIES, scans
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    """Those of the optional subpackage have tests of their own where SQL cannot say it."""
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", entry_point.oracle_sql())
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, entry_point.queries()[name], entry_point.oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    levels = {level: [r for r in rows if r["level"] == level] for level in ("name", "prefix", "all")}
    assert {r["prefix"] for r in levels["prefix"]} == {"train", "test"}
    assert levels["all"][0]["tokens"] == sum(r["tokens"] for r in levels["name"])


def test_whole_files_are_bounded(spark, monkeypatch):
    """A larger table makes more files, not larger rows."""
    read = []
    load = scans.S.load_source
    monkeypatch.setattr(scans.S, "load_source", lambda *a: read.append(load(*a)) or read[-1])
    monkeypatch.setattr(scans, "FILE_ROWS", 5)
    assert scans.scan_documents(spark, FOLDER).first().n_lines == 200
    assert read[0].count() >= 40 and read[0].selectExpr("max(length(text) - length(replace(text, '\\n', ''))) as n").first().n <= 5


@pytest.mark.parametrize("name, evaluations", [("top_logprobs", 3), ("text_offsets", 2), ("overlong_report", 1)])
def test_results_are_evaluated_once(spark, name, evaluations):
    """Not once more to see whether a row has positions."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython ") == evaluations
