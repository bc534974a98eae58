"""Exact sampling, mixing and splitting."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from blockloom.operators import sampling as M

PARTITIONS = (1, 4, 17)


def by_hash(keys, seed=1234):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def keyed(spark, n, partitions=4):
    return spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("text")).repartition(partitions)


@pytest.mark.parametrize("partitions", PARTITIONS)
@pytest.mark.parametrize("k", (0, 1, 37, 300, 999))
def test_exactly_k(spark, partitions, k):
    got = [r["k"] for r in M.exact_sample(keyed(spark, 300, partitions), key=["k"], k=k).collect()]
    assert sorted(got) == sorted(by_hash(range(300))[:k])


@pytest.mark.parametrize("partitions", PARTITIONS)
def test_share_per_group_with_a_hot_group(spark, partitions):
    df = keyed(spark, 500, partitions).withColumn("g", F.when(F.col("k") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("k") % 7)))
    groups = {}
    for r in df.collect():
        groups.setdefault(r["g"], []).append(r["k"])
    want = {k for ks in groups.values() for k in by_hash(ks)[: math.ceil(len(ks) * 0.3)]}
    got = [r["k"] for r in M.exact_sample(df, key=["k"], frac=0.3, by=["g"]).collect()]
    assert sorted(got) == sorted(want)
    assert sorted(r["k"] for r in M.exact_sample(df, key=["k"], k=10**6, by=["g"]).collect()) == list(range(500))


def test_very_many_groups_are_joined(spark, monkeypatch):
    df = keyed(spark, 60).withColumn("source", F.concat(F.lit("s"), F.col("k") % 3))
    few = sorted(tuple(r) for r in M.exact_sample(df, key=["k"], frac=0.4, by=["source"]).collect())
    mixed = sorted(tuple(r) for r in M.mix(df, {"s0": 0.5, "s1": 2}, key=["k"], default=0.25).collect())
    monkeypatch.setattr(M, "FEW_GROUPS", 0)
    assert sorted(tuple(r) for r in M.exact_sample(df, key=["k"], frac=0.4, by=["source"]).collect()) == few
    assert sorted(tuple(r) for r in M.mix(df, {"s0": 0.5, "s1": 2}, key=["k"], default=0.25).collect()) == mixed


def test_a_null_group_is_a_group(spark):
    df = keyed(spark, 40).withColumn("g", F.when(F.col("k") % 2 == 0, "even"))
    got = [r["k"] for r in M.exact_sample(df, key=["k"], k=5, by=["g"]).collect()]
    assert sorted(got) == sorted(by_hash(range(0, 40, 2))[:5] + by_hash(range(1, 40, 2))[:5])
    mixed = M.mix(df.withColumnRenamed("g", "source"), {"even": 2}, key=["k"], default=0.5)
    assert mixed.where("source IS NULL").count() == 10 and mixed.where("source = 'even'").count() == 40


def test_rejects_unclear_requests(spark):
    for options in ({}, {"k": 1, "frac": 0.5}):
        with pytest.raises(ValueError):
            M.exact_sample(keyed(spark, 5), key=["k"], **options)


def test_shuffle_is_a_permutation(spark):
    out = M.shuffle(keyed(spark, 50), key=["k"]).orderBy("row_idx").collect()
    assert [r["k"] for r in out] == by_hash(range(50))
    assert [r["row_idx"] for r in out] == list(range(50))


@pytest.mark.parametrize("weight", (0, 1.5, -1, 2.5))
def test_bad_weights(weight):
    with pytest.raises(ValueError):
        M.check_weight(weight)


@pytest.mark.parametrize("partitions", PARTITIONS)
def test_mix(spark, partitions):
    df = keyed(spark, 400, partitions).withColumn("source", F.concat(F.lit("s"), F.col("k") % 4))
    weights = {"s0": 0.05, "s1": 0.999, "s2": 1, "s3": 3}
    rows = [(r["source"], r["k"], r["copy_no"]) for r in M.mix(df, weights, key=["k"]).collect()]
    counts = {s: sum(1 for r in rows if r[0] == s) for s in weights}
    assert counts == {"s0": 5, "s1": 100, "s2": 100, "s3": 300}
    assert len(set(rows)) == len(rows)
    assert {r[1] for r in rows if r[0] == "s0"} == set(by_hash(range(0, 400, 4))[:5])
    # A source without a weight is left out, or gets the default.
    assert {r["source"] for r in M.mix(df, {"s0": 2}, key=["k"], leave_out=True).collect()} == {"s0"}
    with pytest.raises(Exception, match="no weight for source"):
        M.mix(df, {"s0": 2}, key=["k"]).collect()
    assert M.mix(df, {"s0": 2}, key=["k"], default=1).count() == 500
    one = keyed(spark, 1).withColumn("source", F.lit("x"))
    assert M.mix(one, {"x": 0.5}, key=["k"]).count() == 1


def test_upsample_and_concat(spark):
    df = keyed(spark, 3)
    assert sorted((r["k"], r["copy_no"]) for r in M.upsample(df, 2).collect()) == [(k, c) for k in range(3) for c in (1, 2)]
    with pytest.raises(ValueError):
        M.upsample(df, 0)
    other = df.select("text", F.col("k").cast("int").alias("k"))
    both = M.concat_sources({"a": df, "b": other})
    assert both.count() == 6 and dict(both.dtypes)["k"] == "bigint"


@pytest.mark.parametrize("partitions", PARTITIONS)
@pytest.mark.parametrize("test, n_test", ((0.05, 11), (0.002, 1), (100, 100), (None, 0)))
def test_split(spark, partitions, test, n_test):
    out = M.split(keyed(spark, 211, partitions), test=test, key=["k"]).collect()
    assert sorted(r["k"] for r in out) == list(range(211))
    assert {r["k"] for r in out if r["split"] == "test"} == set(by_hash(range(211))[:n_test])


@pytest.mark.parametrize("test", (0, 10, 11, 0.0, 1.0, 1.5))
def test_split_must_leave_both_sides(spark, test):
    for function in (M.split, M.split_and_shuffle):
        with pytest.raises(ValueError):
            function(keyed(spark, 10), test=test, key=["k"])


@pytest.mark.parametrize("partitions", PARTITIONS)
@pytest.mark.parametrize("test, n_test", ((0.05, 11), (100, 100), (None, 0)))
def test_split_and_shuffle(spark, partitions, test, n_test):
    out = M.split_and_shuffle(keyed(spark, 211, partitions), test=test, key=["k"], part_rows=10)
    ranked = by_hash(range(211))
    want = [("test", i, k) for i, k in enumerate(ranked[:n_test])] + [("train", i, k) for i, k in enumerate(ranked[n_test:])]
    assert sorted((r["split"], r["place"], r["k"]) for r in out.collect()) == want
    # Rows lie in rank order across partitions.
    assert [r["k"] for r in out.collect()] == ranked
    assert {r["text"] for r in out.collect()} == {r["text"] for r in keyed(spark, 211).collect()}


def test_split_and_shuffle_exchanges_rows_once(spark, tmp_path):
    sources = keyed(spark, 300, 4).withColumn("source", F.concat(F.lit("s"), F.col("k") % 3)).withColumn("payload", F.repeat(F.lit("x"), 40))
    mixed = M.mix(sources, {"s0": 0.5, "s1": 1, "s2": 2}, key=["k"])
    placed = M.split_and_shuffle(mixed, test=0.1, key=["source", "k", "copy_no"])
    placed.collect()
    plan = placed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert len([line for line in moved if "_part" in line]) == 1
    # What else is exchanged belongs to the cuts of the mix, which never hold the payload.
    for line in plan.splitlines():
        assert not ("Exchange" in line and "Broadcast" not in line and "_part" not in line and "payload" in line)
    from blockloom.sources import load_corpus, write_corpus

    write_corpus(placed.withColumnRenamed("place", "row_idx"), str(tmp_path / "c"), placed=True)
    write_corpus(placed.withColumnRenamed("place", "row_idx"), str(tmp_path / "d"))
    want = {(r["split"], r["place"], r["k"], r["copy_no"]) for r in placed.collect()}
    for folder in ("c", "d"):
        for split in ("train", "test"):
            files = sorted((tmp_path / folder / split).glob("*.parquet"))
            read = [r["row_idx"] for f in files for r in spark.read.parquet(str(f)).collect()]
            assert read == list(range(len(read)))  # files in order, and rows in them
            rows = load_corpus(spark, str(tmp_path / folder), split).collect()
            assert {(split, r["row_idx"], r["k"], r["copy_no"]) for r in rows} == {w for w in want if w[0] == split}
        assert sorted(p.name for p in (tmp_path / folder).iterdir()) == ["test", "train"]


def test_copies_can_leak(spark):
    copies = M.upsample(keyed(spark, 30), 4)
    parted = M.split(copies, test=0.5, key=["k", "copy_no"])
    rows = parted.collect()
    sides = {k: {r["split"] for r in rows if r["k"] == k} for k in range(30)}
    assert M.leaked_copies(parted, key=["k"]).first()[0] == sum(len(s) > 1 for s in sides.values()) > 0
