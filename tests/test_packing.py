"""Packing against the plain rule."""

import random

import pytest
from pyspark.sql import functions as F

from blockloom.operators import packing as P


def plain_blocks(docs, size, keep_tail=False):
    flat = [t for d in docs for t in d]
    end = len(flat) // size * size if len(flat) >= size else len(flat)
    blocks = [flat[i : i + size] for i in range(0, end, size)]
    if keep_tail and len(flat) % size:
        blocks.append(flat[-size:])
    return blocks


def rows_of(spark, scopes, partitions=3):
    data, token = [], 0
    for scope, lengths in scopes.items():
        for i, n in enumerate(lengths):
            data.append((scope, i, list(range(token, token + n))))
            token += n
    return spark.createDataFrame(data, "source string, row_idx bigint, input_ids array<int>").repartition(partitions), data


def check(spark, scopes, size, *, keep_tail=False, scope_rows=1000, partitions=3):
    df, data = rows_of(spark, scopes, partitions)
    out = P.pack_blocks(df, block_size=size, scope=["source"], keep_tail=keep_tail, scope_rows=scope_rows)
    assert out.schema["input_ids"].dataType.elementType.simpleString() == "int"
    got = {}
    for r in out.orderBy("source", "block").collect():
        got.setdefault(r["source"], []).append(r["input_ids"])
    for scope in scopes:
        docs = [ids for s, _, ids in data if s == scope]
        assert got.get(scope, []) == plain_blocks(docs, size, keep_tail), scope
    return got


def test_goldens(spark):
    scopes = {"drop": [3, 3, 3], "short": [2], "none": [0], "exact": [4], "long": [1, 11, 1], "gap": [2, 0, 2]}
    got = check(spark, scopes, 4)
    assert [len(b) for b in got["drop"]] == [4, 4]
    assert [len(b) for b in got["short"]] == [2]
    assert "none" not in got


@pytest.mark.parametrize("keep_tail", (False, True))
@pytest.mark.parametrize("scope_rows", (1000, None))
@pytest.mark.parametrize("partitions", (1, 17))
def test_random(spark, keep_tail, scope_rows, partitions):
    rng = random.Random(partitions)
    scopes = {f"s{i}": [rng.choice([0, 1, 2, 7, 30]) for _ in range(rng.randrange(1, 25))] for i in range(12)}
    check(spark, scopes, 8, keep_tail=keep_tail, scope_rows=scope_rows, partitions=partitions)


def test_large_path_is_the_same(spark, monkeypatch):
    from blockloom.operators import rows

    monkeypatch.setattr(rows.running_total, "__kwdefaults__", rows.running_total.__kwdefaults__ | {"small_rows": 0, "part_rows": 7})
    check(spark, {"hot": [3] * 40, "cold": [5, 1]}, 8, scope_rows=None)


@pytest.mark.parametrize("n, workers, batch", ((5, 2, 2), (3, 32, 1000), (1000, 32, 10), (64, 32, 1), (1, 1, 1)))
def test_scopes(spark, n, workers, batch):
    df = spark.range(n).select(F.col("id").alias("row_idx"), F.lit(n).cast("bigint").alias("n_rows"))
    got = [(r["shard"], r["batch"]) for r in P.with_scope(df, workers=workers, batch_rows=batch).orderBy("row_idx").collect()]
    used = min(workers, n)
    want = []
    for shard in range(used):
        size = n // used + (shard < n % used)
        want += [(shard, i // batch) for i in range(size)]
    assert got == want


def test_loss_and_labels(spark):
    df, _ = rows_of(spark, {"a": [3, 3, 3], "b": [0]})
    blocks = P.pack_blocks(df, block_size=4, scope=["source"], scope_rows=10)
    loss = {r["source"]: tuple(r)[1:] for r in P.pack_loss(df, blocks).collect()}
    assert loss == {"a": (9, 2, 8, 1), "b": (0, 0, 0, 0)}
    assert all(r["labels"] == r["input_ids"] for r in P.copy_labels(blocks).collect())
