"""Row numbers and vocabularies, on the small and on the large path."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blockloom.operators import patching as P
from blockloom.operators import rows as R
from blockloom.operators import steps as S
from blockloom.operators import vocab as V

PARTITIONS = (1, 4, 17)


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string")


def random_texts(n=60, words=40, seed=7):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(30)]
    # One word makes up a third of everything.
    return [
        " ".join("hot" if rng.random() < 0.34 else rng.choice(pool) for _ in range(rng.randrange(words)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("partitions", PARTITIONS)
@pytest.mark.parametrize("small", (0, 10_000))
def test_running_total(spark, partitions, small):
    rng = random.Random(partitions)
    # Group "a" holds most rows; one group is null.
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randrange(5)) for i in rng.sample(range(5000), 400)]
    df = spark.createDataFrame(data, "g string, k bigint, v bigint").repartition(partitions)
    out = R.running_total(df, by=["g"], order=["k"], value=F.col("v"), small_rows=small, part_rows=60).collect()
    assert len(out) == len(data)
    for g in ("a", "b", None):
        rows = sorted((r for r in out if r["g"] == g), key=lambda r: r["k"])
        seen = 0
        for r in rows:
            assert r["start"] == seen
            seen += r["v"]
        assert all(r["total"] == seen for r in rows)


@pytest.mark.parametrize("small", (0, 10_000))
def test_row_index_without_groups(spark, small):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "k bigint").repartition(5)
    out = R.with_row_index(df, order=["k"], small_rows=small, part_rows=20)
    assert sorted((r["k"], r["row_idx"], r["n_rows"]) for r in out.collect()) == [(i, i, 101) for i in range(101)]


def test_explode_pieces(spark):
    df = spark.createDataFrame([("s", 1, "a\nb\n"), ("s", 2, ""), ("s", 3, "\nc"), ("t", 4, "d")], "source string, k int, text string")
    plain = R.explode_pieces(df, key=["k"]).orderBy("source", "row_idx").collect()
    assert [(r["k"], r["piece_no"], r["text"], r["row_idx"], r["n_rows"]) for r in plain] == [
        (1, 0, "a", 0, 4), (1, 1, "b", 1, 4), (3, 0, "", 2, 4), (3, 1, "c", 3, 4), (4, 0, "d", 0, 1),
    ]
    kept = R.explode_pieces(df, key=["k"], keep_linebreaks=True).orderBy("source", "row_idx").collect()
    assert [(r["text"], r["row_idx"]) for r in kept] == [("a\n", 0), ("b\n", 1), ("\n", 2), ("c", 3), ("d", 0)]
    parts = R.explode_pieces(spark.createDataFrame([("s", 1, "a\n\n\n\nb\n")], df.schema), key=["k"], sample_by="paragraph")
    assert [r["text"] for r in parts.orderBy("row_idx").collect()] == ["a", "b\n"]
    with pytest.raises(ValueError):
        R.explode_pieces(df, key=["k"], sample_by="word")


def test_projection_and_alignment(spark):
    df = spark.createDataFrame([(1, "x")], "a bigint, text string")
    with pytest.raises(ValueError, match="b"):
        R.project_required(df, ["a", "b"])
    narrow = spark.createDataFrame([("y", 2)], "text string, a int")
    assert R.align_schema(df, narrow).schema == narrow.schema
    too_wide = spark.createDataFrame([(2**40, "x")], df.schema)
    with pytest.raises(Exception, match="OVERFLOW"):
        R.align_schema(too_wide, narrow).collect()
    numbered = R.with_row_index(df, order=["a"])
    assert R.limit_rows(numbered, 5).count() == 1 and R.row_at(numbered, 1).count() == 0


def test_vocab_order_and_cap(spark):
    df = texts(spark, ["b a a c", "c  </s>\n", "", None])
    full = V.build_vocab(df)
    want = [("<unk>", 0), ("<s>", 1), ("</s>", 2), ("<pad>", 3), ("a", 4), ("c", 5), ("b", 6)]
    assert [tuple(r) for r in full.table.orderBy("id").collect()] == want
    for cap in (3, 4, 5, 6, 7, 50):
        capped = V.build_vocab(df, max_vocab=cap)
        assert [tuple(r) for r in capped.table.orderBy("id").collect()] == want[: max(cap, 4)]
    assert full.rows() == 7 and capped.rows() == 50


def test_capped_ranking_equals_the_full_one(spark):
    df = texts(spark, random_texts(n=40) + [f"rare{i}" for i in range(40)])
    full = [tuple(r) for r in V.build_vocab(df).table.orderBy("id").collect()]
    for cap in (10, 30, 50):
        capped = V.build_vocab(df, max_vocab=cap)
        assert [tuple(r) for r in capped.table.orderBy("id").collect()] == full[:cap]


def test_count_at_a_place(spark):
    rng = random.Random(9)
    for ns in ([1] * 50, [10**12, 5, 5, 1], [rng.randrange(1, 10**6) for _ in range(300)], [7]):
        counts = spark.createDataFrame([(str(i), -n) for i, n in enumerate(ns)], "token string, minus_n bigint")
        ranked = sorted(ns, reverse=True)
        for place in {1, len(ns), len(ns) // 2 + 1, min(3, len(ns))}:
            assert V._count_at(counts, place) == ranked[place - 1]
        assert V._count_at(counts, len(ns) + 1) == 0


def exchanged(df):
    """What a plan exchanges: the columns of each exchange that is not a broadcast."""
    tree = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in tree.splitlines() if "Exchange" in line and "Broadcast" not in line]


@pytest.mark.parametrize("limit", (1_000_000, 1))
def test_equal_keys_gaps_and_unknown_ids_behave_alike(spark, limit):
    table = spark.createDataFrame([("<unk>", 0), ("a", 4), ("b", 17), ("rare", 900), ("rarer", 70_000)], "token string, id int")
    vocab = V.Vocabulary(table)
    df = spark.createDataFrame([(1, "a rare x", "p"), (1, "a rare x", "p"), (1, "b", "q"), (None, "rarer rarer", None), (2, None, "z")], "k int, text string, extra string")
    rows = V.encode(df, vocab, key=["k"], keep=["extra"], add_bos=False, broadcast_rows=limit).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(
        map(repr, [(1, "p", [4, 900, 0]), (1, "p", [4, 900, 0]), (1, "q", [17]), (None, None, [70_000, 70_000]), (2, "z", [])])
    )
    ids = spark.createDataFrame([(1, [900, -100, 5]), (1, [900, -100, 5]), (None, [70_000]), (3, None)], "k int, ids array<int>")
    named = V.decode(ids, vocab, ids="ids", key=["k"], broadcast_rows=limit).collect()
    assert sorted(map(repr, map(tuple, named))) == sorted(
        map(repr, [(1, ["rare", "igx", None]), (1, ["rare", "igx", None]), (None, ["rarer"]), (3, [])])
    )


def test_only_misses_are_exchanged(spark):
    df = texts(spark, random_texts(n=200)).repartition(3).withColumn("payload", F.lit("x" * 50))
    vocab = V.build_vocab(texts(spark, random_texts(n=200)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = V.encode(df, vocab, key=["doc_id"], keep=["payload"], broadcast_rows=5)
        out.collect()
        plan = exchanged(out)
        assert plan and not any("payload" in line or "_e0" in line for line in plan)
        # Rows of the stored table meet their patches by the buckets they lie in.
        assert sum("hashpartitioning(_part" in line for line in plan) == 1, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("partitions", PARTITIONS)
def test_encode_in_place_and_by_join_agree(spark, partitions):
    values = random_texts() + ["", None, "  \n ", " hot  w1\nnever </s> ", "héllo 你好"]
    df = texts(spark, values).withColumn("extra", F.col("doc_id") * 2).repartition(partitions)
    vocab = V.build_vocab(texts(spark, random_texts(seed=8)))
    ids = {r["token"]: r["id"] for r in vocab.table.collect()}
    for bos, eos in ((True, True), (True, False), (False, True), (False, False)):
        want = {
            i: [1] * bos + [ids.get(t, 0) for t in (v or "").replace("\n", " ").split(" ") if t] + [2] * eos
            for i, v in enumerate(values)
        }
        # Whole vocabulary in each task; joined; joined with a rare part.
        for limit in (1_000_000, 5):
            out = V.encode(df, vocab, key=["doc_id"], keep=["extra"], add_bos=bos, add_eos=eos, broadcast_rows=limit)
            assert out.schema["input_ids"].dataType.elementType.simpleString() == "int"
            rows = out.collect()
            assert {r["doc_id"]: r["input_ids"] for r in rows} == want
            assert all(r["extra"] == r["doc_id"] * 2 for r in rows)


@pytest.mark.parametrize("limit", (1_000_000, 5))
def test_decode(spark, limit):
    vocab = V.build_vocab(texts(spark, ["a b c d e f"]))
    df = spark.createDataFrame([(0, [1, 4, -100, 0, 9]), (1, []), (2, [9, 9])], "k int, ids array<int>")
    out = V.decode(df, vocab, ids="ids", key=["k"], broadcast_rows=limit)
    assert {r["k"]: r["tokens"] for r in out.collect()} == {0: ["<s>", "a", "igx", "<unk>", "f"], 1: [], 2: ["f", "f"]}
    shown = V.decode_text(df, vocab, ids="ids", key=["k"])
    assert {r["k"]: r["text"] for r in shown.collect()} == {0: "<s> a <unk> <unk> f", 1: "", 2: "f f"}


def test_overlong_and_block_size(spark):
    df = spark.createDataFrame([("a", [1, 2, 3]), ("a", [1]), ("b", [1])], "source string, input_ids array<int>")
    assert [tuple(r) for r in V.overlong(df, 2).collect()] == [("a", 1, 3)]
    assert V.resolve_block_size(None, 4096) == 1024
    assert V.resolve_block_size(None, 512) == 512
    assert V.resolve_block_size(2048, 512) == 512


def test_batches_are_cut_into_bounded_steps(spark, monkeypatch):
    """What a worker holds at a time follows neither the rows of a batch nor their lengths; results stay."""
    texts = pa.array(["a" * 6, None, "b" * 6, "", "c" * 30, "d"])
    cut = list(S.steps(10)(iter([texts, texts.slice(0, 0)])))
    assert [len(x) for x in cut] == [2, 2, 1, 1] and pa.concat_arrays(cut).equals(texts)
    lists = pa.array([[1, 2], None, [3], [], [4] * 9, [5]])
    pairs = list(S.steps(3)(iter([(lists, lists)])))
    assert [len(x) for x, _ in pairs] == [1, 3, 1, 1] and pa.concat_arrays([y for _, y in pairs]).equals(lists)

    df = spark.createDataFrame([(i, None if i % 7 == 0 else " ".join(f"w{j % 50}" for j in range(i))) for i in range(60)], "k int, text string").coalesce(1)
    results = []
    for step in (S.STEP, 64):
        monkeypatch.setattr(S, "STEP", step)
        vocab = V.build_vocab(df, max_vocab=40)
        ids = V.encode(df, vocab, key=["k"], add_eos=True, broadcast_rows=10)
        results.append((sorted(map(tuple, ids.collect())), sorted(map(tuple, V.decode(ids, vocab, ids="input_ids", key=["k"], broadcast_rows=10).collect()))))
    assert results[0] == results[1]


def test_a_partition_asks_for_a_missed_key_once(spark, monkeypatch):
    """Misses travel as numbers; a key is named once, or again where its number was forgotten."""
    begin = P.numbering(2)
    number = begin()
    seen = [number(keys) for keys in (["a", "b"], ["b", "c"], ["b"])]
    assert [(list(n), base, new) for n, base, new in seen] == [([0, 1], 0, ["a", "b"]), ([1, 2], 2, ["c"]), ([3], 3, ["b"])]
    assert list(begin()(["b"])[0]) == [0]

    monkeypatch.setattr(S, "STEP", 64)
    df = texts(spark, random_texts()).coalesce(1)
    shared = V.build_vocab(df).frequent(8).shared
    first = df.select(V._encoder(shared, True, False, True)("text").alias("e"))
    asked = [r[0] for r in first.select(F.explode("e.key")).collect()]
    missed = first.agg(F.sum(F.size("e.place"))).first()[0]
    assert len(asked) == len(set(asked)) < 30 and missed > 10 * len(asked)
    plan = V.encode(df, V.build_vocab(df), key=["doc_id"], broadcast_rows=8)
    assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, V.encode(df, V.build_vocab(df), key=["doc_id"]).collect()))
