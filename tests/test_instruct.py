"""Templates and truncation against the plain rule."""

import random

import pytest

from blockloom.operators import instruct as I
from blockloom.operators.vocab import build_vocab


def plain_cut(s, t, max_len, max_target, p, q, mode="head_tail", cap=500):
    if len(s) + len(t) <= max_len:
        return s, t
    t = t[:max_target]
    room = max_len - len(t)
    if len(s) > room:
        m = room - p - q
        if mode == "keep_head":
            s = s[: p + m] + s[-q:]
        elif mode == "keep_tail":
            s = s[:p] + s[-q - m :]
        else:
            front = min(m // 2, cap)
            back = min(m - front, cap)
            s = s[: p + front + max(0, m - front - back)] + s[-q - back :]
    return s, t


def cut(spark, pairs, **options):
    data = [(i, list(range(s)), list(range(10_000, 10_000 + t))) for i, (s, t) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k int, source_ids array<int>, target_ids array<int>")
    out = {r["k"]: r for r in I.truncate(df, **options).collect()}
    return [(data[i][1], data[i][2], out[i]) for i in range(len(pairs))]


@pytest.mark.parametrize("room", (0, 1, 2, 999, 1000, 1001, 1500))
def test_room_for_the_instruction(spark, room):
    p, q, target = 10, 1, 20
    max_len = p + q + room + target
    for s, t, row in cut(spark, [(3000, 20), (3000, 500), (5, 5), (max_len, 0)], max_len=max_len, max_target=target, p=p, q=q):
        want = plain_cut(s, t, max_len, target, p, q)
        assert (row["source_ids"], row["target_ids"]) == want
        assert len(row["source_ids"]) + len(row["target_ids"]) <= max_len
        if row["truncated"] and len(s) > max_len - len(row["target_ids"]):
            assert row["source_ids"][:p] == s[:p] and row["source_ids"][-q:] == s[-q:]


@pytest.mark.parametrize("mode", ("head_tail", "keep_head", "keep_tail"))
def test_random(spark, mode):
    rng = random.Random(3)
    pairs = [(rng.randrange(1, 200), rng.randrange(1, 120)) for _ in range(300)]
    options = {"max_len": 100, "max_target": 40, "p": 6, "q": 2, "mode": mode, "cap": 5}
    for s, t, row in cut(spark, pairs, **options):
        assert (row["source_ids"], row["target_ids"]) == plain_cut(s, t, **options)
        assert (row["source_len"], row["target_len"]) == (len(s), len(t))


def test_a_short_source_still_loses_target(spark):
    [(s, t, row)] = cut(spark, [(5, 90)], max_len=60, max_target=20, p=2, q=1)
    assert row["source_ids"] == s and row["target_ids"] == t[:20]


def test_unusable_limits_raise(spark):
    with pytest.raises(Exception, match="no room"):
        cut(spark, [(50, 5)], max_len=10, max_target=5, p=20, q=1)
    with pytest.raises(ValueError):
        cut(spark, [(5, 5)], max_len=10, max_target=5, p=2, q=1, mode="other")


def test_templates(spark):
    rows = [(0, "do {this} 100%", None, "ok"), (1, "a", "", "b"), (2, "a", "x", None)]
    df = spark.createDataFrame(rows, "k int, instruction string, input string, output string")
    out = {r["k"]: r for r in I.render(df, system="S").collect()}
    assert out[0]["prompt"] == "[INST] <<SYS>>\nS\n<</SYS>>\n\ndo {this} 100% [/INST]"
    assert out[1]["prompt"].endswith("\n\na [/INST]")
    assert out[2]["prompt"].endswith("\n\na\nx [/INST]")
    assert [out[k]["target"] for k in range(3)] == ["ok</s>", "b</s>", "None</s>"]


def test_examples_end_to_end(spark):
    rows = [(0, "say hello", None, "hello there"), (1, "go", "on", None)]
    df = spark.createDataFrame(rows, "k int, instruction string, input string, output string")
    vocab = build_vocab(df.selectExpr("concat_ws(' ', instruction, input, output, 'None') AS text"))
    p, q = I.prompt_overhead(spark)
    assert (p, q) == (10, 1)
    out = {r["k"]: r for r in I.instruction_examples(df, vocab, key=["k"]).collect()}
    ids = {r["token"]: r["id"] for r in vocab.table.collect()}
    assert out[0]["labels"][-3:] == [ids["hello"], ids["there"], 2]
    assert out[1]["labels"][-2:] == [ids["None"], 2]
    for r in out.values():
        assert len(r["labels"]) == len(r["input_ids"])
        assert r["input_ids"][0] == 1 and r["labels"][0] == -100
    dropped = I.encode_pairs(df, vocab, key=["k"], drop_missing_output=True)
    assert dropped.count() == 1


def test_examples_take_one_worker_a_task(spark):
    """Prompt and answer are encoded by one evaluation in Python; once each had its own,
    with its own worker. With a cut vocabulary the misses of each are patched as before."""
    vocab = build_vocab(spark.createDataFrame([("aa aa b c",)], "text string"))
    df = spark.createDataFrame([(1, "aa c", "b", "c zz aa"), (2, "b", None, None)], "k int, instruction string, input string, output string")
    made = I.instruction_examples(df, vocab, key=["k"])
    assert made._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    whole = {r.k: (r.source_ids, r.target_ids) for r in I.encode_pairs(df, vocab, key=["k"]).collect()}
    assert whole[1][1] == [6, 0, 4, 2] and whole[2][1] == [0, 2]
    assert {r.k: (r.source_ids, r.target_ids) for r in I.encode_pairs(df, vocab, key=["k"], broadcast_rows=5).collect()} == whole
