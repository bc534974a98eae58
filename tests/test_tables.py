"""Collation, statistics, metrics, requests, results and vectors."""

import json
import math

import pytest
from pyspark.sql import functions as F

from blockloom.functions import arrays as A
from blockloom.functions import text as T
from blockloom.operators import collate as C
from blockloom.operators import metrics as E
from blockloom.operators import requests as Q
from blockloom.operators import results as U
from blockloom.operators import stats as S
from blockloom.operators import vectors as X
from blockloom.operators.vocab import build_vocab

ROWS = "row_idx bigint, input_ids array<int>, labels array<int>"


def test_padding_and_mask(spark):
    df = spark.createDataFrame([(0, [1, 3, 5], [1, 3, 5]), (1, [7], [-100]), (2, [9], [9])], ROWS)
    out = {r["row_idx"]: r for r in C.pad_batches(df, batch_size=2).collect()}
    assert out[1]["input_ids"] == [7, 3, 3] and out[1]["labels"] == [-100, -100, -100]
    # A pad id inside the text is masked as well.
    assert out[0]["attention_mask"] == [True, False, True]
    assert out[1]["attention_mask"] == [True, False, False]
    # The last batch is smaller and padded on its own.
    assert out[2]["batch_id"] == 1 and out[2]["input_ids"] == [9]


def test_ragged_batches_become_their_first_row(spark):
    df = spark.createDataFrame([(0, [1, 2], [0]), (1, [3], [0]), (2, [4], [0]), (3, [5], [0])], ROWS).repartition(4)
    out = {r["row_idx"]: r["input_ids"] for r in C.collate_first_on_ragged(df, batch_size=2).collect()}
    assert out == {0: [1, 2], 1: [1, 2], 2: [4], 3: [5]}


def test_labels_by_value(spark):
    rows = [(0, "null", 9.0), (1, "2", 9.0), (2, "2.9", None), (3, "-2.9", None), (4, "0.1", 9.0), (5, "3", 9.0), (6, '"x"', None), (7, "true", None), (8, None, 1.5), (9, "null", None)]
    rows += [(12, "true", None), (13, "[1]", None), (14, "1e2", None), (16, None, None)]
    df = spark.createDataFrame(rows, "row_idx int, j string, label_ids double").selectExpr("row_idx", "parse_json(j) AS label", "label_ids", "j AS note")
    out = C.labels_by_value(df, batch_size=4)
    assert out.columns == ["row_idx", "batch_id", "labels", "labels_kind"]
    got = {r.row_idx: (r.labels, r.labels_kind) for r in out.collect()}
    single = 0.10000000149011612
    assert got == {
        1: (2.0, "bigint"), 2: (2.0, "bigint"), 3: (-2.0, "bigint"), 4: (single, "float"), 5: (3.0, "float"), 7: (1.0, "float"),
        8: (1.5, "float"), 12: (1.0, "bigint"), 14: (100.0, "bigint"),
    }
    assert C.labels_by_value(df.limit(0), batch_size=4).collect() == []
    typed = spark.createDataFrame([(0, None), (1, 7)], "row_idx int, label int")
    assert [(r.labels, r.labels_kind) for r in C.labels_by_value(typed, batch_size=4).collect()] == [(7.0, "bigint")]
    assert C.labels_by_value(typed.drop("label"), batch_size=4).collect() == []


def test_label_field(spark):
    whole = spark.createDataFrame([(1, 2, "note")], "x int, label int, s string")
    assert C.label_field(whole).dtypes == [("x", "int"), ("labels", "bigint")]
    real = spark.createDataFrame([(1, 2.5)], "x int, label double")
    assert C.label_field(real).dtypes == [("x", "int"), ("labels", "float")]
    ids = spark.createDataFrame([(1, [2])], "x int, label_ids array<int>")
    assert C.label_field(ids).dtypes == [("x", "int"), ("labels", "array<bigint>")]


def test_decoder_inputs(spark):
    df = spark.createDataFrame([(0, [1], [-100, 5, 6])], ROWS)
    assert C.shift_right(df, start=1, pad=3).first()["decoder_input_ids"] == [1, 3, 5]
    with pytest.raises(ValueError):
        C.shift_right(df, start=1, pad=None)
    longer = C.prepend_ignored(df.withColumn("attention_mask", F.array(F.lit(True))), v=2).first()
    assert longer["labels"] == [-100, -100, -100, 5, 6] and longer["attention_mask"] == [True] * 3


def test_stats(spark):
    df = spark.createDataFrame(
        [("a_x", 0, [1, 2]), ("a_x", 1, [1]), ("a_y", 0, [1]), ("b", 0, [])], "source string, row_idx bigint, input_ids array<int>"
    )
    exact = {r["name"]: (r["rows"], r["tokens"]) for r in S.corpus_stats(df).collect()}
    assert exact == {"a_x": (2, 3), "a_y": (1, 1), "b": (1, 0)}
    guess = {r["name"]: r["tokens"] for r in S.corpus_stats(df, mode="estimate").collect()}
    assert guess == {"a_x": 4, "a_y": 1, "b": 0}
    rolled = {r["prefix"]: r["tokens"] for r in S.prefix_rollup(S.corpus_stats(df)).collect()}
    assert rolled == {"a": 4, "b": 0}
    totals = S.stats_totals(S.corpus_stats(df)).where("level = 'all'").first()
    assert (totals["rows"], totals["tokens"]) == (4, 4)
    big = spark.createDataFrame([("n", 1234567, 2500000)], "name string, rows bigint, tokens bigint")
    assert tuple(S.sorted_report(big).first()) == ("n", "1,234,567", 2.5)


def test_metrics(spark):
    df = spark.createDataFrame([([5, 6, 0], [1, 5, 6]), ([9, -100, 1], [0, 9, -100]), ([], [])], "preds array<int>, labels array<int>")
    got = E.token_accuracy(df).first()
    # Ignored labels count; the last prediction does not.
    assert (got["n_correct"], got["n_tokens"], got["accuracy"]) == (4, 4, 1.0)
    logits = spark.createDataFrame([([0.1, 0.7, 0.7],)], "logits array<double>")
    assert E.argmax_ids(logits).first()["pred"] == 1
    losses = spark.createDataFrame([(1000.0,), (1000.0,)], "loss double")
    assert math.isinf(E.perplexity(losses).first()["perplexity"])
    pairs = spark.createDataFrame([(1, 1, 3.0), (1, 0, 1.0)], "pred int, label int, w double")
    assert E.accuracy(pairs).first()[0] == 0.5
    assert E.accuracy(pairs, weight="w").first()[0] == 0.75
    assert E.accuracy(pairs, normalize=False).first()[0] == 1.0


CHAT = "conv_id int, turn int, role string, text string"


def test_chat_prompts(spark):
    rows = [
        (0, 0, "user", "q1"), (0, 1, "system", "old"), (0, 2, "assistant", "a1"), (0, 3, "system", "new"), (0, 4, "user", "q2"),
        (1, 0, "assistant", "hi"), (2, 0, None, "plain % text"), (3, 0, "system", "only"),
    ]
    out = {r["conv_id"]: r["prompt"] for r in Q.chat_prompts(spark.createDataFrame(rows, CHAT), system="D").collect()}
    assert out[0] == "[INST] <<SYS>>\nnew\n<</SYS>>\n\nq1 [/INST] a1 </s>[INST] q2 [/INST]"
    assert out[1] == "[INST] <<SYS>>\nD\n<</SYS>>\n\n[/INST] hi </s>"
    assert out[2] == "plain % text"
    assert out[3] == "[INST] <<SYS>>\nonly\n<</SYS>>\n\n[/INST]"
    with pytest.raises(Exception, match="Unknown role: bot"):
        Q.chat_prompts(spark.createDataFrame([(0, 0, "bot", "x")], CHAT)).collect()


def test_request_rules_in_order(spark):
    schema = (
        "id int, endpoint string, model string, logit_bias string, echo boolean, suffix string, prompts array<string>, "
        "n_prompt bigint, max_tokens bigint"
    )
    rows = [
        (0, "chat", "m", None, False, None, None, 5, 5),
        (1, "chat", "x", "{}", False, None, None, 500, 5),
        (2, "chat", "m", "{}", False, None, None, 500, 5),
        (3, "chat", "m", None, True, "s", None, 500, 5),
        (4, "completion", "m", "{}", True, "s", [], 500, 5),
        (5, "completion", "m", "{}", False, "s", [], 500, 5),
        (6, "completion", "m", None, False, None, [], 500, 5),
        (7, "completion", "m", None, False, None, ["a", "b"], 500, 5),
        (8, "completion", "m", None, None, None, ["a"], 500, 5),
        (9, "completion", "x", None, True, None, ["a"], 5, 5),
    ]
    out = {r["id"]: r for r in Q.request_status(spark.createDataFrame(rows, schema), served="m", limit=100).collect()}
    assert [out[i]["status"] for i in range(10)] == [200, 404, 400, 400, 400, 400, 400, 400, 200, 404]
    words = ["model", "logit_bias", "maximum context", "echo", "suffix", "at least one", "multiple"]
    assert all(w in out[i]["message"] for w, i in zip(words, range(1, 8)))


RESULTS = "request_id string, idx int, token_ids array<int>, logprobs array<map<int,double>>"


def test_results(spark):
    vocab = build_vocab(spark.createDataFrame([("aa aa b",)], "text string"))  # aa=4, b=5
    df = spark.createDataFrame([("r", 0, [4, 5, 4], [{4: -1.0, 5: -2.0}, {5: -0.5}, {4: 0.0}])], RESULTS)
    positions = U.explode_positions(df)
    for limit in (1000, 2):
        placed = U.text_offsets(df, vocab, initial=7, broadcast_rows=limit).first()
        assert (placed["tokens"], placed["text_offset"]) == (["aa", "b", "aa"], [7, 9, 10])
        top = U.top_logprobs(df, vocab, broadcast_rows=limit).first()["top_logprobs"]
        assert top == [{"aa": -1.0, "b": -2.0}, {"b": -0.5}, {"aa": 0.0}]
    assert U.top_logprobs(df, vocab, k=1).first()["top_logprobs"][0] == {"aa": -1.0}
    assert [r["token_logprob"] for r in U.token_logprob(positions).orderBy("pos").collect()] == [-1.0, -0.5, 0.0]
    bad = spark.createDataFrame([("r", 0, [4], [{5: -1.0}])], RESULTS)
    with pytest.raises(Exception, match="no log-probability for token 4"):
        U.token_logprob(U.explode_positions(bad)).collect()
    probs = {r["candidate"]: r["prob"] for r in U.next_token_prob(positions, [4, 9]).collect()}
    assert probs == {4: pytest.approx(math.exp(-1)), 9: None}


@pytest.mark.parametrize("limit", (1000, 2))
def test_logprobs_record(spark, limit):
    vocab = build_vocab(spark.createDataFrame([("aa aa b",)], "text string"))
    rows = [
        ("r", 0, [4, 5, 4], [{4: -1.0, 5: -2.0}, {5: -0.5}, {4: 0.0}]),
        ("r", 1, [], []),
        ("r", 2, [4], None),  # none asked for
        ("r", 3, [5, 4], [{5: -1.0, 4: -1.0}]),  # as many as the shorter has
        ("r", 3, None, [{5: -1.0}]),
        (None, 4, [4, 4], [{4: -3.0}, {4: -4.0, 0: -9.0}]),
    ]
    df = spark.createDataFrame(rows, RESULTS).withColumns({"text": F.lit("t"), "prompt": F.lit("p"), "finish_reason": F.lit("stop")})
    record = U.logprobs_record(df, vocab, broadcast_rows=limit)
    got = {(r["request_id"], r["idx"], r["text"], len(r["token_ids"] or [])): r["logprobs"] and tuple(r["logprobs"]) for r in record.collect()}
    assert got["r", 0, "t", 3] == ([0, 2, 3], [-1.0, -0.5, 0.0], ["aa", "b", "aa"], [{"aa": -1.0, "b": -2.0}, {"b": -0.5}, {"aa": 0.0}])
    assert got["r", 1, "t", 0] == got["r", 3, "t", 0] == ([], [], [], [])
    assert got["r", 2, "t", 1] is None
    assert got["r", 3, "t", 2] == ([0], [-1.0], ["b"], [{"aa": -1.0, "b": -1.0}])
    assert got[None, 4, "t", 2] == ([0, 2], [-3.0, -4.0], ["aa", "aa"], [{"aa": -3.0}, {"aa": -4.0, "<unk>": -9.0}])
    made = U.assemble_outputs(record.where("request_id = 'r' and idx in (0, 2)")).first()
    assert json.loads(made["logprobs"][0])["text_offset"] == [0, 2, 3] and made["logprobs"][1] is None
    bad = spark.createDataFrame([("r", 0, [4], [{5: -1.0}])], RESULTS)
    with pytest.raises(Exception, match="no log-probability for token 4"):
        U.logprobs_record(bad, vocab, broadcast_rows=limit).collect()
    assert U.logprobs_record(df.limit(0), vocab, broadcast_rows=limit).collect() == []


def test_results_exchange_no_token_rows(spark):
    vocab = build_vocab(spark.createDataFrame([("aa aa b",)], "text string"))
    df = spark.createDataFrame([("r", 0, [4, 5, 4], [{4: -1.0, 5: -2.0}, {5: -0.5}, {4: 0.0}])], RESULTS)
    plan = U.logprobs_record(df, vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and "Window" not in plan


def test_results_take_one_worker_a_task(spark):
    """Names, offsets and alternatives come from one evaluation in Python: the parts that
    once were an evaluation each had a worker each, held at the same time."""
    vocab = build_vocab(spark.createDataFrame([("aa aa b",)], "text string"))
    df = spark.createDataFrame([("r", 0, [4, 5, 4], [{4: -1.0, 5: -2.0}, {5: -0.5}, {4: 0.0}])], RESULTS)
    made = {"record": U.logprobs_record(df, vocab), "offsets": U.text_offsets(df, vocab), "top": U.top_logprobs(df, vocab, k=1)}
    plans = {name: out._jdf.queryExecution().optimizedPlan().toString() for name, out in made.items()}
    assert {name: plan.count("ArrowEvalPython") for name, plan in plans.items()} == {"record": 1, "offsets": 1, "top": 1}
    assert made["offsets"].first()["text_offset"] == [0, 2, 3] and made["top"].first()["top_logprobs"] == [{"aa": -1.0}, {"b": -0.5}, {"aa": 0.0}]


def test_snapshots(spark):
    rows = [("r", 0, 0, "He", [1]), ("r", 0, 1, "Hello", [1, 2]), ("r", 0, 2, "Hello", [1, 2])]
    df = spark.createDataFrame(rows, "request_id string, idx int, step int, text string, token_ids array<int>")
    out = U.snapshot_delta(df).orderBy("step").collect()
    assert [(r["delta_text"], r["delta_ids"], r["text_offset"]) for r in out] == [("He", [1], 0), ("llo", [2], 2), ("", [], 5)]


def test_outputs_and_usage(spark):
    rows = [("r", "P", 1, "b", "stop", [1, 2], [9, 9]), ("r", "P", 0, "a", "length", [1], [9, 9])]
    schema = "request_id string, prompt string, idx int, text string, finish_reason string, token_ids array<int>, prompt_ids array<int>"
    df = spark.createDataFrame(rows, schema)
    out = U.assemble_outputs(df).first()
    assert (out["text"], out["index"], out["finish_reason"], out["logprobs"]) == (["Pa", "Pb"], [0, 1], ["length", "stop"], [None, None])
    assert U.assemble_outputs(df, only_output=True).first()["text"] == ["a", "b"]
    assert tuple(U.usage_totals(df).first()) == ("r", 2, 3, 5)


VECTORS = "key string, v array<float>"


def test_vector_arith(spark):
    a = spark.createDataFrame([("x", [1.0, 2.0]), ("only", [5.0]), ("pad", [1.0]), ("cut", [1.0, 2.0])], VECTORS)
    b = spark.createDataFrame([("x", [0.5, 1.0]), ("gone", [1.0]), ("pad", [1.0, 3.0]), ("cut", [1.0])], VECTORS)
    out = {r["key"]: r["v"] for r in X.vector_arith(a, b, op="-", pad_keys=["pad", "cut"]).collect()}
    assert out == {"x": [0.5, 1.0], "only": [5.0], "pad": [0.0, -3.0], "cut": [0.0, 2.0]}
    with pytest.raises(Exception, match="differ in size"):
        X.vector_arith(a, b, op="+").collect()
    with pytest.raises(NotImplementedError):
        X.vector_arith(a, b, op="*")
    wide = X.vector_arith(
        a.where("key = 'pad'").withColumn("w", F.lit(1)), b.withColumn("w", F.lit(2)), op="+", pad_keys=["pad"], width="w"
    )
    assert wide.first()["v"] == [1.0]


@pytest.mark.parametrize("limit", (10**6, 0))
@pytest.mark.parametrize("transpose", (False, True))
def test_low_rank_update(spark, limit, transpose):
    w = [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]
    # (2 x 3) = (2 x r) @ (r x 3), or the transpose of (3 x r) @ (r x 2).
    a = [[1.0, 0.0, 2.0], [0.0, 1.0, 1.0]] if not transpose else [[1.0, 2.0], [3.0, 4.0]]
    b = [[1.0, 2.0], [3.0, 4.0]] if not transpose else [[1.0, 0.0], [0.0, 1.0], [2.0, 1.0]]
    product = [[sum(b[i][k] * a[k][j] for k in range(2)) for j in range(len(a[0]))] for i in range(len(b))]
    if transpose:
        product = [list(c) for c in zip(*product)]
    rows = "key string, {} int, v array<float>"
    frame = lambda m, name, key="k": spark.createDataFrame([(key, i, r) for i, r in enumerate(m)], rows.format(name))
    weights = frame(w, "i").unionByName(frame(w, "i", "free"))
    updated = X.low_rank_update(weights, frame(a, "k"), frame(b, "i"), scale=0.5, transpose=transpose, broadcast_elements=limit)
    out = {(r["key"], r["i"]): r["v"] for r in updated.collect()}
    for i in range(2):
        assert out[("k", i)] == [w[i][j] + 0.5 * product[i][j] for j in range(3)]
        assert out[("free", i)] == w[i]


def test_replacement_is_half_precision(spark):
    import numpy as np

    values = [0.1, -3.14159, 65504.0, 70000.0, 1e-8, 6e-8, 1e-5, 0.0, 2049.0, 1 / 3]
    got = spark.createDataFrame([(values,)], "v array<float>").select(A.to_half(F.col("v"))).first()[0]
    with np.errstate(over="ignore"):
        assert got == [float(np.float16(np.float32(v))) for v in values]


def test_last_table_wins(spark):
    t = [spark.createDataFrame([("a", [float(n)]), (f"k{n}", [0.0])], VECTORS) for n in range(3)]
    merged = X.keyed_last_wins(t)
    assert {r["key"]: r["v"] for r in merged.collect()} == {"a": [2.0], "k0": [0.0], "k1": [0.0], "k2": [0.0]}
    assert tuple(X.size_total(merged).first()) == (4, 16)


def test_text_functions(spark):
    df = spark.createDataFrame([("a+b%20c%zz%", "/x/y/name.v1.json", "NATION_1_x")], "u string, p string, n string")
    row = df.select(T.url_decode(F.col("u")), T.file_stem(F.col("p")), T.name_prefix(F.col("n"))).first()
    assert tuple(row) == ("a+b c%zz%", "name.v1", "NATION")
