"""Files, stored results, streaming, whole corpora."""

import json
import random

import pandas as pd
import pytest

from blockloom import sources as S
from blockloom.operators.batches import map_batches
from blockloom.operators.packing import pack_blocks, with_scope
from blockloom.operators.rows import with_row_index
from blockloom.operators.vocab import build_vocab, encode
from blockloom.plans import build_instruction_corpus, build_pretraining_corpus
from blockloom.sources import readers
from blockloom.streaming import incremental_sources


def rows(df):
    return [r["text"] for r in df.orderBy("file", "row_idx").collect()]


@pytest.fixture
def small_splits(spark):
    """Files are read in pieces of a few bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "64")
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("broadcast", (200_000, 0))
def test_text_lines(spark, tmp_path, small_splits, monkeypatch, broadcast):
    monkeypatch.setattr(readers, "BROADCAST_SPLITS", broadcast)
    lines = [f"　　line {i} " + "x" * (i % 40) for i in range(200)] + ["", "", "end"]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.txt").write_bytes(b"one\r\ntwo\r\n\r\nthree")
    df = S.read_text(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    got = df.orderBy("file", "row_idx").collect()
    assert [r["text"] for r in got] == lines + ["one", "two", "", "three"]
    assert [r["row_idx"] for r in got] == list(range(len(lines))) + list(range(4))
    assert {r["n_rows"] for r in got} == {len(lines), 4}


def test_text_keeps_linebreaks(spark, tmp_path, small_splits):
    (tmp_path / "a.txt").write_text("one\n\ntwo\n")
    (tmp_path / "b.txt").write_bytes(b"one\r\ntwo")
    df = S.read_text(spark, str(tmp_path), keep_linebreaks=True)
    assert rows(df) == ["one\n", "\n", "two\n", "one\n", "two"]


def test_text_paragraphs_and_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("p1\nq\n\n\n\np2\n\np3\n")
    path = str(tmp_path / "a.txt")
    assert rows(S.load_source(spark, [path, 1, {"sample_by": "paragraph"}])) == ["p1\nq", "p2", "p3\n"]
    assert rows(S.load_source(spark, [path, 1, {"sample_by": "document"}])) == ["p1\nq\n\n\n\np2\n\np3\n"]
    (tmp_path / "w.txt").write_bytes(b"p1\r\nq\r\n\r\np2\r\n")
    path = str(tmp_path / "w.txt")
    assert rows(S.read_text(spark, path, sample_by="paragraph")) == ["p1\nq", "p2\n"]
    assert rows(S.read_text(spark, path, sample_by="document")) == ["p1\nq\n\np2\n"]
    with pytest.raises(ValueError):
        S.read_text(spark, path, sample_by="word")


def test_paragraphs_at_any_split(spark, tmp_path, small_splits):
    """Runs of newlines, as cutting at every two of them from the left has it."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    texts = {}
    for i, (gap, end) in enumerate([(2, 1), (3, 3), (4, 0), (5, 2)]):
        texts[f"{i}.txt"] = "\n" * i + ("\n" * gap).join(f"paragraph {j}\nof file" for j in range(25)) + "\n" * end
        (tmp_path / f"{i}.txt").write_text(texts[f"{i}.txt"])
    got = S.read_text(spark, str(tmp_path), sample_by="paragraph").orderBy("file", "row_idx").collect()
    for name, text in texts.items():
        mine = [r for r in got if r.file.endswith(name)]
        assert [r.text for r in mine] == [p for p in text.split("\n\n") if p], name
        assert [r.row_idx for r in mine] == list(range(len(mine))) and {r.n_rows for r in mine} == {len(mine)}


def test_numbers_hold_when_splits_change(spark, tmp_path, small_splits):
    path = tmp_path / "a.txt"
    path.write_text("".join(f"line {i}\n" for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    df = S.read_text(spark, str(path))
    for name, value in (("spark.sql.files.maxPartitionBytes", "3000"), ("spark.sql.files.minPartitionNum", "7")):
        spark.conf.set(name, value)
        got = df.orderBy("row_idx").collect()
        assert [r.text for r in got] == [f"line {i}" for i in range(2000)] and [r.row_idx for r in got] == list(range(2000))
    spark.conf.unset("spark.sql.files.minPartitionNum")


def test_json_forms_are_each_files_own(spark, tmp_path):
    (tmp_path / "big [1].json").write_text("\n [" + ",\n".join(f'{{"text": "a{i}"}}' for i in range(20)) + "]")
    (tmp_path / "lines.json").write_text("\n" + "".join(f'{{"id": 1, "text": "b{i}"}}\n' for i in range(50)))
    got = S.read_dir(spark, str(tmp_path), suffix="json").collect()
    assert sorted(r.text for r in got) == sorted([f"a{i}" for i in range(20)] + [f"b{i}" for i in range(50)])
    assert {(r.source, r.n_rows) for r in got} == {("big [1]", 20), ("lines", 50)}


def test_field_that_occurs_late(spark, tmp_path):
    late = "".join(f'{{"instruction": "i{i}", "output": "o"}}\n' for i in range(1199)) + '{"instruction": "x", "input": "y", "output": "z"}\n'
    (tmp_path / "a.jsonl").write_text(late)
    got = S.read_instructions(spark, str(tmp_path / "a.jsonl")).collect()
    assert len(got) == 1200 and [r.input for r in got if r.row_idx == 1199] == ["y"]


def test_line_ends_of_compressed_files(spark, tmp_path):
    import gzip

    (tmp_path / "a.txt.gz").write_bytes(gzip.compress(b"one\ntwo\n"))
    assert rows(S.read_text(spark, str(tmp_path / "a.txt.gz"))) == ["one", "two"]
    with pytest.raises(ValueError, match="compressed"):
        S.read_text(spark, str(tmp_path / "a.txt.gz"), keep_linebreaks=True)


def test_corpora_of_unlike_schema(spark, tmp_path):
    spark.sql("select 1 as label, 'a' as text from range(5)").write.parquet(str(tmp_path / "a/train"))
    spark.sql("select id as label, 'b' as text, 2 as more from range(7)").write.parquet(str(tmp_path / "b/train"))
    got = S.scan_corpus_dirs(spark, str(tmp_path))
    assert got.columns == ["name", "label", "text"] and got.groupBy("name").count().orderBy("name").collect() == [("a", 5), ("b", 7)]


def test_nothing_has_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    assert incremental_sources(spark, str(tmp_path / "in"), out, state, lambda batch: batch) is None


def test_json(spark, tmp_path):
    records = [{"text": f"t{i}\n", "other": i} for i in range(5)]
    (tmp_path / "l.jsonl").write_text("\n".join(json.dumps(r) for r in records) + "\n")
    (tmp_path / "a.json").write_text("\n " + json.dumps(records, indent=1))
    for name in ("l.jsonl", "a.json"):
        df = S.load_source(spark, str(tmp_path / name))
        assert set(df.columns) == {"file", "row_idx", "n_rows", "text"}
        assert rows(df) == [r["text"] for r in records]
    (tmp_path / "none.json").write_text('{"content": 1}\n')
    with pytest.raises(ValueError, match="text"):
        S.load_source(spark, str(tmp_path / "none.json"))
    with pytest.raises(ValueError, match="csv"):
        S.load_source(spark, str(tmp_path / "x.csv"))


def test_instruction_files(spark, tmp_path):
    records = [{"instruction": "i", "input": None, "output": "o", "extra": 1}, {"instruction": "j", "input": "", "output": "p"}]
    (tmp_path / "i.json").write_text(json.dumps(records))
    got = S.read_instructions(spark, str(tmp_path / "i.json")).orderBy("row_idx").collect()
    assert [(r["instruction"], r["input"], r["output"]) for r in got] == [("i", None, "o"), ("j", "", "p")]


def test_folder(spark, tmp_path):
    for name in ("b c.txt", "a.txt", "c.json"):
        (tmp_path / name).write_text('{"text": "%s"}\n' % name)
    assert {r["source"] for r in S.read_dir(spark, str(tmp_path)).collect()} == {"a", "b c"}
    assert {r["source"] for r in S.read_dir(spark, str(tmp_path), first_only=True).collect()} == {"a"}
    assert rows(S.read_dir(spark, str(tmp_path), suffix="json")) == ["c.json"]


def test_materialize_once_rebuilds_for_another_key(spark, tmp_path):
    builds = []

    def build(n):
        builds.append(n)
        return spark.range(n)

    folder = str(tmp_path / "once")
    for key, n in (({"b": 1}, 3), ({"b": 1}, 4), ({"b": 2}, 5)):
        last = S.materialize_once(spark, folder, key, lambda n=n: build(n))
    assert builds == [3, 5] and last.count() == 5


def test_a_failed_build_is_not_kept(spark, tmp_path):
    folder = str(tmp_path / "once")
    with pytest.raises(RuntimeError):
        S.materialize_once(spark, folder, {"a": 1}, lambda: (_ for _ in ()).throw(RuntimeError("stop")))
    assert S.materialize_once(spark, folder, {"a": 1}, lambda: spark.range(2)).count() == 2


def test_batches(spark):
    df = with_row_index(spark.range(25).withColumnRenamed("id", "k"), order=["k"])

    def sizes(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"first": [batch["k"].iloc[0]], "n": [len(batch)]})

    loose = map_batches(df.coalesce(1), sizes, "first bigint, n bigint", batch_rows=10).collect()
    assert sorted(r["n"] for r in loose) == [5, 10, 10]
    scoped = with_scope(df, workers=2, batch_rows=10)
    exact = map_batches(scoped, sizes, "first bigint, n bigint", scope=["shard", "batch"]).collect()
    assert sorted((r["first"], r["n"]) for r in exact) == [(0, 10), (10, 3), (13, 10), (23, 2)]


def test_incremental(spark, tmp_path):
    arrived, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    vocab = build_vocab(spark.createDataFrame([("a b c",)], "text string"))
    batches = []

    def packed(batch):
        batches.append(1)
        ids = encode(batch, vocab, key=["file", "block", "at"], add_eos=True)
        return pack_blocks(ids, block_size=4, scope=["file"], order=["block", "at"])

    (tmp_path / "in" / "1.txt").write_text("a b\nc\n")
    assert sorted(r["input_ids"] for r in incremental_sources(spark, arrived, out, state, packed).collect()) == [[1, 4, 5, 2]]
    incremental_sources(spark, arrived, out, state, packed)
    assert len(batches) == 1
    (tmp_path / "in" / "2.txt").write_text("c\n")
    done = incremental_sources(spark, arrived, out, state, packed)
    assert len(batches) == 2
    assert sorted(r["input_ids"] for r in done.collect()) == [[1, 4, 5, 2], [1, 6, 2]]


def test_arriving_blocks(spark, tmp_path):
    """Any cut of the files into arrivals gives the blocks of one run, also when a micro-batch is repeated."""
    rng = random.Random(3)
    vocab = build_vocab(spark.createDataFrame([("a b c d",)], "text string"))
    lines = {s: [" ".join(rng.choice("abcd") for _ in range(rng.randrange(6))) for _ in range(n)] for s, n in (("x", 30), ("y", 7), ("z", 1))}
    ids = {"a": 4, "b": 5, "c": 6, "d": 7}
    want = {}
    for source, texts in lines.items():
        stream = [i for t in texts for i in [1, *[ids[w] for w in t.split()], 2]]
        cut = [stream[i : i + 8] for i in range(0, len(stream) - len(stream) % 8, 8)] or [stream]
        want |= {(source, i): block for i, block in enumerate(cut)}

    from blockloom.streaming import incremental, incremental_blocks, open_tails

    arrived, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    shares = {"x": (0, 11, 11, 30), "y": (0, 2, 7, 7), "z": (0, 0, 0, 1)}
    failing = {1}
    write = incremental.pack_arrivals

    def fails_once(*args, **options):
        blocks, carried = write(*args, **options)
        if len(failing) == 1 and (tmp_path / "out" / "carried" / "version=0").exists():
            # The blocks are written, the state is not.
            blocks.write.mode("overwrite").parquet(f"{out}/blocks/batch={failing.pop()}")
            raise RuntimeError("lost")
        return blocks, carried

    incremental.pack_arrivals = fails_once
    try:
        for n in range(3):
            for source, edges in shares.items():
                part = lines[source][edges[n] : edges[n + 1]]
                if part:
                    (tmp_path / "in" / source).mkdir(parents=True, exist_ok=True)
                    (tmp_path / "in" / source / f"{n}.txt").write_text("".join(t + "\n" for t in part))
            try:
                found = incremental_blocks(spark, arrived, out, state, vocab, block_size=8)
            except Exception:
                found = incremental_blocks(spark, arrived, out, state, vocab, block_size=8)
    finally:
        incremental.pack_arrivals = write
    assert not failing
    rows = found.unionByName(open_tails(spark, out, short=True)).collect()
    assert {(r["source"], r["block"]): r["input_ids"] for r in rows} == want and len(rows) == len(want)
    carried = {r["source"]: (r["n_blocks"], len(r["tail"])) for r in open_tails(spark, out).collect()}
    assert set(carried) == {"x", "y", "z"} and all(n < 8 for _, n in carried.values())
    assert sorted(p.name for p in (tmp_path / "out" / "carried").iterdir()) == ["version=1", "version=2"]


def test_arriving_instructions(spark, tmp_path):
    from blockloom.streaming import incremental_instructions

    arrived, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    vocab = build_vocab(spark.createDataFrame([("one two o",)], "text string"))
    assert incremental_instructions(spark, arrived, out, state, vocab) is None
    row = {"instruction": "one", "input": None, "output": "o"}
    (tmp_path / "in" / "a.json").write_text(json.dumps([row, row]))
    (tmp_path / "in" / "empty.json").write_text("")
    assert incremental_instructions(spark, arrived, out, state, vocab).count() == 2
    (tmp_path / "in" / "b.jsonl").write_text(json.dumps(row | {"input": "two"}) + "\n")
    done = incremental_instructions(spark, arrived, out, state, vocab).collect()
    assert len(done) == 3 and all(r["labels"][-2:] == [6, 2] or r["labels"][-1] == 2 for r in done)
    assert len({tuple(r["input_ids"]) for r in done}) == 2


def test_pretraining_corpus(spark, tmp_path):
    (tmp_path / "x.txt").write_text("".join(f"a b c {i}\n" for i in range(100)))
    (tmp_path / "y.jsonl").write_text("".join(json.dumps({"text": "a b"}) + "\n" for _ in range(50)))
    vocab = build_vocab(spark.createDataFrame([("a b c",)], "text string"))
    out = str(tmp_path / "out")
    sources = [str(tmp_path / "x.txt"), [str(tmp_path / "y.jsonl"), 3]]
    options = {"block_size": 8, "workers": 2, "batch_rows": 20}
    build_pretraining_corpus(spark, sources, out, vocab, test=0.05, **options)
    # x: shards of 50 rows, batches 20, 20, 10 of 6 tokens; y: 25 rows, 20 and 5 of 4.
    n_x, n_y = 2 * (15 + 15 + 7), 2 * (10 + 2)
    train, test = (S.load_corpus(spark, f"{out}/merged", s) for s in ("train", "test"))
    total = n_x + 3 * n_y
    assert test.count() == -(-total * 5 // 100) and train.count() + test.count() == total
    assert sorted(r["row_idx"] for r in train.collect()) == list(range(train.count()))
    assert all(len(r["input_ids"]) == 8 and r["labels"] == r["input_ids"] for r in train.collect())
    corpora = S.scan_corpus_dirs(spark, f"{out}/single", split="data")
    assert {r["name"] for r in corpora.select("name").distinct().collect()} == {"x", "y"}
    # Other weights reuse the stored sources.
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "single").rglob("*.parquet")}
    build_pretraining_corpus(spark, [[str(tmp_path / "x.txt"), 0.5], str(tmp_path / "y.jsonl")], out, vocab, test=None, **options)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "single").rglob("*.parquet")} == before
    assert S.load_corpus(spark, f"{out}/merged", "train").count() == -(-n_x // 2) + n_y
    assert S.load_corpus(spark, f"{out}/merged", "test").count() == 0
    # Another block size does not.
    assert build_pretraining_corpus(spark, sources, out, vocab, merge=False, **options | {"block_size": 4}) is None
    assert spark.read.parquet(f"{out}/single/x/data").count() == 150


def test_equal_file_names(spark, tmp_path):
    for folder in ("one", "two"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "i.json").write_text(json.dumps([{"instruction": folder, "input": None, "output": "o"}] * 3))
    paths = [str(tmp_path / f / "i.json") for f in ("one", "two")]
    vocab = build_vocab(spark.createDataFrame([("one two o",)], "text string"))
    merged = build_instruction_corpus(spark, paths, str(tmp_path / "out"), vocab, test=2)
    assert merged.count() == 6 and merged.where("split = 'test'").count() == 2
    assert merged.select("source").distinct().count() == 2
    with pytest.raises(ValueError, match="twice"):
        build_instruction_corpus(spark, [paths[0], paths[0]], str(tmp_path / "out"), vocab)
    with pytest.raises(ValueError, match="weight"):
        build_instruction_corpus(spark, [[paths[0], 1.5]], str(tmp_path / "out"), vocab)
