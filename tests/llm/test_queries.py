"""The registered queries against their SQL or a restatement in plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from blockloom.llm.common import table
from blockloom.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in table(spark, FOLDER, "documents").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES[name]) is None


def test_html_text_is_the_documents(spark, docs):
    """Pages are made of documents: a title, then its lines."""
    lines = {tuple(" ".join(x.split()) for x in r.text.split("\n") if x.strip()) for r in docs.values()}
    found = [tuple(r.text.split("\n\n")) for r in QUERIES["op2_html"](spark, FOLDER).collect()]
    assert found and all(f in lines or f[1:] in lines for f in found)


def test_sharding_sizes_and_slots(spark, docs):
    rows = QUERIES["op4_sharding"](spark, FOLDER).collect()
    slots = defaultdict(list)
    for r in rows:
        raw = docs[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8)) and len(rows) == len(docs)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_token_files_hold_the_librarys_ids(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, at = {r.doc_id: r for r in QUERIES["op5_token_files"](spark, FOLDER).collect()}, 0
    for doc in sorted(docs):
        ids = np.array([*tokenizer.encode(docs[doc].text, add_special_tokens=False).ids, 0], "<u4")
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def luhn(digits: str) -> bool:
    worth = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(w - 9 * (w > 9) for w in worth) % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v, d: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v, d: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v, d: 16 <= len(d) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v, d: 8 <= len(d) <= 15),
}


def personal(text: str) -> list[str]:
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in PII.items() for m in re.finditer(p, text) if ok(m[0], re.sub("[^0-9]", "", m[0]))]


def secret(text: str) -> list[str]:
    assign = r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


@pytest.mark.parametrize(("name", "plain", "kinds"), [("op6_pii", personal, ("email", "ip", "card", "phone")), ("op7_secrets", secret, ("assign", "access", "hex"))])
def test_base_spans(spark, docs, name, plain, kinds):
    for r in QUERIES[name](spark, "/root/testdata/sf0.001").collect():
        spans = plain(docs[r.doc_id].text)
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(s.startswith(k + ":") for s in spans) for k in kinds]
        assert set(spans) <= set(r.spans.split(","))


def test_packing_is_whole_and_tight(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, total, wanted = QUERIES["op8_packing"](spark, FOLDER).collect(), 0, {}
    for doc, r in docs.items():
        ids = np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        wanted |= {(doc, a // 4096): (a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for a in range(0, len(ids), 4096)}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == wanted and len(rows) == len(wanted)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)])]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096
    assert len(sequences) <= -(-total // 4096) + 1


def test_quality_statistics(spark, docs):
    for r in QUERIES["op10_quality"](spark, FOLDER).collect():
        text = docs[r.doc_id].text
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        seen, covered = defaultdict(list), set()
        for i in range(len(words) - 2):
            seen[tuple(words[i : i + 3])].append(i)
        for places in seen.values():
            covered |= {i + j for i in places for j in range(3)} if len(places) > 1 else set()
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed,
        )
        assert not (failed and r.kept)


def test_quality_keeps_clean_and_drops_junk(spark):
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    rows = QUERIES["op10_quality"](spark, "/root/testdata/sf0.01").where("not base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert sum(not r.kept for r in rows if r.quality == 0) > 0.8 * sum(r.quality == 0 for r in rows)


def test_pipeline_stages(spark, tmp_path):
    """Stages narrow one another, keep the columns, and end in sequences."""
    docs = table(spark, FOLDER, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_join", "decontamination", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns, name
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and left
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in packed} == ids
