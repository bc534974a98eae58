"""Secret scans: fixed patterns, and character Markov models for what they miss.

Two first-order models over the same characters are trained from labelled
tokens of all documents: values that the fixed patterns find stand for random
strings, tokens in the shape of words, names, domains, paths and numbers for
ordinary identifiers. Any token of 12 characters or more is reported when its
log-likelihood ratio per character exceeds the threshold of its length, set on
held-out ordinary tokens of that length. Training moves a table of pair counts
per task, never tokens.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import Words, keep, sliced, text_key

KINDS = ("assign", "access", "hex", "model")
#: The patterns of the base kinds and the least length of each.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: Shortest token the models judge, and shortest they learn from.
MIN_TOKEN, MIN_TRAIN = 12, 8
#: Lengths are told apart by fours up to this many characters, for the thresholds.
LONGEST, STEP = 32, 4
#: A length with fewer held-out tokens takes the threshold of the next shorter one where that is higher.
LEAST_HELD = 1000
#: One labelled token in so many is held out.
HELD = 5
#: Shares of equally likely characters in the two models: random strings have other
#: alphabets than those that the patterns know, and no pair is impossible in a name.
UNIFORM, UNSEEN = 0.5, 1e-3
#: A threshold lies so many standard deviations above the mean of the held-out ordinary tokens
#: of its length. (A quantile would follow the few random strings that look ordinary.)
DEVIATIONS = 5.0
BUCKETS, BUCKET_WIDTH = 400, 0.05

_CHARS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
STATES = len(_CHARS) + 1  # the last is a token's beginning
_state = np.full(256, -1, np.int64)
_state[np.frombuffer(_CHARS, np.uint8)] = np.arange(len(_CHARS))
_TOKEN = _state >= 0
_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
#: Kinds of characters: 0 signs, 1 digits, 2 capitals, 3 small letters.
_SORT = np.zeros(256, np.uint8)
_SORT[48:58], _SORT[65:91], _SORT[97:123] = 1, 2, 3
#: One capital after a small letter, as in names put together, a token may have for so many characters.
HUMP = 5
_SETTER = np.zeros(256, bool)
_SETTER[np.frombuffer(b":=", np.uint8)] = True


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the fixed patterns by start, then kind."""
    found = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts in which a fixed pattern can match at all."""
    n = len(offsets) - 1
    some = np.zeros(n, bool)
    doc_of = lambda at: np.searchsorted(offsets, at, side="right") - 1
    some[doc_of(np.flatnonzero(_SETTER[data]))] = True
    runs = Words(data, offsets, _HEX, fold=False)
    some[runs.doc[runs.end - runs.start >= LEAST["hex"]]] = True
    raw, at = data.tobytes(), -1
    while (at := raw.find(b"AKIA", at + 1)) >= 0:
        some[doc_of(at)] = True
    return np.flatnonzero(some)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, Words, dict[int, list]]]:
    """Runs of texts with their tokens and the base spans of each text that has any."""
    for a, _, data, offsets in sliced(texts):
        base = {}
        for d in _suspects(data, offsets).tolist():
            if spans := base_spans(data[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "replace")):
                base[d] = spans
        yield a, data, offsets, Words(data, offsets, _TOKEN, fold=False), base


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(values)))


def _ordinary(words: Words) -> np.ndarray:
    """Tokens whose letters and digits stand apart and whose letters change to
    capitals seldom, and names behind an at sign: the label of an ordinary identifier."""
    sort = _SORT[words.data]
    left, right = sort[:-1], sort[1:]
    touch = np.concatenate(([False], ((left == 1) & (right >= 2)) | ((left >= 2) & (right == 1)), [False]))
    humps = np.concatenate(([False], (left == 3) & (right == 2), [False]))
    touches, humps = _sums(touch), _sums(humps)
    inner = np.minimum(words.start + 1, words.end)
    apart = (touches[words.end] == touches[inner]) & (HUMP * (humps[words.end] - humps[inner]) <= words.end - words.start)
    return apart | ((words.start > 0) & (words.data[words.start - 1] == ord("@")))


def _length_class(size: np.ndarray) -> np.ndarray:
    return np.minimum(size, LONGEST) // STEP


def _pairs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of states and their successors within tokens, as one flat table."""
    mark = np.zeros(len(data) + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, ends, -1)
    within = np.cumsum(mark[:-1]) > 0
    state = _state[data]
    before = np.empty_like(state)
    before[:1] = -1
    before[1:] = state[:-1]
    before[starts] = STATES - 1
    return np.bincount(before[within] * STATES + state[within], minlength=STATES * STATES)


def _value_pairs(values: list[str]) -> np.ndarray:
    """The same of separate strings; characters that no token has are left out."""
    raw = np.frombuffer("\n".join(values).encode(), np.uint8)
    words = Words(raw, np.array([0, len(raw)]), _TOKEN, fold=False)
    return _pairs(raw, words.start, words.end)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    random = np.zeros(STATES * STATES, np.int64)
    plain = np.zeros(STATES * STATES, np.int64)
    for batch in batches:
        for _, data, _, words, base in _chunks(batch.column(0)):
            values = [s[3] for spans in base.values() for s in spans if zlib.crc32(s[3].encode()) % HELD]
            if values:
                random += _value_pairs(values)
            taught = (words.end - words.start >= MIN_TRAIN) & (words.hash % np.uint64(HELD) != 0)
            taught &= _ordinary(words)
            plain += _pairs(data, words.start[taught], words.end[taught])
    at = np.flatnonzero(random + plain)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(random[at]), pa.array(plain[at])], names=["pair", "random", "plain"])


def train(documents: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each pair of states, from all labelled tokens.
    The table has a fixed number of cells, whatever the input."""
    counted = documents.select("text").mapInArrow(_train, "pair long, random long, plain long")
    tables = np.ones((2, STATES * STATES))
    for row in counted.groupBy("pair").agg(F.sum("random").alias("random"), F.sum("plain").alias("plain")).collect():
        tables[:, row.pair] += row.random, row.plain
    chance = tables.reshape(2, STATES, STATES)
    chance /= chance.sum(axis=2, keepdims=True)
    for kind, share in enumerate((UNIFORM, UNSEEN)):
        chance[kind] = (1 - share) * chance[kind] + share / len(_CHARS)
    return np.log(chance[0]) - np.log(chance[1])


def _scan(documents: DataFrame, ratio: np.ndarray) -> DataFrame:
    """A row per document with base spans and scored tokens, and the histogram
    of held-out tokens' scores by length as further rows."""
    shared = documents.sparkSession.sparkContext.broadcast(ratio)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        histogram = np.zeros((LONGEST // STEP + 1) * BUCKETS, np.int64)
        for batch in batches:
            n = batch.num_rows
            base_of: list[list] = [[] for _ in range(n)]
            scored_of: list[list] = [[] for _ in range(n)]
            for a, data, offsets, words, base in _chunks(batch.column(2)):
                for d, spans in base.items():
                    base_of[a + d] = [{"kind": k, "start": s, "end": e} for k, s, e, _ in spans]
                state = _state[data]
                before = np.empty_like(state)
                before[:1] = -1
                before[1:] = state[:-1]
                before[words.start] = STATES - 1
                gains = _sums(np.where((state < 0) | (before < 0), 0, table[before, state]))
                size = words.end - words.start
                score = (gains[words.end] - gains[words.start]) / np.maximum(size, 1)
                held = (size >= MIN_TRAIN) & (words.hash % np.uint64(HELD) == 0)
                held &= _ordinary(words)
                bucket = np.clip((score[held] / BUCKET_WIDTH).astype(np.int64) + BUCKETS // 2, 0, BUCKETS - 1)
                histogram += np.bincount(_length_class(size[held]) * BUCKETS + bucket, minlength=len(histogram))
                chosen = np.flatnonzero((size >= MIN_TOKEN) & (score > 0))
                if len(chosen):
                    points = _sums((data & 0xC0) != 0x80)
                    for i in chosen.tolist():
                        d = int(words.doc[i])
                        low, high = int(points[words.start[i]] - points[offsets[d]]), int(points[words.end[i]] - points[offsets[d]])
                        if all(high <= s or e <= low for _, s, e, _ in base.get(d, ())):
                            scored_of[a + d].append({"start": low, "end": high, "size": int(size[i]), "score": float(score[i])})
            base_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            scored_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("size", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(base_of, base_type), pa.array(scored_of, scored_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                names=["doc_id", "tkey", "base", "scored", "bucket", "n"],
            )
        at = np.flatnonzero(histogram)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), base_type), pa.nulls(len(at), scored_type), pa.array(at), pa.array(histogram[at])],
                names=["doc_id", "tkey", "base", "scored", "bucket", "n"],
            )

    schema = "doc_id long, tkey long, base array<struct<kind: string, start: long, end: long>>, scored array<struct<start: long, end: long, size: long, score: double>>, bucket long, n long"
    picked = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tkey"), "text")
    return picked.mapInArrow(scan, schema)


def _thresholds(histogram: dict[int, int]) -> list[float]:
    """For each class of length the score ``DEVIATIONS`` above its held-out tokens'
    mean, 0 at least. Few held-out tokens say little: there the next shorter
    class's holds, whose scores spread wider. Without any nothing is reported."""
    limits: list[float] = []
    middles = (np.arange(BUCKETS) + 0.5 - BUCKETS // 2) * BUCKET_WIDTH
    for size in range(LONGEST // STEP + 1):
        counts = np.array([histogram.get(size * BUCKETS + b, 0) for b in range(BUCKETS)], np.float64)
        if counts.sum() >= LEAST_HELD or (counts.sum() and not (limits and np.isfinite(limits[-1]))):
            mean = (counts * middles).sum() / counts.sum()
            spread = np.sqrt((counts * (middles - mean) ** 2).sum() / counts.sum() + BUCKET_WIDTH**2)
            limits.append(max(0.0, float(mean + DEVIATIONS * spread)))
        else:
            limits.append(limits[-1] if limits else float("inf"))
    return limits


def secret_spans(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``tkey`` and ``base`` and ``spans``: arrays of kind,
    start and end (code points, end exclusive) by start, then kind.

    Null and empty texts have no spans; rows are judged on their own, so repeated
    rows agree. Without labelled secrets the models know nothing and add no span.
    Columns besides doc_id and text are ignored.
    """
    scanned = keep(_scan(documents, train(documents)), "secrets")
    histogram = {r.bucket: r.n for r in scanned.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    limits = F.array(*map(F.lit, _thresholds(histogram)))
    limit = lambda s: F.get(limits, F.floor(F.least(s["size"], F.lit(LONGEST)) / STEP).cast("int"))
    added = F.transform(
        F.filter("scored", lambda s: s["score"] >= limit(s)), lambda s: F.struct(F.lit("model").alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    order = lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("place"), s["kind"].alias("kind"), s["end"].alias("end"))
    ordered = F.transform(F.array_sort(F.transform(F.concat("base", added), order)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.where("bucket is null").select("doc_id", "tkey", "base", ordered.alias("spans"))


def joined(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
