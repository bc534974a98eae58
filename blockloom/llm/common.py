"""What the operators of this subpackage share: stored tables, word arrays, set hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.session import scratch_path

#: Bytes of text that one step of the array code holds at a time; a longer text is a step of its own.
SLICE_BYTES = 1 << 21


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, and
    a lost executor costs a reread. ``release`` removes it when it is used up."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._kept = path  # noqa: SLF001
    return back


def release(*frames: DataFrame) -> None:
    """Delete tables written by ``keep`` that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_kept", None)
        if path:
            spark = df.sparkSession
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)  # noqa: SLF001


#: Stored tables of up to so many numbers (8 bytes each) are sent to every executor.
SENT_NUMBERS = 1_000_000


def sent(df: DataFrame, numbers: int) -> DataFrame:
    """``df`` broadcast if the numbers it holds, as counted, allow it; else as it is."""
    return F.broadcast(df) if numbers <= SENT_NUMBERS else df


def same(left: Column, right: Column) -> Column:
    """Equality that also holds between nulls."""
    return left.eqNullSafe(right)


def text_key(text: str = "text") -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.col(text))


def rows_by_key(documents: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The documents' rows, all columns as they are, that are (``left_semi``) or
    are not (``left_anti``) among the ``keys`` (doc_id, tkey)."""
    on = same(F.col("_rows.doc_id"), F.col("_keys.doc_id")) & (F.xxhash64(F.col("_rows.text")) == F.col("_keys.tkey"))
    return documents.alias("_rows").join(keys.select("doc_id", "tkey").distinct().alias("_keys"), on, how)


# --- a bit table of fixed size, to let rows go before an exact join -----------

#: 2**25 bits, 4 MB, at any input size.
BITS = 25
_SEGMENT = 16


def bit_table(hashes: DataFrame, column: str) -> np.ndarray:
    """A bit for each value of ``column``'s leading bits, put together from segments."""
    top = F.shiftrightunsigned(column, 64 - BITS)
    bits = hashes.select(F.shiftright(top, _SEGMENT).alias("segment"), top.bitwiseAND((1 << _SEGMENT) - 1).alias("bit")).distinct()

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(1 << _SEGMENT, bool)
        marks[part["bit"].to_numpy()] = True
        return pd.DataFrame({"segment": [part["segment"].iloc[0]], "marks": [np.packbits(marks).tobytes()]})

    out = np.zeros((1 << (BITS - _SEGMENT), (1 << _SEGMENT) // 8), np.uint8)
    for row in bits.groupBy("segment").applyInPandas(fill, "segment long, marks binary").toLocalIterator():
        out[row.segment] = np.frombuffer(row.marks, np.uint8)
    return out.reshape(-1)


def has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned hashes may be in the table: all that are, and few others."""
    bit = hashes >> np.uint64(64 - BITS)
    return (bits[(bit >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1 == 1


# --- words and hashes of whole Arrow batches ---------------------------------

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_MIX = _rng.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C13  # 3 modulo 8
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
#: Byte to lower-cased byte, and whether it belongs to a word: digits, letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True
#: Everything but blanks.
SPACED = np.ones(256, bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 1 << 16)
        for name, base in (("_POWERS", _BASE), ("_INVERSES", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _POWERS[:n], _INVERSES[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of some texts: ``doc`` has each word's text number, ``start`` and
    ``end`` its place in the bytes ``data`` (lower-cased if folded), ``hash`` its 64-bit hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: bool = True):
        n = len(data)
        self.n_docs = len(offsets) - 1
        self.data = _lower[data] if fold else data
        mask = inside[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = mask[:-1]
        starts = mask & (~before | edge[:n])
        after = np.zeros(n, bool)
        after[:-1] = mask[1:]
        ends = mask & (~after | edge[1:])
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.concatenate(([0], np.cumsum(self.count)))

    @cached_property
    def hash(self) -> np.ndarray:
        n = len(self.data)
        power, inverse = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * power[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * inverse[self.start])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of every k words in a row, text ends ignored."""
        n = max(0, len(self.hash) - k + 1)
        out = np.zeros(n, np.uint64)
        for i in range(k):
            out += self.hash[i : i + n] * _MIX[i]
        return mix(out)

    def inside(self, k: int) -> np.ndarray:
        """Which runs of k words lie within one text."""
        n = max(0, len(self.doc) - k + 1)
        return self.doc[:n] == self.doc[k - 1 : k - 1 + n]

    def text(self, a: int, b: int) -> str:
        """Words a to b, joined by single blanks."""
        raw, s, e = self.data, self.start, self.end
        return b" ".join(raw[s[i] : e[i]].tobytes() for i in range(a, b)).decode("utf-8", "replace")


def sliced(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A string column in runs of rows of about ``limit`` bytes: first row, end,
    bytes, offsets within them. Nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end
