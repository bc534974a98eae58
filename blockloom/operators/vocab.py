"""Vocabulary table, encoding and decoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.functions.text import (
    BOS_ID,
    EOS_ID,
    IGNORE,
    IGNORED_TEXT,
    SPECIAL_TOKENS,
    TOKEN_SEPARATOR,
    UNK_ID,
)
from blockloom.operators.patching import Patch, miss_columns, numbering, patch_arrays
from blockloom.operators.rows import with_row_index
from blockloom.operators.steps import steps
from blockloom.session import stored

#: A lookup table with more rows than this is not broadcast whole.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """``table(token, id)``; ids are ranked by frequency and may have gaps.

    ``max_rows`` is a bound known beforehand; without one the rows are counted.
    """

    table: DataFrame
    max_rows: int | None = None

    def rows(self) -> int:
        return self.max_rows if self.max_rows is not None else self.table.count()

    @cached_property
    def shared(self) -> Broadcast:
        """Tokens and their ids, for the tasks, by id.  Only for checked sizes."""
        rows = self.table.select("token", "id").toArrow().sort_by("id")
        ids = rows.column("id").to_pylist()
        if len(set(ids)) < len(ids):
            raise ValueError("an id of a vocabulary must not occur twice")
        return self.table.sparkSession.sparkContext.broadcast(dict(zip(rows.column("token").to_pylist(), ids)))

    def frequent(self, limit: int) -> "Vocabulary":
        """The entries of the first ``limit`` ids."""
        return Vocabulary(self.table.where(F.col("id") < limit), limit)


def _special_rows(spark: SparkSession) -> DataFrame:
    """The special tokens, as a plan that needs no data from the driver."""
    named = F.array(*[F.lit(t) for t in SPECIAL_TOKENS])
    return spark.range(1).select(F.posexplode(named).alias("id", "token")).select("token", "id")


def build_vocab(df: DataFrame, *, text: str = "text", max_vocab: int | None = None) -> Vocabulary:
    """Rank tokens by (count desc, token) behind the special tokens.

    The counts are stored, as they are read more than once.  With ``max_vocab``
    (special tokens included) those below the count at the cap go first; the
    rest, like all tokens without a cap, is ranked by a range partitioning.
    """
    words = df.select(F.explode(F.split(text, TOKEN_SEPARATOR)).alias("token"))
    # The empty word is none, and the special tokens have their ids already.
    counts = words.where(~F.col("token").isin("", *SPECIAL_TOKENS)).groupBy("token").agg(F.count("*").alias("n"))
    counts = stored(counts.select("token", (-F.col("n")).alias("minus_n")), "token-counts")
    wanted = None if max_vocab is None else max(max_vocab - len(SPECIAL_TOKENS), 0)
    if wanted is not None:
        counts = counts.where(F.col("minus_n") <= -_count_at(counts, wanted))
    ranked = with_row_index(counts, order=["minus_n", "token"])
    if wanted is not None:
        # Tokens that tie at the cap are ranked with the others, then cut.
        ranked = ranked.where(F.col("row_idx") < wanted)
    ids = (F.col("row_idx") + len(SPECIAL_TOKENS)).cast("int")
    table = _special_rows(df.sparkSession).unionByName(ranked.select("token", ids.alias("id")))
    return Vocabulary(table, max_vocab) if max_vocab is not None else Vocabulary(stored(table, "vocab"))


def _count_at(counts: DataFrame, place: int) -> int:
    """The count of the token at a place of the ranking (from 1), by two levels
    of a histogram: powers of two, at most 64, then the counts within one.

    Counts within a power of two are cut to 4,096 ranges until one is left.
    """
    level = F.length(F.bin(-F.col("minus_n")))
    left = place
    low, high = 0, 1 << 63
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        if left <= row["count"]:
            low, high = 1 << (row["level"] - 1), 1 << row["level"]
            break
        left -= row["count"]
    else:
        return 0  # fewer tokens than places: all of them
    while high - low > 1:
        width = -(-(high - low) // 4096)
        inside = counts.where((F.col("minus_n") <= -low) & (F.col("minus_n") > -high))
        cell = F.floor((-F.col("minus_n") - low) / F.lit(width)).cast("bigint") if width > 1 else -F.col("minus_n") - low
        for row in sorted(inside.groupBy(cell.alias("cell")).count().collect(), reverse=True):
            if left <= row["count"]:
                low, high = low + row["cell"] * width, min(high, low + (row["cell"] + 1) * width)
                break
            left -= row["count"]
    return low


@dataclass(frozen=True)
class Field:
    """One text column to encode, and how."""

    text: str | Column
    out: str
    add_bos: bool = True
    add_eos: bool = False


def encode_fields(
    df: DataFrame,
    vocab: Vocabulary,
    fields: Sequence[Field],
    *,
    key: Sequence[str],
    keep: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Encode several text columns; returns the key, ``keep`` and the ids.

    The texts are encoded where they are, with no shuffle: against the whole
    vocabulary if it has at most ``broadcast_rows`` entries, else against its
    frequent part.  What that misses is patched, and only misses are exchanged.
    Rows stay as many as they are, whatever their keys.
    """
    key, keep = list(key), list(keep)
    if vocab.rows() <= broadcast_rows:
        shared = vocab.shared
        return _encoded(df, [*key, *keep], shared, fields, [f.out for f in fields])
    shared = vocab.frequent(broadcast_rows).shared
    first = _encoded(df, [*key, *keep], shared, fields, [f"_e{i}" for i in range(len(fields))], True)
    rare = vocab.table.where(F.col("id") >= broadcast_rows).select(F.col("token").alias("key"), F.col("id").alias("value"))
    patches = [Patch(f"_e{i}", f.out) for i, f in enumerate(fields)]
    return patch_arrays(first, patches, rare)


def _encoded(df: DataFrame, kept: Sequence[str], shared: Broadcast, fields: Sequence[Field], out: Sequence[str], misses: bool = False) -> DataFrame:
    """``kept`` and the ids of all fields, from one evaluation: a task has one worker, however many fields there are."""
    if len(fields) == 1:
        return df.select(*kept, _encoder(shared, fields[0].add_bos, fields[0].add_eos, misses)(fields[0].text).alias(out[0]))
    made = df.select(*kept, _encoder_of_all(shared, [(f.add_bos, f.add_eos) for f in fields], misses)(*(f.text for f in fields)).alias("_made"))
    return made.select(*kept, *(F.col(f"_made.f{i}").alias(name) for i, name in enumerate(out)))


# The functions below travel to the tasks whole: what they call is defined
# inside, so that workers need not have this package.


def _encoding(add_bos: bool, add_eos: bool, misses: bool):
    """The ids of an Arrow column of texts: a function of the column, the known ids and a task's numbers."""
    with_misses = miss_columns("string")

    def encoded(texts: pa.Array, known: dict[str, int], number_of: Callable) -> pa.Array:
        pieces = pc.split_pattern_regex(pc.fill_null(texts, ""), TOKEN_SEPARATOR)
        words = pieces.flatten()
        real = pc.not_equal(words, "")
        words = words.filter(real).dictionary_encode()
        # Each distinct word of a batch is looked up once.
        distinct = words.dictionary.to_pylist()
        of_word = np.fromiter((known.get(w, -1) for w in distinct), np.int32, len(distinct))
        number = words.indices.to_numpy()
        ids = of_word[number]
        # Where each text starts once empty words are gone and marks are added.
        kept = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
        ends = kept[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()]
        marks = int(add_bos) + int(add_eos)
        rows = np.arange(len(texts))
        offsets = ends + np.arange(len(texts) + 1) * marks
        out = np.empty(offsets[-1], dtype=np.int32)
        places = np.arange(len(ids)) + np.repeat(rows * marks + int(add_bos), np.diff(ends))
        out[places] = np.where(ids < 0, UNK_ID, ids)
        if add_bos:
            out[offsets[:-1]] = BOS_ID
        if add_eos:
            out[offsets[1:] - 1] = EOS_ID
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out))
        if not misses:
            return lists
        unknown = np.flatnonzero(ids < 0)
        place = places[unknown] - np.repeat(offsets[:-1], np.diff(ends))[unknown]
        each, at = np.unique(number[unknown], return_inverse=True)
        numbers, base, new = number_of([distinct[w] for w in each])
        return with_misses(lists, np.searchsorted(unknown, ends), place, numbers[at], base, new)

    return encoded


def _encoded_type(misses: bool) -> str:
    return "struct<values:array<int>,place:array<int>,number:array<int>,base:int,key:array<string>>" if misses else "array<int>"


def _encoder_of_all(shared: Broadcast, marks: Sequence[tuple[bool, bool]], misses: bool):
    """As :func:`_encoder`, several columns at once: a struct of ``f0`` and so on."""
    cut, begin, encoded = steps(), numbering(), [_encoding(bos, eos, misses) for bos, eos in marks]
    names = [f"f{i}" for i in range(len(marks))]

    @F.arrow_udf(f"struct<{','.join(f'{name}:{_encoded_type(misses)}' for name in names)}>")
    def ids_of_all(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        known, numbers = shared.value, [begin() for _ in names]
        for columns in cut(batches):
            yield pa.StructArray.from_arrays([of(texts, known, n) for of, texts, n in zip(encoded, columns, numbers)], names=names)

    return ids_of_all


def _encoder(shared: Broadcast, add_bos: bool, add_eos: bool, misses: bool = False):
    """Text to ids, whole Arrow columns at a time; with ``misses`` also the place
    and the number of each word that is not known, see :class:`patching.Patch`."""
    cut, begin, encoded = steps(), numbering(), _encoding(add_bos, add_eos, misses)

    @F.arrow_udf(_encoded_type(misses))
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, number_of = shared.value, begin()
        for texts in cut(batches):
            yield encoded(texts, known, number_of)

    return ids_of


def decoding(misses: bool = False):
    """Names the ids of an Arrow column of lists: a function of the column, the known ids
    ascending and their tokens, and with ``misses`` a task's numbers."""
    with_misses = miss_columns("int32")

    def decoded(lists: pa.Array, numbers: np.ndarray, names: pa.Array, number_of: Callable | None = None) -> pa.Array:
        flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(numbers, flat), max(len(numbers) - 1, 0))
        known = numbers[at] == flat if len(numbers) else np.zeros(len(flat), bool)
        ignored = flat == IGNORE
        tokens = pc.if_else(pa.array(ignored), IGNORED_TEXT, names.take(pa.array(at, mask=~known)))
        # Null lists count as empty.
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tokens)
        if not misses:
            return out
        unknown = np.flatnonzero(~known & ~ignored)
        place = unknown - np.repeat(offsets[:-1], lengths)[unknown]
        each, at = np.unique(flat[unknown], return_inverse=True)
        given, base, new = number_of(each.tolist())
        return with_misses(out, np.searchsorted(unknown, offsets), place, given[at], base, new)

    return decoded


def _decoder(shared: Broadcast, misses: bool = False):
    """Ids to tokens, whole Arrow columns at a time; with ``misses`` also the
    place and the number of each id that is not known, see :class:`patching.Patch`."""
    cut, begin, decoded = steps(), numbering(), decoding(misses)

    @F.arrow_udf("struct<values:array<string>,place:array<int>,number:array<int>,base:int,key:array<int>>" if misses else "array<string>")
    def tokens_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers = np.fromiter(shared.value.values(), np.int64, len(shared.value))
        names = pa.array(list(shared.value), pa.string())
        number_of = begin()
        for lists in cut(batches):
            yield decoded(lists, numbers, names, number_of)

    return tokens_of


def encode(
    df: DataFrame,
    vocab: Vocabulary,
    *,
    text: str = "text",
    key: Sequence[str],
    keep: Sequence[str] = (),
    add_bos: bool = True,
    add_eos: bool = False,
    out: str = "input_ids",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Text to ``[bos] + ids + [eos]``; unknown tokens become the unk id.

    Returns the key, the ``keep`` columns and the ids.
    """
    field = Field(text, out, add_bos, add_eos)
    return encode_fields(df, vocab, [field], key=key, keep=keep, broadcast_rows=broadcast_rows)


def decode(
    df: DataFrame,
    vocab: Vocabulary,
    *,
    ids: str = "input_ids",
    key: Sequence[str],
    out: str = "tokens",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Ids to token strings; the ignored label reads ``igx``, an id that the
    vocabulary lacks is null.

    Returns the key and the array of tokens.  As with :func:`encode_fields`,
    rows stay where they are, and only what a large vocabulary's frequent part
    misses is exchanged.
    """
    key = list(key)
    if vocab.rows() <= broadcast_rows:
        return df.select(*key, _decoder(vocab.shared)(ids).alias(out))
    first = df.select(*key, _decoder(vocab.frequent(broadcast_rows).shared, True)(ids).alias("_d"))
    rare = vocab.table.where(F.col("id") >= broadcast_rows).select(F.col("id").alias("key"), F.col("token").alias("value"))
    return patch_arrays(first, [Patch("_d", out)], rare)


def decode_text(
    df: DataFrame, vocab: Vocabulary, *, ids: str, key: Sequence[str], out: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Ids to text.  Ignored labels count as id 0, as there is nothing to show."""
    shown = df.select(*key, F.transform(ids, lambda x: F.when(x == IGNORE, 0).otherwise(x)).alias(ids))
    named = decode(shown, vocab, ids=ids, key=key, broadcast_rows=broadcast_rows)
    return named.select(*key, F.array_join("tokens", " ").alias(out))


def overlong(df: DataFrame, max_len: int, *, by: Sequence[str] = ("source",), ids: str = "input_ids") -> DataFrame:
    """Rows longer than the limit, counted per source."""
    # (a filter on the ids would have them made once more, to see which rows it leaves)
    sized = df.select(*by, F.size(ids).alias("_n"))
    counted = sized.groupBy(*by).agg(F.count(F.when(F.col("_n") > max_len, 1)).alias("n_overlong"), F.max("_n").cast("bigint").alias("longest"))
    return counted.where("n_overlong > 0")


def resolve_block_size(requested: Column | int | None, model_max: int, default: int = 1024) -> Column | int:
    """No request: the model's limit, at most ``default``; else the smaller of
    the two.  Works on plain numbers and on a column of requests."""
    if isinstance(requested, Column):
        asked = F.least(requested, F.lit(model_max))
        return F.when(requested.isNull(), F.lit(min(model_max, default))).otherwise(asked)
    return min(model_max, default) if requested is None else min(requested, model_max)
