"""Result tables: offsets, deltas, log-probabilities, usage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blockloom.operators.steps import steps
from blockloom.operators.vocab import BROADCAST_ROWS, Vocabulary, decode, decoding

CHOICE = ("request_id", "idx")


def explode_positions(df: DataFrame, *, key: Sequence[str] = CHOICE) -> DataFrame:
    """One row per generated token: ``pos``, ``token_id`` and its map of
    alternatives ``logprobs``."""
    # As many positions as the shorter of the two arrays has.
    zipped = F.arrays_zip("token_ids", "logprobs")
    rows = df.select(*key, F.least(F.size("token_ids"), F.size("logprobs")).alias("_n"), F.posexplode(zipped).alias("pos", "_z"))
    return rows.where(F.col("pos") < F.col("_n")).select(
        *key, "pos", F.col("_z.token_ids").alias("token_id"), F.col("_z.logprobs").alias("logprobs")
    )


def token_logprob(positions: DataFrame) -> DataFrame:
    """Add the chosen token's own log-probability; a missing one raises."""
    return positions.withColumn("token_logprob", _chosen(F.col("logprobs"), F.col("token_id")))


def _chosen(logprobs: Column, token_id: Column) -> Column:
    missing = F.raise_error(F.concat(F.lit("no log-probability for token "), token_id.cast("string")))
    return F.coalesce(F.try_element_at(logprobs, token_id), missing.cast("double"))


# These functions travel to the tasks whole, see vocab.py.


def _summing():
    """Exclusive running sums of each list of an Arrow column."""

    def sums_before(lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        values = pc.fill_null(lists.flatten(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.concatenate(([0], np.cumsum(values)))
        out = total[:-1] - np.repeat(total[ends[:-1]], sizes)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out))

    return sums_before


def _mapping():
    """Names and values of all alternatives of a row, cut into a map a position."""

    def maps_of(names: pa.Array, values: pa.Array, sizes: pa.Array) -> pa.Array:
        rows = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(sizes), 0).to_numpy(zero_copy_only=False))))
        ends = np.concatenate(([0], np.cumsum(sizes.flatten().to_numpy(zero_copy_only=False))))
        maps = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), names.flatten(), values.flatten())
        return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), maps)

    return maps_of


def _sums_before():
    cut, summed = steps(), _summing()

    @F.arrow_udf("array<bigint>")
    def sums_before(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in cut(batches):
            yield summed(lists)

    return sums_before


def _maps_of():
    cut, mapped = steps(), _mapping()

    @F.arrow_udf("array<map<string,double>>")
    def maps_of(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for names, values, sizes in cut(batches):
            yield mapped(names, values, sizes)

    return maps_of


_TOKENS = {"tokens": "array<string>", "before": "array<bigint>"}
_TOP = {"top": "array<map<string,double>>"}


def _describer(shared: Broadcast, own: bool, alternatives: bool):
    """In one evaluation, so in one worker a task: of ``own`` ids the tokens and the summed
    lengths before each; of ``alternatives`` (ids, values, numbers) the maps."""
    cut, named, summed, mapped = steps(), decoding(), _summing(), _mapping()
    fields = (_TOKENS if own else {}) | (_TOP if alternatives else {})

    def described(columns: tuple[pa.Array, ...], numbers: np.ndarray, names: pa.Array) -> pa.Array:
        out = []
        if own:
            tokens = named(columns[0], numbers, names)
            lengths = pc.cast(pc.utf8_length(tokens.values), pa.int64())
            out += [tokens, summed(pa.ListArray.from_arrays(tokens.offsets, lengths))]
        if alternatives:
            ids, values, sizes = columns[-3:]
            out.append(mapped(named(ids, numbers, names), values, sizes))
        return pa.StructArray.from_arrays(out, names=list(fields))

    @F.arrow_udf(f"struct<{','.join(f'{k}:{v}' for k, v in fields.items())}>")
    def describe(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        numbers = np.fromiter(shared.value.values(), np.int64, len(shared.value))
        names = pa.array(list(shared.value), pa.string())
        for columns in cut(batches):
            yield described(columns if isinstance(columns, tuple) else (columns,), numbers, names)

    return describe


def _paired(df: DataFrame) -> DataFrame:
    """``token_ids`` and ``logprobs`` cut to the shorter of the two; null counts as empty."""
    ids = F.coalesce("token_ids", F.array().cast("array<int>"))
    maps = F.coalesce("logprobs", F.array().cast(df.schema["logprobs"].dataType))
    n = F.least(F.size(ids), F.size(maps))
    return df.withColumns({"token_ids": F.slice(ids, 1, n), "logprobs": F.slice(maps, 1, n)})


def _named_ids(df: DataFrame, vocab: Vocabulary, ids: str, out: str, broadcast_rows: int) -> DataFrame:
    """Add the tokens of an array of ids, in the row."""
    return decode(df, vocab, ids=ids, key=df.columns, out=out, broadcast_rows=broadcast_rows)


def text_offsets(df: DataFrame, vocab: Vocabulary, *, initial: int = 0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the arrays ``tokens`` and ``text_offset``: for each of ``token_ids`` its
    token, and the summed length of the tokens before it, from ``initial``."""
    if vocab.rows() <= broadcast_rows:
        made = df.withColumn("_made", _describer(vocab.shared, True, False)("token_ids"))
        return _placed(made, initial).drop("_made")
    named = _named_ids(df, vocab, "token_ids", "tokens", broadcast_rows)
    before = _sums_before()(F.transform("tokens", lambda t: F.length(t).cast("bigint")))
    return named.withColumn("text_offset", F.transform(before, lambda at: at + F.lit(initial)))


def _placed(made: DataFrame, initial: int) -> DataFrame:
    return made.withColumns({"tokens": F.col("_made.tokens"), "text_offset": F.transform("_made.before", lambda at: at + F.lit(initial))})


def top_logprobs(df: DataFrame, vocab: Vocabulary, *, k: int | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the array ``top_logprobs``: per position of ``logprobs`` the
    alternatives as a map token -> log-probability, all of them or the ``k``
    likeliest (ties by id); of a position without any, an empty map.

    Alternatives are ranked inside the row's array, named in one array, and cut
    apart again by their numbers.
    """
    flat = _flat(df, k)
    if vocab.rows() <= broadcast_rows:
        made = flat.withColumn("top_logprobs", _describer(vocab.shared, False, True)(*_ALTERNATIVES)["top"])
        return made.drop(*_ALTERNATIVES)
    named = _named_ids(flat, vocab, "_ids", "_names", broadcast_rows)
    return named.withColumn("top_logprobs", _maps_of()("_names", "_values", "_n")).drop(*_ALTERNATIVES, "_names")


_ALTERNATIVES = ("_ids", "_values", "_n")


def _flat(df: DataFrame, k: int | None) -> DataFrame:
    """Add the alternatives of all positions in one array: ids, values, and how many each position has."""
    entries = "array<struct<minus:double,id:int>>"
    ranked = F.transform(
        F.coalesce("logprobs", F.array().cast(df.schema["logprobs"].dataType)),
        lambda m: F.coalesce(
            F.array_sort(F.transform(F.map_entries(m), lambda e: F.struct((-e["value"]).alias("minus"), e["key"].alias("id")))).cast(entries),
            F.array().cast(entries),
        ),
    )
    best = ranked if k is None else F.transform(ranked, lambda alternatives: F.slice(alternatives, 1, k))
    return df.withColumn("_best", best).withColumns(
        {
            "_n": F.transform("_best", lambda alternatives: F.size(alternatives).cast("bigint")),
            "_ids": F.transform(F.flatten("_best"), lambda e: e["id"]),
            "_values": F.transform(F.flatten("_best"), lambda e: -e["minus"]),
        }
    ).drop("_best")


def logprobs_record(
    df: DataFrame, vocab: Vocabulary, *, initial: int = 0, broadcast_rows: int = BROADCAST_ROWS, out: str = "logprobs"
) -> DataFrame:
    """Replace ``logprobs`` by the record of a choice as one nested value, and
    add it as ``out``: ``text_offset``, ``token_logprobs``, ``tokens`` and
    ``top_logprobs``, a value a position each.

    Where ``logprobs`` is null the record is null: none were asked for.  A
    chosen token without a log-probability raises.  No token row is made.
    """
    asked = df.withColumns({"_asked": F.col("logprobs").isNotNull(), "_whole": F.col("token_ids")})
    if vocab.rows() <= broadcast_rows:
        made = _flat(_paired(asked), None).withColumn("_made", _describer(vocab.shared, True, True)("token_ids", *_ALTERNATIVES))
        named = _placed(made, initial).withColumn("top_logprobs", F.col("_made.top"))
    else:
        placed = text_offsets(_paired(asked), vocab, initial=initial, broadcast_rows=broadcast_rows)
        named = top_logprobs(placed, vocab, broadcast_rows=broadcast_rows)
    own = F.transform(F.arrays_zip("token_ids", "logprobs"), lambda z: _chosen(z["logprobs"], z["token_ids"]))
    record = F.struct("text_offset", own.alias("token_logprobs"), "tokens", "top_logprobs")
    kept = [F.col("_whole").alias(c) if c == "token_ids" else F.col(f"`{c}`") for c in df.columns if c not in (out, "logprobs")]
    return named.select(*kept, F.when(F.col("_asked"), record).alias(out))


def next_token_prob(positions: DataFrame, candidates: Sequence[int], *, key: Sequence[str] = CHOICE) -> DataFrame:
    """The probability of each candidate as the very next token; null where
    the result does not list it."""
    wanted = F.array(*[F.lit(c) for c in candidates])
    first = positions.where(F.col("pos") == 0).select(*key, "logprobs", F.explode(wanted).alias("candidate"))
    return first.select(*key, "candidate", F.exp(F.try_element_at("logprobs", F.col("candidate"))).alias("prob"))


def snapshot_delta(df: DataFrame, *, key: Sequence[str] = CHOICE, order: str = "step") -> DataFrame:
    """Cumulative snapshots to what each one adds: ``delta_text``,
    ``delta_ids`` and, where present, ``delta_logprobs``."""
    steps = W.partitionBy(*key).orderBy(order)
    seen_text = F.coalesce(F.lag(F.length("text")).over(steps), F.lit(0))
    seen_ids = F.coalesce(F.lag(F.size("token_ids")).over(steps), F.lit(0))
    marked = df.select("*", seen_text.alias("_chars"), seen_ids.alias("_ids"))

    def rest(column: str):
        return F.slice(column, F.col("_ids") + 1, F.greatest(F.size(column) - F.col("_ids"), F.lit(0)))

    out = [F.expr("substring(text, _chars + 1)").alias("delta_text"), rest("token_ids").alias("delta_ids")]
    if "logprobs" in df.columns:
        out.append(rest("logprobs").alias("delta_logprobs"))
    return marked.select(*key, order, F.col("_chars").cast("bigint").alias("text_offset"), *out)


def assemble_outputs(df: DataFrame, *, only_output: bool = False, key: str = "request_id") -> DataFrame:
    """One row per request with parallel arrays over its choices, by index.

    The prompt precedes each text unless ``only_output``.  ``logprobs``, where
    there are any (see :func:`logprobs_record`), become JSON per choice.
    """
    text = F.col("text") if only_output else F.concat("prompt", "text")
    logprobs = F.to_json("logprobs") if "logprobs" in df.columns else F.lit(None).cast("string")
    choice = F.struct("idx", text.alias("text"), "finish_reason", logprobs.alias("logprobs"))
    grouped = df.groupBy(key).agg(F.sort_array(F.collect_list(choice)).alias("_c"))
    return grouped.select(
        key,
        F.transform("_c", lambda c: c["text"]).alias("text"),
        F.transform("_c", lambda c: c["logprobs"]).alias("logprobs"),
        F.transform("_c", lambda c: c["idx"]).alias("index"),
        F.transform("_c", lambda c: c["finish_reason"]).alias("finish_reason"),
    )


def usage_totals(df: DataFrame, *, key: str = "request_id") -> DataFrame:
    """Prompt tokens (once per request), completion tokens over all choices,
    and their sum."""
    prompt = F.first(F.size("prompt_ids")).cast("bigint")
    completion = F.sum(F.size("token_ids").cast("bigint"))
    return df.groupBy(key).agg(
        prompt.alias("prompt_tokens"),
        completion.alias("completion_tokens"),
        (prompt + completion).alias("total_tokens"),
    )
