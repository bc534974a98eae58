"""Request tables: prompts, length checks, validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.functions import text as T


def fold_system(df: DataFrame, *, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """The last system message of each conversation."""
    is_system = F.col("role") == "system"
    last = F.max_by(F.when(is_system, F.col("text")), F.when(is_system, F.col(order)))
    return df.groupBy(key).agg(last.alias("system_text"))


def chat_prompts(df: DataFrame, *, key: str = "conv_id", order: str = "turn", system: str = T.SYSTEM_MESSAGE) -> DataFrame:
    """Message rows to one prompt per conversation.

    The last system message replaces the default one.  User turns and
    assistant turns follow in order (no alternation is asked for), and the
    prompt ends where the assistant is to go on.  A row without a role is a
    ready prompt and is used as it is; an unknown role raises.
    """
    role = F.col("role")
    bad = F.raise_error(F.concat(F.lit("Unknown role: "), role)).cast("string")
    # User text goes into the instruction markup, assistant text ends in eos.
    turn = (
        F.when(role == "user", F.concat(F.lit("[INST] "), F.col("text"), F.lit(T.PROMPT_CLOSE)))
        .when(role == "assistant", F.concat(F.lit(" "), F.col("text"), F.lit(" " + T.EOS)))
        .otherwise(bad)
    )
    is_system = role == "system"
    is_turn = role.isNotNull() & ~is_system
    # Aggregates skip the nulls that a missing ``otherwise`` yields.
    grouped = df.groupBy(key).agg(
        F.max(F.when(role.isNull(), F.col("text"))).alias("_plain"),
        F.max_by(F.when(is_system, F.col("text")), F.when(is_system, F.col(order))).alias("_system"),
        F.sort_array(F.collect_list(F.when(is_turn, F.struct(order, turn.alias("m"))))).alias("_turns"),
    )
    turns = grouped.select(
        key,
        "_plain",
        F.concat(F.lit("[INST] <<SYS>>\n"), F.coalesce("_system", F.lit(system)), F.lit(T.PROMPT_MIDDLE)).alias("_head"),
        F.array_join(F.transform("_turns", lambda t: t["m"]), "").alias("_body"),
    )
    # The system message shares the markup of a first user turn.
    shared = F.concat("_head", F.expr("substring(_body, 8)"))
    alone = F.concat("_head", F.lit(T.PROMPT_SUFFIX), "_body")
    built = F.when(F.startswith("_body", F.lit("[INST] ")), shared).otherwise(alone)
    return turns.select(key, F.coalesce("_plain", built).alias("prompt"))


# The wording of the answers to requests that break a rule.
UNKNOWN_MODEL = ("The model `", "` does not exist.")
NO_ECHO = "echo is not currently supported"
NO_SUFFIX = "suffix is not currently supported"
NO_BIAS = "logit_bias is not currently supported"
NO_PROMPT = "please provide at least one prompt"
MANY_PROMPTS = "multiple prompts in a batch is not currently supported"


def _too_long(n: Column, wanted: Column, limit: int) -> Column:
    # Fixed wording, like the above.
    return F.concat(
        F.lit(f"This model's maximum context length is {limit} tokens. However, you requested "),
        (n + wanted).cast("string"),
        F.lit(" tokens ("),
        n.cast("string"),
        F.lit(" in the messages, "),
        wanted.cast("string"),
        F.lit(" in the completion). Please reduce the length of the messages or completion."),
    )


def context_fit(
    df: DataFrame, *, limit: int, ids: str = "input_ids", max_tokens: str = "max_tokens", key: Sequence[str] = ()
) -> DataFrame:
    """Whether prompt tokens plus requested tokens fit the model's length.

    ``df`` holds encoded prompts.  The message names both numbers.
    """
    n = F.size(ids).cast("bigint")
    wanted = F.col(max_tokens).cast("bigint")
    fits = n + wanted <= limit
    return df.select(
        *key,
        n.alias("n_prompt"),
        wanted.alias("n_requested"),
        fits.alias("fits"),
        F.when(~fits, _too_long(n, wanted, limit)).alias("message"),
    )


def _first_failure(rules: Sequence[tuple[Column, int, Column]]) -> tuple[Column, Column]:
    status, message = F.lit(200), F.lit(None).cast("string")
    for failed, code, text in reversed(rules):
        failed = F.coalesce(failed, F.lit(False))
        status = F.when(failed, F.lit(code)).otherwise(status)
        message = F.when(failed, text).otherwise(message)
    return status, message


def request_status(df: DataFrame, *, served: str, limit: int) -> DataFrame:
    """Add ``status`` and ``message``: the first rule a request breaks.

    Columns: ``endpoint`` (chat or completion), ``model``, ``logit_bias``,
    ``echo``, ``suffix``, ``prompts`` (array, null for a plain string),
    ``n_prompt``, ``max_tokens``.  Chat requests are checked for model, bias
    and length; completions for model, echo, suffix, bias and the number of
    prompts, but not for length.
    """
    chat = F.col("endpoint") == "chat"
    model = F.coalesce(F.col("model") != served, F.lit(True))
    n, wanted = F.col("n_prompt"), F.col("max_tokens")
    rules = [
        (model, 404, F.concat(F.lit(UNKNOWN_MODEL[0]), F.col("model"), F.lit(UNKNOWN_MODEL[1]))),
        (~chat & F.col("echo"), 400, F.lit(NO_ECHO)),
        (~chat & F.col("suffix").isNotNull(), 400, F.lit(NO_SUFFIX)),
        (F.col("logit_bias").isNotNull(), 400, F.lit(NO_BIAS)),
        (~chat & (F.size("prompts") == 0), 400, F.lit(NO_PROMPT)),
        (~chat & (F.size("prompts") > 1), 400, F.lit(MANY_PROMPTS)),
        (chat & (n + wanted > limit), 400, _too_long(n, wanted, limit)),
    ]
    status, message = _first_failure(rules)
    return df.select("*", status.alias("status"), message.alias("message"))
