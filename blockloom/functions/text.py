"""Column expressions over text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special tokens in id order (ids 0..3), the label that the loss
# ignores and the text shown for it.
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>", "<pad>")
UNK_ID, BOS_ID, EOS_ID, PAD_ID = 0, 1, 2, 3
BOS, EOS = "<s>", "</s>"
IGNORE = -100
IGNORED_TEXT = "igx"

# The prompt markup and its default system message.
SYSTEM_MESSAGE = "You are a helpful assistant. 你是一个乐于助人的助手。"
PROMPT_OPEN = "[INST] <<SYS>>\n"
PROMPT_MIDDLE = "\n<</SYS>>\n\n"
PROMPT_CLOSE = " [/INST]"
# The closing mark measured on its own starts a text, so its blank is left out.
PROMPT_SUFFIX = "[/INST]"

TOKEN_SEPARATOR = "[ \n]+"


def tokens(text: Column) -> Column:
    """Split a text at blanks and newlines; never yields empty tokens."""
    return F.filter(F.split(text, TOKEN_SEPARATOR), lambda t: t != "")


def text_pieces(text: Column, sample_by: str = "line", keep_linebreaks: bool = False) -> Column:
    """A text as an array of lines, paragraphs, or as one document."""
    _check_sample_by(sample_by)
    if sample_by == "document":
        return F.array(text)
    if sample_by == "paragraph":
        return F.filter(F.split(text, "\n\n"), lambda p: p != "")
    # A newline at the very end closes the last line; it opens no further one.
    if keep_linebreaks:
        return F.filter(F.split(text, r"(?<=\n)"), lambda p: p != "")
    closed = F.endswith(text, F.lit("\n"))
    body = F.when(closed, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n"))


def count_pieces(text: Column, sample_by: str = "line") -> Column:
    """How many pieces :func:`text_pieces` yields; lines are not split for it."""
    _check_sample_by(sample_by)
    if sample_by != "line":
        return F.size(text_pieces(text, sample_by))
    newlines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    unclosed = (text != "") & ~F.endswith(text, F.lit("\n"))
    return newlines + unclosed.cast("int")


def _check_sample_by(sample_by: str) -> None:
    if sample_by not in ("line", "paragraph", "document"):
        raise ValueError(f"sample_by must be line, paragraph or document, not {sample_by!r}")


def merge_input(instruction: Column, extra: Column) -> Column:
    """Instruction, with a non-empty extra input on its own line below."""
    present = F.coalesce(extra, F.lit("")) != ""
    return F.when(present, F.concat(instruction, F.lit("\n"), extra)).otherwise(instruction)


def render_prompt(instruction: Column, system: str | Column = SYSTEM_MESSAGE) -> Column:
    """The instruction inside the prompt markup (plain concatenation, so ``%``
    and braces in the text stay as they are)."""
    system = F.lit(system) if isinstance(system, str) else system
    return F.concat(F.lit(PROMPT_OPEN), system, F.lit(PROMPT_MIDDLE), instruction, F.lit(PROMPT_CLOSE))


def output_text(output: Column) -> Column:
    """The answer's text; a missing answer reads ``None``."""
    return F.coalesce(output, F.lit("None"))


def url_decode(text: Column) -> Column:
    """Percent-decoding that leaves ``+`` and stray percent signs alone."""
    safe = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(safe, F.lit("+"), F.lit("%2B"))), text)


def name_prefix(name: Column) -> Column:
    """The part of a name before the first underscore."""
    return F.split_part(name, F.lit("_"), F.lit(1))


def file_stem(path: Column) -> Column:
    """File name without folders and without its last suffix."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def thousands(value: Column) -> Column:
    """An integer with thousands separators."""
    return F.format_number(value, 0)


def millions(value: Column) -> Column:
    return value / F.lit(1e6)
