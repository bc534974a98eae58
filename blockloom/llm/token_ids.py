"""Token ids of whole texts with a public tokenizer file.

The ids are those of the tokenizers library. Its work on words seen before is
saved: texts of Latin letters and plain punctuation are cut into words by the
tokenizer's own rule, on arrays of code points, and a worker remembers the ids of
words, found by 64-bit hashes, in a table of bounded size. Words not in it, and
all other texts, go through the library.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np

from blockloom.llm.common import _powers, mix

#: Words a worker remembers; at that number it begins anew. Slots of its table.
MAX_WORDS, SLOTS = 1_500_000, 1 << 22
#: Characters of text handled at a time.
CHUNK_CHARS = 1 << 20

# Latin letters up to this point have their categories since the first Unicode
# versions; those whose lower case lies beyond or is longer are left out.
_LAST = 0x24F
_SAFE = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA1, _LAST + 1)) if c != 0xAD and len(chr(c).lower()) == 1 and ord(chr(c).lower()) <= _LAST]
_UNSAFE = re.compile(f"[^{''.join(re.escape(c) for c in _SAFE)}]")

BLANK, LETTER, NUMBER, OTHER = range(4)
_KIND = np.full(_LAST + 1, OTHER, np.uint8)
for _c in _SAFE:
    _KIND[ord(_c)] = BLANK if _c.isspace() else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(_c)[0], OTHER)
_POINT = np.random.default_rng(20240301).integers(0, 2**64, _LAST + 1, dtype=np.uint64) | np.uint64(1)
_APOSTROPHE, _SPACE = ord("'"), 32
#: What may follow an apostrophe to make a word with it, by the tokenizers' rules.
_ONE, _TWO = [ord(c) for c in "stmd"], [(ord("r"), ord("e")), (ord("v"), ord("e")), (ord("l"), ord("l"))]


def _short_forms(points: np.ndarray, kinds: np.ndarray, begins: np.ndarray, joins: bool) -> tuple[np.ndarray, np.ndarray]:
    """Apostrophes that begin a short form, and how many letters it takes.
    With ``joins`` a blank before it takes the apostrophe for itself."""
    n = len(points)
    at = np.flatnonzero(points == _APOSTROPHE)
    at = at[at + 1 < n]
    at = at[(kinds[at + 1] == LETTER) & ~begins[at + 1]]
    before = np.maximum(at - 1, 0)
    first = begins[at]
    at = at[first | ((kinds[before] != OTHER) & ((points[before] != _SPACE) if joins else True))]
    second = np.minimum(at + 2, n - 1)
    two = np.zeros(len(at), bool)
    for a, b in _TWO:
        two |= (points[at + 1] == a) & (points[second] == b) & (at + 2 < n) & ~begins[second]
    one = np.isin(points[at + 1], _ONE)
    size = np.where(one, 1, np.where(two, 2, 0))
    return at[size > 0], size[size > 0]


def _cut(points: np.ndarray, begins: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words. ``begins`` marks each text's first character."""
    n = len(points)
    kinds = _KIND[points]
    change = np.ones(n, bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change |= begins
    blank = kinds == BLANK
    starts = change.copy()
    if rule == "byte_bpe":
        # the last blank before a word stands alone; a plain space joins the word
        after = np.zeros(n, bool)
        after[:-1] = blank[:-1] & ~blank[1:] & ~begins[1:]
        starts |= after
        joined = np.zeros(n, bool)
        joined[1:] = after[:-1] & (points[:-1] == _SPACE)
        starts &= ~joined
    else:
        starts |= kinds == NUMBER
    at, size = _short_forms(points, kinds, begins, rule == "byte_bpe")
    if len(at):
        starts[at] = True
        starts[at + 1] = False
        beyond = at + 1 + size
        inside = beyond < n
        starts[beyond[inside]] |= True
    begin = np.flatnonzero(starts)
    end = np.append(begin[1:], n)
    if rule == "word_bpe":
        words = ~blank[begin]
        begin, end = begin[words], end[words]
    return begin, end


class Encoder:
    """Ids of texts by the tokenizer file at ``path``; ``rule`` names its way of
    cutting words, none if it is unknown: then nothing is remembered."""

    def __init__(self, path: str, rule: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.rule = rule
        self._forget()

    def _forget(self) -> None:
        self.keys, self.codes = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64)
        self.ids, self.starts = array("I"), array("q", [0])

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Codes of known words, -1 of others."""
        slot = (hashes >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)
        seen = self.keys[slot]
        out = np.where(seen == hashes, self.codes[slot], -1)
        open_ = np.flatnonzero((seen != hashes) & (seen != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (SLOTS - 1)
            seen = self.keys[slot[open_]]
            hit = seen == hashes[open_]
            out[open_[hit]] = self.codes[slot[open_[hit]]]
            open_ = open_[~hit & (seen != 0)]
        return out

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Remember the ids of new words, given their different hashes."""
        encoded = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(words)) if len(encoded) else np.zeros(len(words), np.int64)
        base, code = len(self.ids), len(self.starts) - 1
        self.ids.extend(encoded.ids)
        self.starts.extend((base + np.cumsum(counts)).tolist())
        codes = code + np.arange(len(words))
        slot = (hashes >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)
        left = np.arange(len(words))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = hashes[free]  # of several for one slot the last stays
            placed = self.keys[slot[left]] == hashes[left]
            done = left[placed]
            self.codes[slot[done]] = codes[done]
            left = left[~placed]
            slot[left] = (slot[left] + 1) & (SLOTS - 1)

    def _remembered(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.starts) > MAX_WORDS:
            self._forget()
        text = "".join(texts)
        if self.rule == "word_bpe":
            text = text.lower()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(points)
        edges = np.cumsum([0, *map(len, texts)])
        begins = np.zeros(n + 1, bool)
        begins[edges] = True
        begin, end = _cut(points, begins[:n], self.rule) if n else (np.zeros(0, np.int64),) * 2
        power, inverse = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_POINT[points] * power[:n], out=total[1:])
        hashes = mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
        codes = self._find(hashes)
        if len(missing := np.flatnonzero(codes < 0)):
            new, first = np.unique(hashes[missing], return_index=True)
            at = missing[first]
            self._learn(new, [text[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)])
            codes[missing] = self._find(hashes[missing])
        starts, flat = np.frombuffer(self.starts, np.int64), np.frombuffer(self.ids, np.uint32)
        low = starts[codes]
        size = starts[codes + 1] - low
        ends = np.cumsum(size)
        ids = flat[np.repeat(low - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        of_text = np.searchsorted(begin, edges[1:-1])  # first word of the next text
        return np.split(ids, np.concatenate(([0], ends))[of_text])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit numbers, without special tokens."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain: list[int] = []
        size = 0

        def flush() -> None:
            for i, ids in zip(plain, self._remembered([texts[i] for i in plain]), strict=True):
                out[i] = ids
            plain.clear()

        for i, text in enumerate(texts):
            if self.rule is None or _UNSAFE.search(text):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                continue
            plain.append(i)
            size += len(text)
            if size > CHUNK_CHARS:
                flush()
                size = 0
        if plain:
            flush()
        return out


_encoders: dict[tuple[str, str | None], Encoder] = {}


def encoder(path: str, rule: str | None) -> Encoder:
    """The worker's encoder for a file."""
    if (path, rule) not in _encoders:
        _encoders[path, rule] = Encoder(path, rule)
    return _encoders[path, rule]
