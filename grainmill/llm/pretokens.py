"""Byte-level BPE pre-tokens of many texts at once.

The boundaries are those of the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``,
worked out on arrays of character classes: runs of a class, a single blank going to the run after it, all but
the last of several blanks staying behind, and the contractions after an apostrophe.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

from .letters import U64, codepoints, mix, noise_table

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: The code points with the property White_Space; fixed values.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What may follow the apostrophe of a contraction; fixed values.
SUFFIXES = ["s", "t", "re", "ve", "m", "ll", "d"]
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


@lru_cache(1)
def classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x20000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            table[c] = LETTER if kind == "L" else NUMBER
    for c in range(0x20000, 0x323B0):
        if unicodedata.category(chr(c))[0] == "L":
            table[c] = LETTER
    table[WHITE] = SPACE
    return table


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        made = np.full(max(n, 1 << 16), base, U64)
        made[0] = 1
        _powers[base] = np.multiply.accumulate(made)
    return _powers[base][:n]


def cut(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The joined texts, the starts of all pre-tokens (and the end), each text's first pre-token, each pre-token's hash."""
    raw, ends = codepoints(texts)
    n = len(raw)
    kind = classes()[raw]
    start = np.zeros(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start[ends] = True
    run = np.flatnonzero(start)  # runs of one class within a text
    first_of_text = np.zeros(n + 1, bool)
    first_of_text[ends] = True
    head, length = run[:-1], np.diff(run)
    if n:
        blank = raw == 0x20
        kinds = kind[head]
        joined = head[(kinds != SPACE) & ~first_of_text[head]]
        joined = joined[blank[joined - 1]]
        start[joined] = False  # the blank before a run belongs to it
        many = (kinds == SPACE) & (length > 1) & ~first_of_text[head + length]
        start[(head + length - 1)[many]] = True
        quote = np.flatnonzero((kinds == OTHER) & (length == 1) & (raw[head] == 0x27) & start[head])
        quote = quote[quote + 1 < len(head)]
        quote = quote[(kinds[quote + 1] == LETTER) & ~first_of_text[head[quote + 1]]]
        if len(quote):
            _contractions(raw, start, head[quote + 1], length[quote + 1])
    at = np.flatnonzero(start)
    powers = _power(_STEP, n)
    total = np.zeros(n + 1, U64)
    np.cumsum(noise_table()[raw] * powers, out=total[1:])
    hashes = mix((total[at[1:]] - total[at[:-1]]) * _power(_BACK, n + 1)[at[:-1]] + np.diff(at).astype(U64))
    return "".join(texts), at, np.searchsorted(at, ends), hashes


def _contractions(raw: np.ndarray, start: np.ndarray, word: np.ndarray, length: np.ndarray) -> None:
    open_ = np.ones(len(word), bool)
    for suffix in SUFFIXES:
        k = len(suffix)
        fits = open_ & (length >= k)
        for j, ch in enumerate(suffix):
            fits[fits] = raw[word[fits] + j] == ord(ch)
        start[word[fits]] = False
        start[word[fits & (length > k)] + k] = True
        open_ &= ~fits
