"""Texts as flat arrays of letters, the common ground of the record-matching operators.

"Letters" are letters, combining marks and digits. Case is ignored, the dotted and dotless i of Turkish
fold to one letter, and texts are compared in composed form (NFC). All work is done on one array per
batch of texts, so that the Python interpreter is entered per batch and not per character.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

U64 = np.uint64
DOT_ABOVE = 0x307
#: Characters worked on at a time; bounds the memory of a worker whatever the lengths of the texts.
SLICE_CHARS = 600_000


@lru_cache(1)
def fold_table() -> np.ndarray:
    """By code point its folded letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in [*range(0x20000), *range(0xE0100, 0xE01F0)]:
        ch = chr(c)
        kind = unicodedata.category(ch)
        if kind[0] in "LM" or kind == "Nd":
            low = ch.lower()
            table[c] = ord(low[0]) if len(low) > 1 else ord(low)
    table[0x20000:0x323B0] = np.arange(0x20000, 0x323B0, dtype=np.uint32)
    for ch in "Iıİi":
        table[ord(ch)] = ord("i")
    return table


@lru_cache(1)
def noise_table() -> np.ndarray:
    """A fixed random 64-bit number for each code point."""
    return mix(np.arange(0x110000, dtype=U64) + U64(0x1D8AF066))


def mix(x: np.ndarray) -> np.ndarray:
    """Stafford's 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in a row, and the place where each text begins (one more for the end)."""
    ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), ends


def composed(text: str | None) -> str:
    if text is None:
        return ""
    return text if text.isascii() or unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters of the texts in a row, and where each text's begin. Null counts as empty."""
    raw, ends = codepoints([composed(t) for t in texts])
    folded = fold_table()[raw]
    if (raw == DOT_ABOVE).any():  # the lower case of a dotted capital I may have left its dot behind
        after_i = np.zeros(len(raw), bool)
        after_i[1:] = (raw[1:] == DOT_ABOVE) & (folded[:-1] == ord("i"))
        after_i[ends[:-1][ends[:-1] < len(raw)]] = False
        folded = np.where(after_i, np.uint32(0), folded)
    keep = folded != 0
    kept_before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(keep, out=kept_before[1:])
    return folded[keep], kept_before[ends]


def slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` characters in all; a longer text stands alone."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of the k letters from each place on; built by doubling, so log(k) passes."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    base = 0x9E3779B97F4A7C15
    power, width = noise_table()[codes], 1
    out, done = None, 0
    while True:
        if k & width:
            out, done = (power, width) if out is None else (_join(power, width, out, done, base), done + width)
        if done == k:
            return out[:n]
        power, width = _join(power, width, power, width, base), width * 2


def _join(a: np.ndarray, wide: int, b: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of a run of ``wide`` letters followed by one of ``width``."""
    n = min(len(a), len(b) - wide)
    return a[:n] * U64(pow(base, width, 1 << 64)) + b[wide : wide + n]


def gram_owner(ends: np.ndarray, k: int, n_letters: int) -> tuple[np.ndarray, np.ndarray]:
    """The places at which a run of k letters lies within one text, and the number of that text."""
    counts = np.maximum(np.diff(ends) - k + 1, 0)
    owner = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
    first = np.cumsum(counts) - counts
    place = np.arange(len(owner), dtype=np.int64) - np.repeat(first, counts) + np.repeat(ends[:-1], counts)
    return place, owner
