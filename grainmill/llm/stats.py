"""Statistics of a text, for many texts at once on arrays of code points."""

from __future__ import annotations

import unicodedata
from functools import cached_property, lru_cache

import numpy as np

from .letters import U64, codepoints, composed, mix, noise_table
from .lexicon import COMMON, COMMON_THAI, CONNECTIVES
from .repetition import repeated_mask
from .pretokens import _BACK, _STEP, WHITE, _power

BLANK, WORD, DIGIT, END, COMMA, SIGN = range(6)
_ENDS = ".!?…。؟۔।॥"
_COMMAS = ",;:،؛'\"’“”«»()-–—"
THAI = (0x0E00, 0x0E7F)
#: Code points on either side that are looked at, and the share of them in common words that sentences reach.
AROUND, PROSY = 60, 0.04

NAMES = ["words", "word_length", "common_share", "digit_share", "sign_share", "ended_lines", "ends_per_word", "line_words", "odd_tokens", "letter_share", "prose_share", "word_variety"]


@lru_cache(1)
def kinds() -> np.ndarray:
    table = np.full(0x110000, SIGN, np.uint8)
    for c in range(0x323B0):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LM":
            table[c] = WORD
        elif kind == "Nd":
            table[c] = DIGIT
        elif kind == "Cf":
            table[c] = BLANK
    table[WHITE] = BLANK
    table[[ord(c) for c in _ENDS]] = END
    table[[ord(c) for c in _COMMAS]] = COMMA
    return table


@lru_cache(1)
def lower_table() -> np.ndarray:
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        low = chr(c).lower()
        table[c] = ord(low[0])
    table[ord("I")] = table[ord("ı")] = ord("i")
    return table


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of code points [start, end)."""
    total = np.zeros(len(codes) + 1, U64)
    np.cumsum(noise_table()[codes] * _power(_STEP, len(codes)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_BACK, len(codes) + 1)[starts] + (ends - starts).astype(U64))


def _word_hashes(words: list[str]) -> np.ndarray:
    codes, at = codepoints(words)
    return np.unique(run_hashes(lower_table()[codes], at[:-1], at[1:]))


@lru_cache(1)
def common_hashes() -> np.ndarray:
    return _word_hashes([w for words in COMMON.values() for w in words.split() if len(w) > 1 or not w.isascii()])


@lru_cache(1)
def connective_hashes() -> np.ndarray:
    return _word_hashes([w for words in CONNECTIVES.values() for w in words.split()])


def among(wanted: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return known[at] == wanted


class Parsed:
    """Words, tokens, lines and classes of the texts in a row. ``more``: hashes of common words besides the listed ones."""

    def __init__(self, texts: list[str | None], more: np.ndarray | None = None) -> None:
        self.known = common_hashes() if more is None or not len(more) else np.union1d(common_hashes(), more)
        raw, self.ends = codepoints([composed(t) for t in texts])
        self.n, self.raw = len(texts), raw
        self.kind = kinds()[raw]
        self.low = lower_table()[raw]
        self.first = np.zeros(len(raw) + 1, bool)
        self.first[self.ends] = True

    @cached_property
    def _words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(self.kind == WORD)

    @cached_property
    def _tokens(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(self.kind != BLANK)

    word_start, word_end = property(lambda self: self._words[0]), property(lambda self: self._words[1])
    token_start, token_end = property(lambda self: self._tokens[0]), property(lambda self: self._tokens[1])

    @cached_property
    def word_text(self) -> np.ndarray:
        return self.owner(self.word_start)

    @cached_property
    def token_text(self) -> np.ndarray:
        return self.owner(self.token_start)

    @cached_property
    def word_hash(self) -> np.ndarray:
        return run_hashes(self.low, self.word_start, self.word_end)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximal runs of True that stay within a text."""
        if not len(inside):
            return (np.zeros(0, np.int64),) * 2
        before = np.r_[False, inside[:-1]]
        after = np.r_[inside[1:], False]
        start = inside & (~before | self.first[:-1])
        end = inside & (~after | self.first[1:])
        return np.flatnonzero(start), np.flatnonzero(end) + 1

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right") - 1

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum over each text's code points."""
        total = np.r_[0, np.cumsum(flags)]
        return total[self.ends[1:]] - total[self.ends[:-1]]

    def count(self, owner: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owner, weights=weights, minlength=self.n)

    def odd(self) -> np.ndarray:
        """Which tokens hold a sign, or letters and digits together."""
        return self._odd

    @cached_property
    def _odd(self) -> np.ndarray:
        sums = [np.r_[0, np.cumsum(self.kind == k)] for k in (SIGN, DIGIT, WORD)]
        sign, digit, word = (s[self.token_end] - s[self.token_start] for s in sums)
        return (sign > 0) | ((digit > 0) & (word > 0))

    def common_words(self, odd: np.ndarray) -> np.ndarray:
        """Which words are common ones and stand in a plain token."""
        if not len(self.word_start):
            return np.zeros(0, bool)
        token = np.searchsorted(self.token_start, self.word_start, side="right") - 1
        quoted = np.isin(self.raw[np.maximum(self.word_start - 1, 0)], [0x27, 0x2019]) & (self.word_start > self.ends[self.word_text])
        return among(self.word_hash, self.known) & ~odd[token] & ~quoted  # "ve" after an apostrophe is no word

    def prosy(self, common: np.ndarray, thai: np.ndarray) -> np.ndarray:
        """Which solid code points have common words around them, as every sentence does."""
        hit = thai.astype(np.int64)
        for a, b in ((self.word_start[common], 1), (self.word_end[common], -1)):
            step = np.zeros(len(self.raw) + 1, np.int64)
            np.add.at(step, a, b)
            hit += np.cumsum(step)[:-1]
        solid = np.flatnonzero(self.kind != BLANK)
        total = np.r_[0, np.cumsum(hit[solid] > 0)]
        ends = np.searchsorted(solid, self.ends)
        sizes = np.diff(ends)
        low = np.maximum(np.arange(len(solid)) - AROUND, np.repeat(ends[:-1], sizes))
        high = np.minimum(np.arange(len(solid)) + AROUND + 1, np.repeat(ends[1:], sizes))
        out = np.zeros(len(self.raw), bool)
        signs = np.r_[0, np.cumsum(self.kind == SIGN)]
        plain = np.repeat(signs[self.token_end] == signs[self.token_start], self.token_end - self.token_start)  # tokens are the solid code points
        plain |= (self.raw[solid] >= THAI[0]) & (self.raw[solid] <= THAI[1])  # a Thai token is a whole sentence
        out[solid] = plain & ((total[high] - total[low]) >= PROSY * (high - low))
        return out

    def fresh(self, run: int = 12) -> np.ndarray:
        """Code points outside of what the text repeats: a repeated phrase weighs once."""
        at = np.flatnonzero((self.kind == WORD) | (self.kind == DIGIT))
        out = np.ones(len(self.raw), bool)
        out[at] = ~repeated_mask(self.low[at], np.searchsorted(at, self.ends), run)
        return out

    def thai_common(self) -> np.ndarray:
        """Code points of Thai that lie in a common word."""
        return self._thai_common

    @cached_property
    def _thai_common(self) -> np.ndarray:
        covered = np.zeros(len(self.raw) + 1, np.int64)
        thai = (self.raw >= THAI[0]) & (self.raw <= THAI[1])
        if thai.any():
            for word in COMMON_THAI.split():
                k = len(word)
                hit = np.ones(max(0, len(self.raw) - k + 1), bool)
                for j, ch in enumerate(word):
                    hit &= self.raw[j : len(self.raw) - k + 1 + j] == ord(ch)
                at = np.flatnonzero(hit)
                np.add.at(covered, at, 1)
                np.add.at(covered, at + k, -1)
        return np.cumsum(covered)[:-1] > 0


def _part(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.asarray(b) > 0)


#: Letters of common words stand for this many letters of Thai text as common words do for words elsewhere.
_THAI_WORD = 3.6


def _word_counts(p: Parsed) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By text words outside of Thai, all words, common words, and which tokens are odd."""
    thai = (p.raw >= THAI[0]) & (p.raw <= THAI[1])
    is_thai_word = thai[p.word_start] if len(p.word_start) else np.zeros(0, bool)
    other = p.count(p.word_text, (~is_thai_word).astype(float))
    odd = p.odd()
    common = p.count(p.word_text, p.common_words(odd).astype(float)) + p.per_text(p.thai_common()) / _THAI_WORD
    return other, other + p.per_text(thai & (p.kind == WORD)) / _THAI_WORD, common, odd


def prose_shares(p: Parsed) -> tuple[np.ndarray, np.ndarray]:
    """``common_share`` and ``prose_share`` of ``statistics`` alone."""
    _, words, common, _ = _word_counts(p)
    return _part(common, words), _prose_share(p)


def _prose_share(p: Parsed) -> np.ndarray:
    fresh = p.fresh()
    prose = p.per_text(p.prosy(p.common_words(p.odd()), p.thai_common()) & fresh)
    return _part(prose, p.per_text((p.kind != BLANK) & fresh))


def statistics(p: Parsed) -> np.ndarray:
    """One row of the NAMES statistics per text; a text without words has zeros."""
    solid = p.per_text(p.kind != BLANK)
    letters = p.per_text(p.kind == WORD)
    n_thai = p.per_text((p.raw >= THAI[0]) & (p.raw <= THAI[1]) & (p.kind == WORD))
    other_words, words, common, odd = _word_counts(p)
    common_share, prose_share = _part(common, words), _prose_share(p)
    lines_start, lines_end = p.runs(p.raw != 10)
    filled = _filled(p, lines_start, lines_end)
    lines_start, lines_end = lines_start[filled], lines_end[filled]
    line_text = p.owner(lines_start)
    lines = p.count(line_text)
    last = _last_solid(p, lines_end)
    ended = p.count(line_text, (p.kind[last] == END).astype(float)) if len(last) else np.zeros(p.n)
    stops = _sentence_ends(p)
    tokens = p.count(p.token_text)
    return np.stack([
        np.log1p(words), _part(letters - n_thai, other_words), common_share, _part(p.per_text(p.kind == DIGIT), solid), _part(p.per_text(p.kind == SIGN), solid),
        _part(ended, lines), _part(stops, words), np.log1p(_part(words, lines)), _part(p.count(p.token_text, odd.astype(float)), tokens), _part(letters, solid), prose_share, _part(_distinct_words(p), p.count(p.word_text)),
    ], axis=1)


def _filled(p: Parsed, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    solid = np.r_[0, np.cumsum(p.kind != BLANK)]
    return solid[end] > solid[start]


def _last_solid(p: Parsed, ends: np.ndarray) -> np.ndarray:
    """Place of the last code point before each end that is no blank."""
    if not len(p.raw):
        return ends
    seen = np.maximum.accumulate(np.where(p.kind != BLANK, np.arange(len(p.raw)), 0))
    return seen[ends - 1]


def _sentence_ends(p: Parsed) -> np.ndarray:
    """Terminal marks after a word and before a blank or the text's end."""
    if not len(p.raw):
        return np.zeros(p.n)
    end = p.kind == END
    before = np.r_[False, (p.kind[:-1] == WORD) | (p.kind[:-1] == BLANK)]
    after = np.r_[p.kind[1:] == BLANK, True] | p.first[1:]
    return p.per_text(end & before & after)


def _distinct_words(p: Parsed) -> np.ndarray:
    if not len(p.word_hash):
        return np.zeros(p.n)
    order = np.lexsort((p.word_hash, p.word_text))
    h, t = p.word_hash[order], p.word_text[order]
    return p.count(t[np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])]])
