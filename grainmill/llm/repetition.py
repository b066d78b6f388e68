"""Repetition inside a text, measured by n-gram perplexity.

Spark counts a modified Kneser-Ney model over letter trigrams for each language, over the whole corpus; it is kept as
sorted arrays. Letters are hashed to ``SYMBOLS`` symbols (one to one within the alphabets at hand), so a language has at
most SYMBOLS**3 trigrams, however large the corpus and whatever its scripts: nothing is pruned. Scoring a text
interpolates a history order on top: after ``CONTEXT`` letters that already stood in the same text, the letters that
followed them there are expected. Repeated content costs almost no bits, so where much of a text is repeated its
perplexity falls below the lower band of its language. The bands come from the texts without repeated runs, so they
don't move with the number of texts that repeat; perplexity without history above the upper band is letter salad. What
lies in the lower band's reach is then checked exactly by the share of letters in runs of ``RUN`` or more that already
stood earlier in the same text.

Defined results: null texts and texts without letters have share 0 and no perplexity; a run is letters only, so
blanks, case and punctuation don't hide a repetition; null languages are judged by their script.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread
from .frames import lang_code, map_texts, named
from .letters import gram_hashes, gram_owner, letters, slices

RUN, FOUND_SHARE = 30, 0.4
CONTEXT = 11
#: Bits of a symbol; a model has at most 2**(3 * BITS) trigrams of 16 bytes.
_BITS = np.int64(7)
SYMBOLS = 128
MARGIN = 0.15
#: A text is low if its bits with history are at most this part of what they are without; a text without repeats keeps all.
LOWER = 1 - FOUND_SHARE + MARGIN
#: Texts are checked exactly from this part of the usual bits of their language on; a fourth of FOUND_SHARE is enough.
REACH = 1 - FOUND_SHARE / 4
UPPER_QUANTILE = 0.995
LANGS = ["it", "tr", "ar", "hi", "th", "und"]
_START = np.int64(0)  # stands before a text


@lru_cache(1)
def symbol_table() -> np.ndarray:
    """By code point its symbol: a to z, the ten digits, and 91 for all other letters in turn."""
    table = (37 + np.arange(0x110000) % 91).astype(np.int64)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[ord("0") : ord("9") + 1] = np.arange(27, 37)
    return table


def trigrams(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Packed (two letters before, letter) of each place, the text's start standing for missing ones."""
    c = symbol_table()[codes]
    one, two = np.full(len(c), _START), np.full(len(c), _START)
    one[1:], two[2:] = c[:-1], c[:-2]
    first = ends[:-1][np.diff(ends) > 0]
    one[first] = two[first] = _START
    two[first[first + 1 < len(c)] + 1] = _START
    second = first + 1
    second = second[second < len(c)]
    two[second] = _START
    return (two << 2 * _BITS) | (one << _BITS) | c


def count_trigrams(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, gram, n`` over the whole corpus; every task adds up its own before the shuffle."""
    size = SYMBOLS**3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for start, end in slices(texts):
                codes, ends = letters(texts[start:end])
                grams, of = trigrams(codes, ends), np.repeat(languages(langs[start:end], codes, ends), np.diff(ends))
                for k in np.unique(of).tolist():
                    totals[k] = totals.get(k, 0) + np.bincount(grams[of == k], minlength=size)
        for k, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(some), pa.array(total[some])], ["lang", "gram", "n"])

    return spread(_texts(df, text_col, lang_col)).mapInArrow(run, "lang int, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _texts(df: DataFrame, text_col: str, lang_col: str, **more: str) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in more.items()), lang_code(F.col(f"`{lang_col}`")).alias("lang"), F.col(f"`{text_col}`").alias("text"))


#: First code point of a script's letters, its last, and the language that stands for it; fixed values.
SCRIPTS = [(0x0600, 0x077F, "ar"), (0x0900, 0x097F, "hi"), (0x0E00, 0x0E7F, "th")]


def languages(langs: list[str], codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number in LANGS of each text: its script's, else what its code says if that is of the Latin script."""
    out = np.array([LANGS.index(x) if x in ("it", "tr") else len(LANGS) - 1 for x in langs], np.int64)
    n = np.maximum(np.diff(ends), 1)
    for low, high, name in SCRIPTS:
        out[_sums((codes >= low) & (codes <= high), ends) > 0.5 * n] = LANGS.index(name)
    return out


def _add(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kept, where = np.unique(grams, return_inverse=True)
    return kept, np.bincount(where, weights=counts, minlength=len(kept)).astype(np.int64)


class KneserNey:
    """Interpolated modified Kneser-Ney over letter trigrams in sorted arrays of packed grams."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(grams)
        self.tri, n3 = grams[order], counts[order]
        low = (np.int64(1) << 2 * _BITS) - 1
        self.bi, n2 = _add(self.tri & low, np.ones(len(n3), np.int64))  # continuation counts
        self.uni, n1 = _add(self.bi & ((np.int64(1) << _BITS) - 1), np.ones(len(n2), np.int64))
        self.floor = 1.0 / (len(self.uni) + 1)
        p1 = np.maximum(n1 - 0.5, 0) / max(1, n1.sum()) + 0.5 * len(n1) / max(1, n1.sum()) * self.floor
        self.lost1 = 0.5 * len(n1) / max(1, n1.sum()) * self.floor if len(n1) else 1.0
        self.log1 = p1
        self.ctx2, self.gamma2, p2 = self._order(self.bi, n2, self._p1(self.bi))
        self.p2 = p2
        self.ctx3, self.gamma3, p3 = self._order(self.tri, n3, self._p2(self.tri & low))
        self.p3 = np.log2(p3) if len(p3) else p3

    @staticmethod
    def discounts(n: np.ndarray) -> np.ndarray:
        """By count (0, 1, 2, 3 and more) the discount of Chen and Goodman."""
        t = [max(1, int((n == k).sum())) for k in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1])
        d = [k - (k + 1) * y * t[k] / t[k - 1] for k in (1, 2, 3)]
        return np.array([0.0, *(min(max(x, 0.1), k - 0.1) for k, x in zip((1, 2, 3), d))])

    def _order(self, grams: np.ndarray, n: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ctx, where = np.unique(grams >> _BITS, return_inverse=True)
        d = self.discounts(n)[np.minimum(n, 3)]
        total = np.bincount(where, weights=n, minlength=len(ctx))
        gamma = np.bincount(where, weights=d, minlength=len(ctx)) / np.maximum(total, 1)
        return ctx, gamma, (n - d) / total[where] + gamma[where] * lower if len(n) else np.zeros(0)

    @staticmethod
    def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
        if not len(keys):
            return np.full(len(wanted), missing)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], missing)

    def _p1(self, bi: np.ndarray) -> np.ndarray:
        return self._find(self.uni, self.log1, bi & ((np.int64(1) << _BITS) - 1), self.lost1)

    def _p2(self, bi: np.ndarray) -> np.ndarray:
        p = self._find(self.bi, self.p2, bi, -1.0)
        gone = p < 0
        p[gone] = self._find(self.ctx2, self.gamma2, bi[gone] >> _BITS, 1.0) * self._p1(bi[gone])
        return p

    def log2p(self, grams: np.ndarray) -> np.ndarray:
        """Log2 probability of each packed gram's last letter after its first two."""
        own, where = np.unique(grams, return_inverse=True)
        p = self._find(self.tri, self.p3, own, 1.0)
        gone = p > 0
        low = (np.int64(1) << 2 * _BITS) - 1
        p[gone] = np.log2(self._find(self.ctx3, self.gamma3, own[gone] >> _BITS, 1.0) * self._p2(own[gone] & low))
        return p[where]


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[KneserNey]:
    """A model for each of LANGS from all trigrams of the corpus."""
    rows = count_trigrams(df, text_col, lang_col).toArrow()
    of, grams, n = (rows.column(c).to_numpy() for c in ("lang", "gram", "n"))
    return [KneserNey(grams[of == k], n[of == k]) for k in range(len(LANGS))]


def _ranks(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often each (owner, key) stood before, in order of places; the sorting order; where its groups begin."""
    order = np.argsort(key ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    k, o = key[order], owner[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    rank = np.empty(len(k), np.int64)
    rank[order] = np.arange(len(k)) - start
    return rank, order, new


def history_share(codes: np.ndarray, ends: np.ndarray, base: np.ndarray, discount: float = 0.3) -> np.ndarray:
    """Log2 probability of each letter with the text's own history on top of ``base``."""
    out = base.copy()
    place, owner = gram_owner(ends, CONTEXT + 1, len(codes))
    if not len(place):
        return out
    ctx, full = gram_hashes(codes, CONTEXT)[place], gram_hashes(codes, CONTEXT + 1)[place]
    before, order, new = _ranks(ctx, owner)
    seen = np.flatnonzero(before > 0)
    if not len(seen):
        return out
    group = np.empty(len(place), np.int64)
    group[order] = np.cumsum(new)
    often = np.bincount(group)[group] > 1  # only contexts that stand more than once
    sub = np.flatnonzero(often)
    same, _, _ = _ranks(full[sub], owner[sub])
    # distinct followers of a context so far: first occurrences among its places before this one
    fresh = (same == 0).astype(np.int64)
    by = np.argsort(group[sub], kind="stable")
    run = np.cumsum(fresh[by]) - fresh[by]
    head = np.r_[True, group[sub][by][1:] != group[sub][by][:-1]]
    run -= np.maximum.accumulate(np.where(head, run, 0))
    followers = np.empty(len(sub), np.int64)
    followers[by] = run
    n = before[sub]
    use = n > 0
    at = place[sub][use] + CONTEXT
    p = (np.maximum(same[use] - discount, 0) + discount * np.maximum(followers[use], 1) * np.exp2(base[at])) / n[use]
    out[at] = np.log2(np.minimum(np.maximum(p, 1e-9), 1.0))
    return out


def repeated_mask(codes: np.ndarray, ends: np.ndarray, run: int = RUN) -> np.ndarray:
    """Which letters lie in runs of ``run`` or more that already stood earlier in the same text."""
    place, owner = gram_owner(ends, run, len(codes))
    if not len(place):
        return np.zeros(len(codes), bool)
    before, _, _ = _ranks(gram_hashes(codes, run)[place], owner)
    edge = np.zeros(len(codes) + run + 1, np.int64)
    again = place[before > 0]
    np.add.at(edge, again, 1)
    np.add.at(edge, again + run, -1)
    return np.cumsum(edge)[: len(codes)] > 0


def repeated_letters(codes: np.ndarray, ends: np.ndarray, run: int = RUN) -> np.ndarray:
    """Per text, how many letters ``repeated_mask`` marks."""
    total = np.r_[0, np.cumsum(repeated_mask(codes, ends, run))]
    return total[ends[1:]] - total[ends[:-1]]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.r_[0.0, np.cumsum(values)]
    return total[ends[1:]] - total[ends[:-1]]


def scores(df: DataFrame, models: list[KneserNey], id_col: str = "rec_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``rec_id, band_lang, n_letters, base_bits, bits, repeated``: bits per letter without and with history."""
    shared = df.sparkSession.sparkContext.broadcast(models)

    def work(rest: dict, texts: list) -> dict:
        codes, ends = letters(texts)
        n = np.diff(ends)
        lang = languages(rest["lang"].to_pylist(), codes, ends)
        of, grams, base = np.repeat(lang, n), trigrams(codes, ends), np.zeros(len(codes))
        for k in np.unique(of).tolist():
            base[of == k] = shared.value[k].log2p(grams[of == k])
        full = history_share(codes, ends, base)
        some, none = np.maximum(n, 1), n == 0
        names = pa.array([LANGS[k] for k in lang.tolist()], pa.string())
        return {"rec_id": rest["rec_id"], "band_lang": names, "n_letters": pa.array(n), "base_bits": pa.array(-_sums(base, ends) / some, mask=none), "bits": pa.array(-_sums(full, ends) / some, mask=none), "repeated": pa.array(repeated_letters(codes, ends))}

    return map_texts(_texts(df, text_col, lang_col, rec_id=id_col), work, "rec_id bigint, band_lang string, n_letters bigint, base_bits double, bits double, repeated bigint")


def bands(scored: DataFrame) -> DataFrame:
    """``band_lang, upper, usual_kept, usual_bits``: the upper band of the bits without history, and the medians of the
    texts without repeated runs: the part of their bits that history leaves, and the bits with history."""
    kept = F.try_divide("bits", "base_bits")
    once = lambda c: F.percentile_approx(F.when(F.col("repeated") == 0, c), 0.5)
    return scored.where("n_letters >= 30").groupBy("band_lang").agg(F.percentile_approx("base_bits", UPPER_QUANTILE).alias("upper"), once(kept).alias("usual_kept"), once(F.col("bits")).alias("usual_bits"))


def judged(df: DataFrame, id_col: str = "rec_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The scores of every row with ``share`` (repeated letters), ``verdict`` and ``reached`` (by the lower band)."""
    scored = materialize(scores(df, fit(df, text_col, lang_col), id_col, text_col, lang_col), "scores")
    met = scored.join(F.broadcast(bands(scored)), "band_lang", "left")  # six languages at most
    share = F.when(F.col("n_letters") > 0, F.col("repeated") / F.col("n_letters")).otherwise(0.0)
    kept = F.coalesce(F.try_divide("bits", "base_bits"), F.lit(0.0))
    usual = F.coalesce("usual_kept", F.lit(1.0))
    verdict = F.when(kept <= LOWER * usual, "low").when(F.col("base_bits") > F.col("upper"), "high").otherwise("keep")
    reached = (kept <= F.greatest(F.lit(LOWER), REACH * usual)) | F.coalesce(F.col("bits") <= REACH * F.col("usual_bits"), F.lit(False))
    return met.withColumns({"share": share, "verdict": F.when(F.col("n_letters") > 0, verdict).otherwise("keep"), "reached": reached & (F.col("n_letters") > 0)})


def repetition(df: DataFrame, id_col: str = "rec_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``rec_id, perplexity, base_perplexity, repeated_share, verdict`` of every row; verdict is keep, low or high."""
    return judged(df, id_col, text_col, lang_col).select("rec_id", F.pow(F.lit(2.0), "bits").alias("perplexity"), F.pow(F.lit(2.0), "base_bits").alias("base_perplexity"), F.col("share").alias("repeated_share"), "verdict")


def repetition_found(df: DataFrame, id_col: str = "rec_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Records in the lower band's reach of which, checked exactly, at least FOUND_SHARE is repeated."""
    return judged(df, id_col, text_col, lang_col).where(F.col("reached") & (F.col("share") >= FOUND_SHARE)).select("rec_id").distinct()
