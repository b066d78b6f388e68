"""Reading level of texts: regularised ordinal regression, calibrated to graded texts.

Features: lexical diversity, rarity of the words in the corpus, connectives, a proxy of clause depth (commas and
connectives a sentence) and lengths of words and sentences, over the whole text and as the least of its parts, so
that a text is demanding only if it is so throughout. They are standardized within each language over all texts. The
rarity of a word are the bits of its share of all words of the corpus, RARE_BITS at most: words are counted exactly, and
since shares add up to one, no more than 2**RARE_BITS words are more frequent than that, however large the corpus. The
table of those is broadcast, all other words are as rare as can be.

The regression (proportional odds, L2) is fitted to at most MAX_LABELLED labelled texts, the ones with the smallest
hash of their id; all texts are scored. A text's grade is the mean of its annotators' distinct rows, rounded half up.

A text is prose if at least PROSE_LEAST of what it doesn't repeat stands among common words of any language, listed or
learned. (The mixture of ``prose`` fitted to the documents, where lists are few, calls some tables prose.)

Defined results: texts that are no prose, mis-decoded, empty or null have no level (null); null grades are ignored;
without labels no text has a level; repeated rows give one result each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread, write_step
from .frames import lang_code, map_texts, named
from .letters import slices
from .prose import learned_words
from .stats import COMMA, DIGIT, END, SIGN, THAI, WORD, Parsed, _part, among, connective_hashes, prose_shares, run_hashes

#: The rarity of all words no more frequent than one in 2**RARE_BITS; the table has 16 bytes for each of the others.
RARE_BITS = 20
#: Words a task counts before it sends them on.
HELD_WORDS = 2_000_000
PROSE_LEAST = 0.4
MAX_LABELLED = 20_000
PARTS = 3
PENALTY = 1.0
CLIP = 3.0
FEATURES = ["sentence", "line_sentence", "word", "common", "connectives", "commas", "variety", "rarity", "words", "least_sentence", "least_word"]


class Words:
    """Words of texts and their sentences. A run of Thai is cut where common words begin and end; a blank ends its sentence."""

    def __init__(self, p: Parsed) -> None:
        thai = (p.raw >= THAI[0]) & (p.raw <= THAI[1])
        known = p.thai_common()
        word = p.kind == WORD
        change = np.zeros(len(p.raw), bool)
        change[1:] = thai[1:] & thai[:-1] & (known[1:] != known[:-1])
        start, end = _runs(word, change, p.first)
        self.start, self.end, self.text = start, end, p.owner(start)
        self.hash = run_hashes(p.low, start, end)
        self.thai = thai[start]
        self.common = np.where(self.thai, known[start], among(self.hash, p.known))
        stop = p.kind == END
        after = np.r_[(p.kind[1:] != WORD) & (p.kind[1:] != DIGIT), True][: len(p.raw)] if len(p.raw) else stop
        blank = np.zeros(len(p.raw), bool)
        line = (p.raw == 10) & thai_around(thai)
        if len(p.raw) > 2:
            blank[1:-1] = (p.raw[1:-1] == 0x20) & thai[:-2] & thai[2:]
        self.sentence = np.cumsum((stop & after) | blank)[start] if len(start) else start
        self.line_sentence = np.cumsum((stop & after) | blank | line)[start] if len(start) else start
        n = p.count(self.text)
        rank = np.arange(len(start)) - np.repeat(np.cumsum(n) - n, n)
        self.part = rank * PARTS // np.maximum(np.repeat(n, n), 1)
        self.n = p.n


def thai_around(thai: np.ndarray) -> np.ndarray:
    """Places whose nearest Thai lies within two code points; elsewhere a line's end is no sentence's end."""
    near = thai.copy()
    for k in (1, 2):
        near[k:] |= thai[:-k]
        near[:-k] |= thai[k:]
    return near


def _runs(inside: np.ndarray, cut: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(inside):
        return (np.zeros(0, np.int64),) * 2
    start = inside & (~np.r_[False, inside[:-1]] | first[:-1] | cut)
    end = inside & (~np.r_[inside[1:], False] | first[1:] | np.r_[cut[1:], False])
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _per_sentence(w: Words, sentence: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Mean over a group's words of the length in words of the sentence each stands in."""
    if not len(sentence):
        return np.zeros(groups)
    key = w.text * (sentence.max() + 1) + sentence  # both grow along the words
    new = np.r_[True, key[1:] != key[:-1]]
    number = np.cumsum(new) - 1
    size = np.bincount(number)[number]
    return _part(np.bincount(group, weights=size, minlength=groups), np.bincount(group, minlength=groups))


class Frequent:
    """The words that are more frequent than one in 2**RARE_BITS, sorted by hash, with their rarity in bits."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int) -> None:
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.bits = np.log2(max(1, total) / counts[order]).astype(np.float32)

    def rarity(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), float(RARE_BITS))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.bits[at], RARE_BITS)


def features(p: Parsed, frequent: Frequent | None) -> np.ndarray:
    """One row of FEATURES per text."""
    w = Words(p)
    count = p.count(w.text)
    size = (w.end - w.start).astype(float)
    content = ~w.common
    sentences = _sentences(w)
    connective = among(w.hash, connective_hashes()) | (w.thai & w.common)
    part = w.text * PARTS + w.part
    part_word = _part(np.bincount(part, weights=size * content, minlength=p.n * PARTS), np.bincount(part, weights=content, minlength=p.n * PARTS)).reshape(p.n, PARTS)
    part_sentence = _per_sentence(w, w.sentence, part, p.n * PARTS).reshape(p.n, PARTS)
    rare = frequent.rarity(w.hash) if frequent is not None else np.zeros(len(w.hash))
    kinds = np.bincount(w.text[_first_of(w)], minlength=p.n) if len(w.hash) else np.zeros(p.n)
    contents = p.count(w.text, content.astype(float))
    return np.stack([
        np.log1p(_per_sentence(w, w.sentence, w.text, p.n)), np.log1p(_per_sentence(w, w.line_sentence, w.text, p.n)), np.log1p(_part(p.count(w.text, size * content), contents)),
        _part(p.count(w.text, w.common.astype(float)), count), np.log1p(_part(p.count(w.text, connective.astype(float)), sentences)), np.log1p(_part(p.per_text(p.kind == COMMA), sentences)),
        _part(kinds, np.sqrt(count)), _part(p.count(w.text, rare * content), contents), np.log1p(count), np.log1p(part_sentence.min(axis=1)), np.log1p(part_word.min(axis=1)),
    ], axis=1)


def _sentences(w: Words) -> np.ndarray:
    if not len(w.sentence):
        return np.zeros(w.n)
    new = np.r_[True, (w.sentence[1:] != w.sentence[:-1]) | (w.text[1:] != w.text[:-1])]
    return np.bincount(w.text[new], minlength=w.n)


def _first_of(w: Words) -> np.ndarray:
    """The first place of each distinct word of each text."""
    order = np.lexsort((w.hash, w.text))
    h, t = w.hash[order], w.text[order]
    return order[np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])]]


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``h, n``: how often each word (its 64-bit hash) stands in the corpus; every task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                own, n = np.unique(Words(Parsed(texts[a:b])).hash, return_counts=True)
                hashes, where = np.unique(np.concatenate([hashes, own]), return_inverse=True)
                counts = np.bincount(where, weights=np.concatenate([counts, n]), minlength=len(hashes)).astype(np.int64)
                if len(hashes) > HELD_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["h", "n"])
                    hashes, counts = hashes[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["h", "n"])

    return spread(named(df, text=text_col)).mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def frequent_words(df: DataFrame, text_col: str = "text") -> Frequent:
    """Counts all words of the corpus; only those above the share of RARE_BITS come to the driver."""
    counts, seen = write_step(word_counts(df, text_col), "words", total=F.coalesce(F.sum("n"), F.lit(0)))
    rows = counts.where(F.col("n") * F.lit(1 << RARE_BITS) > F.lit(int(seen["total"]))).toArrow()
    return Frequent(rows.column("h").to_numpy().view(np.uint64), rows.column("n").to_numpy(), int(seen["total"]))


#: Leading characters of UTF-8 read as a one-byte code, and what follows them; fixed values.
_LEADS = "ÃÄÅØÙÐ"
_TRAILS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def misdecoded(p: Parsed) -> np.ndarray:
    """How many characters of each text are UTF-8 read as a one-byte code."""
    if len(p.raw) < 2:
        return np.zeros(p.n)
    a, b = p.raw[:-1], p.raw[1:]
    trail = ((b >= 0x80) & (b <= 0xBF) & ((b != 0xA0) | (a == ord("Ã")))) | np.isin(b, [ord(c) for c in _TRAILS])
    pair = (np.isin(a, [ord(c) for c in _LEADS]) & trail) | ((a == ord("à")) & np.isin(b, [ord(c) for c in "¤¥¸¹"])) | ((a == ord("â")) & (b == ord("€")))
    return p.per_text(np.r_[pair & ~p.first[1:-1], False])


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, level_lang, prose`` and the FEATURES of every row."""
    more = learned_words(df, text_col, lang_col)
    shared = df.sparkSession.sparkContext.broadcast(frequent_words(df, text_col))

    def work(rest: dict, texts: list) -> dict:
        p = Parsed(texts, more)
        made = features(p, shared.value)
        common_share, prose_share = prose_shares(p)
        prose = (prose_share >= PROSE_LEAST) & (common_share > 0) & (misdecoded(p) == 0)
        lang = np.array(rest["lang"].to_pylist(), object)
        for low, high, name in ((0x0600, 0x077F, "ar"), (0x0900, 0x097F, "hi"), (*THAI, "th")):
            lang[_part(p.per_text((p.raw >= low) & (p.raw <= high)), p.per_text((p.kind != 0) & (p.kind != SIGN))) > 0.5] = name
        lang[~np.isin(lang, ["it", "tr", "ar", "hi", "th"])] = "und"
        return {"doc_id": rest["doc_id"], "level_lang": pa.array(lang.tolist(), pa.string()), "prose": pa.array(prose)} | {n: pa.array(made[:, i]) for i, n in enumerate(FEATURES)}

    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), lang_code(F.col(f"`{lang_col}`")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    return map_texts(texts, work, "doc_id bigint, level_lang string, prose boolean, " + ", ".join(f"{n} double" for n in FEATURES))


class Levels:
    """Standardization by language and the proportional-odds model."""

    def __init__(self, scales: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.scales = scales
        self.cuts, self.weights = np.zeros(2), np.zeros(0)

    def design(self, langs: list[str], x: np.ndarray) -> np.ndarray:
        """Standardized features, clipped, and the lesser of sentence and word length (both have to be high)."""
        z = np.zeros_like(x)
        for lang in set(langs):
            rows = np.array([v == lang for v in langs])
            mean, sd = self.scales.get(lang) or self.scales["*"]
            z[rows] = (x[rows] - mean) / sd
        z = np.clip(z, -CLIP, CLIP)
        f = FEATURES.index
        both = np.minimum(np.minimum(z[:, f("sentence")], z[:, f("word")]), np.minimum(z[:, f("least_sentence")], z[:, f("least_word")]))
        return np.column_stack([z, both, np.minimum(z[:, f("sentence")], z[:, f("word")])])

    def fit(self, langs: list[str], x: np.ndarray, grade: np.ndarray, rounds: int = 400) -> None:
        """Newton steps on the penalised likelihood of the cumulative logits."""
        z = self.design(langs, x)
        n, d = z.shape
        share = np.clip([(grade <= g).mean() for g in (1, 2)], 0.01, 0.99)
        theta = np.r_[np.log(share / (1 - share)), np.zeros(d)]
        theta[1] = max(theta[1], theta[0] + 0.1)
        penalty = np.r_[0, 0, np.full(d, PENALTY)]

        def cost(t: np.ndarray) -> tuple[float, np.ndarray]:
            eta = z @ t[2:]
            lower = np.column_stack([np.zeros(n), _sigmoid(t[0] - eta), _sigmoid(t[1] - eta), np.ones(n)])
            p = np.maximum(lower[np.arange(n), grade] - lower[np.arange(n), grade - 1], 1e-12)
            slope = lower * (1 - lower)
            up, down = slope[np.arange(n), grade], slope[np.arange(n), grade - 1]
            g = np.zeros(len(t))
            g[0] = -((grade == 1) * up / p).sum() + ((grade == 2) * down / p).sum()
            g[1] = -((grade == 2) * up / p).sum() + ((grade == 3) * down / p).sum()
            g[2:] = z.T @ ((up - down) / p)
            return -np.log(p).sum() + 0.5 * (penalty * t * t).sum(), g + penalty * t

        step, (value, g) = 1.0 / max(1, n), cost(theta)
        memory: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(rounds):  # limited-memory quasi-Newton
            q, alphas = g.copy(), []
            for s, y in reversed(memory):
                a = s @ q / (y @ s)
                alphas.append(a)
                q -= a * y
            q *= (memory[-1][0] @ memory[-1][1]) / (memory[-1][1] @ memory[-1][1]) if memory else step
            for (s, y), a in zip(memory, reversed(alphas)):
                q += (a - y @ q / (y @ s)) * s
            size = 1.0
            while size > 1e-10:
                new = theta - size * q
                if new[1] > new[0] + 1e-3:
                    new_value, new_g = cost(new)
                    if new_value <= value - 1e-4 * size * (g @ q):
                        break
                size /= 2
            else:
                break
            s, y = new - theta, new_g - g
            if s @ y > 1e-12:
                memory = [*memory[-9:], (s, y)]
            done = abs(value - new_value) < 1e-7 * n
            theta, value, g = new, new_value, new_g
            if done:
                break
        self.cuts, self.weights = theta[:2], theta[2:]

    def score(self, langs: list[str], x: np.ndarray) -> np.ndarray:
        return self.design(langs, x) @ self.weights

    def grade(self, score: np.ndarray) -> np.ndarray:
        return 1 + (score > self.cuts[0]).astype(np.int32) + (score > self.cuts[1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def grades(labels: DataFrame) -> DataFrame:
    """``doc_id, grade``: the annotators' mean, rounded half up; repeated rows count once."""
    rows = named(labels, doc_id="doc_id", annotator="annotator", grade="grade", at="labelled_at").where("grade between 1 and 3 and doc_id is not null").distinct()
    return rows.groupBy("doc_id").agg(F.floor(F.avg("grade") + 0.5).cast("int").alias("grade"))


def calibrate(table: DataFrame, labels: DataFrame) -> Levels | None:
    """Standardization over all prose texts, and the regression over the labelled ones."""
    prose = table.where("prose")
    stats = prose.rollup("level_lang").agg(F.count("*").alias("n"), *(f(n).alias(f"{n}_{k}") for n in FEATURES for k, f in (("mean", F.avg), ("sd", F.stddev_pop)))).collect()
    scales = {r.level_lang or "*": (np.array([r[f"{n}_mean"] for n in FEATURES]), np.maximum([r[f"{n}_sd"] or 0.0 for n in FEATURES], 1e-3)) for r in stats if r.n >= 20 or r.level_lang is None}
    if "*" not in scales or scales["*"][0][0] is None:
        return None
    rows = prose.join(grades(labels), "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED).toArrow()
    if not rows.num_rows:
        return None
    model = Levels(scales)
    model.fit(rows.column("level_lang").to_pylist(), np.column_stack([rows.column(n).to_numpy() for n in FEATURES]), rows.column("grade").to_numpy())
    return model


def levels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, level, score`` of every row; both are null where a text has no level."""
    table = materialize(measured(docs, id_col, text_col, lang_col), "measured")
    shared = docs.sparkSession.sparkContext.broadcast(calibrate(table, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            none = ~batch.column("prose").to_numpy(zero_copy_only=False) if model is not None else np.ones(batch.num_rows, bool)
            score, level = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int32)
            if model is not None and batch.num_rows:
                score = model.score(batch.column("level_lang").to_pylist(), np.column_stack([batch.column(n).to_numpy() for n in FEATURES]))
                level = model.grade(score)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(level.astype(np.int32), mask=none), pa.array(score, mask=none)], ["doc_id", "level", "score"])

    return table.mapInArrow(run, "doc_id bigint, level int, score double")


def demanding_found(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id`` of the documents of the highest level."""
    return levels(docs, labels).where((F.col("level") == 3) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
