"""Token budget of a corpus by source, language and domain.

Texts are cut into normalized segments no token can cross. The pieces of the vocabulary lie in a double-array trie,
and a count-only Viterbi finds the length of the best path of each distinct segment of a batch, all segments at once;
the lengths are summed by text and slice. For a unigram vocabulary that is the tokenizer's own count. A BPE vocabulary
has no unigram scores: its merge ranks give them by Zipf's law (-log rank), the best paths are the estimate
``viterbi_tokens``, and ``tokens`` follows from checking each distinct segment with the tokenizer's own merges.

Defined results: null and empty texts count as records of 0 tokens; null, empty and dirty keys are slices of their
own; repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .encode import TOKENIZERS
from .frames import lang_code, map_texts
from .letters import U64, codepoints, mix, noise_table
from .pretokens import _BACK, _STEP, _power

SPACE = 0x2581  # how the pieces write a blank
_FAR = -1e9
#: Characters of a block of a long segment, and numbers a table of places may hold.
BLOCK, TABLE = 256, 4_000_000


class DoubleArray:
    """Trie of strings: the child of state s by symbol c is base[s] + c if check there is s."""

    def __init__(self, values: dict[str, int]) -> None:
        letters = sorted({ch for w in values for ch in w})
        self.symbols = np.zeros(max(map(ord, letters), default=0) + 2, np.int32)
        for i, ch in enumerate(letters):
            self.symbols[ord(ch)] = i + 1
        width = len(letters) + 2
        nodes: list[dict[int, int]] = [{}]
        ends = {}
        for word, value in values.items():
            at = 0
            for ch in word:
                c = int(self.symbols[ord(ch)])
                at = nodes[at].setdefault(c, len(nodes))
                if at == len(nodes):
                    nodes.append({})
            ends[at] = value
        size = 4 * len(nodes) + 4 * width + 2048
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = np.zeros(size, bool)
        used[0] = True
        place, hint, front = {0: 0}, 1, 1
        for node, kids_of in enumerate(nodes):
            state = place[node]
            if node in ends:
                value[state] = ends[node]
            if not kids_of:
                continue
            kids = np.fromiter(kids_of, np.int64, len(kids_of))
            if len(kids) == 1:  # fills the first hole
                while used[hint] or hint <= kids[0]:
                    hint += 1
                at = hint - int(kids[0])
            else:
                at = 0
                while not at:
                    tries = np.arange(front, front + 512)
                    fits = ~used[tries[:, None] + kids].any(axis=1)
                    at = int(tries[fits.argmax()]) if fits.any() else 0
                    front = max(1, at - 256) if at else front + 512
            base[state] = at
            for c, child in kids_of.items():
                used[at + c] = True
                check[at + c] = state
                place[child] = at + c
        last = int(np.flatnonzero(used).max()) + width + 1
        self.base, self.check, self.value = base[:last], check[:last], value[:last]
        self.depth = max(map(len, values), default=0)

    def symbol(self, codes: np.ndarray) -> np.ndarray:
        return self.symbols[np.minimum(codes, len(self.symbols) - 1)]

    def walk(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next state of each, -1 where there is none."""
        to = self.base[state] + symbol
        return np.where((symbol > 0) & (self.base[state] > 0) & (self.check[to] == state), to, -1)


class Vocabulary:
    """Pieces with their scores, and which characters stand alone whatever is around them."""

    def __init__(self, scores: dict[str, float], byte_fallback: bool = True) -> None:
        pieces = list(scores)
        self.trie = DoubleArray({p: i for i, p in enumerate(pieces)})
        self.scores = np.array([scores[p] for p in pieces])
        self.byte_fallback = byte_fallback
        self.unknown = min(scores.values(), default=0.0) - 10.0
        top = max([ord(ch) for p in pieces for ch in p], default=0) + 2
        self.alone = np.ones(top, bool)
        for p in pieces:
            if len(p) > 1:
                self.alone[[ord(ch) for ch in p]] = False
        self.alone[SPACE if SPACE < top else 0] = False
        self.known = np.zeros(top, bool)
        self.known[[ord(p) for p in pieces if len(p) == 1]] = True
        if any(SPACE in map(ord, p.lstrip(chr(SPACE))) for p in pieces):
            raise ValueError("a piece has a blank inside; segments would not be independent")

    def single(self, codes: np.ndarray) -> np.ndarray:
        """Tokens of each character by itself."""
        known = self.known[np.minimum(codes, len(self.known) - 1)]
        size = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        return np.where(known, 1, size if self.byte_fallback else 1)

    def _costs(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """By length of a piece its score at the place where it begins, far below all others where there is none."""
        n = len(codes)
        owner_end = np.repeat(starts + sizes, sizes)
        at, symbols = np.arange(n), self.trie.symbol(codes)
        cost, state, live = [], np.zeros(n, np.int32), np.ones(n, bool)
        for d in range(1, self.trie.depth + 1):
            live &= at + d <= owner_end
            rows = np.flatnonzero(live)
            if not len(rows):
                break
            state[rows] = self.trie.walk(state[rows], symbols[rows + d - 1])
            live[rows] = state[rows] >= 0
            value = np.where(live, self.trie.value[np.maximum(state, 0)], -1)
            score = np.where(value >= 0, self.scores[np.maximum(value, 0)], _FAR)
            cost.append(np.where(value >= 0, score, self.unknown) if d == 1 else score)
        return cost

    def best_lengths(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Count-only Viterbi: pieces on the best path of each segment; of equal paths the shorter.

        The places of many segments are worked on together, by their distance from the segment's start. A long segment is
        cut into blocks that are worked on together as well: each from every state in which it may be entered, as pieces
        cross its start; then the blocks' outcomes are put in a row.
        """
        sizes = ends - starts
        cost, single = self._costs(codes, starts, sizes), self.single(codes)
        out = np.zeros(len(starts), np.int64)
        order = np.argsort(-sizes, kind="stable")
        long = order[sizes[order] > 2 * BLOCK]
        if len(long):
            out[long] = self._long(cost, single, starts[long], sizes[long])
        order = order[len(long) :]
        while len(order):
            part = order[: max(1, TABLE // (int(sizes[order[0]]) + 1))]
            _, counts = self._table(cost, single, starts[part], sizes[part])
            out[part] = counts[np.arange(len(part)), sizes[part]]
            order = order[len(part) :]
        return out

    @staticmethod
    def _table(cost: list[np.ndarray], single: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and count of the best path to every place of segments that come by falling size."""
        score_at = np.full((len(starts), int(sizes.max(initial=0)) + 1), _FAR * 2)
        count_at = np.zeros(score_at.shape, np.int64)
        score_at[:, 0] = 0.0
        for r in range(1, score_at.shape[1]):
            n = int(np.searchsorted(-sizes, -r, side="right"))
            best, count = score_at[:n, r], count_at[:n, r]
            for d in range(1, min(r, len(cost)) + 1):
                begin = starts[:n] + r - d
                best, count = _better(best, count, score_at[:n, r - d] + cost[d - 1][begin], count_at[:n, r - d] + (single[begin] if d == 1 else 1))
            score_at[:n, r], count_at[:n, r] = best, count
        return score_at, count_at

    def _long(self, cost: list[np.ndarray], single: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        depth, blocks, heads = len(cost), sizes // BLOCK, sizes % BLOCK
        order = np.argsort(-heads, kind="stable")
        first = starts + heads  # where each segment's first block begins
        score, count = np.full((len(starts), depth), _FAR * 2), np.zeros((len(starts), depth), np.int64)
        head_score, head_count = self._table(cost, single, starts[order], heads[order])
        for e in range(depth):  # states are how far before the block's start the last piece ends
            some = np.flatnonzero(heads[order] >= e)
            score[order[some], e], count[order[some], e] = head_score[some, heads[order[some]] - e], head_count[some, heads[order[some]] - e]
        out = np.zeros(len(starts), np.int64)
        begin = np.repeat(first, blocks) + BLOCK * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        of = np.repeat(np.arange(len(starts)), blocks)
        at_once = max(1, TABLE // (depth * depth))
        for a in range(0, len(begin), at_once):
            moved, counted = self._through(cost, single, begin[a : a + at_once], depth)
            for i, k in enumerate(of[a : a + at_once].tolist()):
                s, c = score[k][:, None] + moved[:, i].T, count[k][:, None] + counted[:, i].T
                top = s.max(axis=0)
                c = np.where(s >= top - 1e-9, c, np.iinfo(np.int64).max).min(axis=0)
                score[k], count[k] = top, np.where(top > _FAR, c, 0)
                out[k] = count[k, 0]
        return out

    @staticmethod
    def _through(cost: list[np.ndarray], single: np.ndarray, begin: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """By state at its end, block and state at its start the score and count of the best path through each block."""
        window = [np.full((len(begin), depth), _FAR * 2) for _ in range(depth)]
        counts = [np.zeros((len(begin), depth), np.int64) for _ in range(depth)]
        for e in range(depth):
            window[e][:, e] = 0.0
        for t in range(1, BLOCK + 1):
            best, count = np.full((len(begin), depth), _FAR * 2), np.zeros((len(begin), depth), np.int64)
            for d in range(1, depth + 1):
                places = begin + t - d
                own = cost[d - 1][np.maximum(places, 0)]
                if (own > _FAR).any():
                    best, count = _better(best, count, window[d - 1] + own[:, None], counts[d - 1] + (single[np.maximum(places, 0)][:, None] if d == 1 else 1))
            window, counts = [best, *window[:-1]], [count, *counts[:-1]]
        return np.stack(window), np.stack(counts)


def _better(score: np.ndarray, count: np.ndarray, new: np.ndarray, new_count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The better path of each place; of equal ones the one of fewer pieces."""
    take = (new > score + 1e-9) | ((np.abs(new - score) <= 1e-9) & (new_count < count))
    return np.where(take, new, score), np.where(take, new_count, count)


def segments(v: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points with blanks escaped and one put before each text, text ends, the segments' starts and ends, and where characters stand alone."""
    raw, ends = codepoints([("▁" + t) if t else "" for t in texts])
    codes = np.where(raw == 0x20, np.uint32(SPACE), raw)
    alone = v.alone[np.minimum(codes, len(v.alone) - 1)] | (codes >= len(v.alone))
    space = codes == SPACE
    first = np.zeros(len(codes) + 1, bool)
    first[ends] = True
    before = np.r_[True, alone[:-1]] if len(codes) else alone
    begin = ~alone & (before | first[:-1] | (space & ~np.r_[False, space[:-1]])) if len(codes) else alone
    starts = np.flatnonzero(begin)
    stop = np.flatnonzero(begin | alone | first[:-1]) if len(codes) else starts
    stop = np.r_[stop, len(codes)]
    return codes, ends, starts, stop[np.searchsorted(stop, starts, side="right")], alone


def count_tokens(v: Vocabulary, texts: list[str | None], exact=None) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text: checked by ``exact`` (counts of a list of segments), and by Viterbi."""
    codes, ends, starts, stops, alone = segments(v, texts)
    total = np.r_[0, np.cumsum(np.where(alone, v.single(codes), 0))]
    base = total[ends[1:]] - total[ends[:-1]]
    if not len(starts):
        return base, base
    powers = np.zeros(len(codes) + 1, U64)
    np.cumsum(noise_table()[codes] * _power(_STEP, len(codes)), out=powers[1:])
    hashes = mix((powers[stops] - powers[starts]) * _power(_BACK, len(codes) + 1)[starts] + (stops - starts).astype(U64))
    _, sample, where = np.unique(hashes, return_index=True, return_inverse=True)
    a, b = starts[sample], stops[sample]
    sizes = b - a
    flat = codes[np.repeat(a - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    at = np.cumsum(sizes) - sizes
    viterbi = v.best_lengths(flat, at, at + sizes)
    checked = viterbi
    if exact is not None:
        joined = flat.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        checked = np.array(exact([joined[x:y] for x, y in zip(at.tolist(), (at + sizes).tolist())]), np.int64)
    text = np.searchsorted(ends, starts, side="right") - 1
    add = lambda c: np.bincount(text, weights=c[where], minlength=len(texts)).astype(np.int64)
    return base + add(checked), base + add(viterbi)


def sentencepiece_vocabulary(model: bytes) -> tuple[Vocabulary, bytes | None]:
    """The vocabulary of a model file, and for a BPE model the model that checks segments (without a blank put before)."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(model)
    normal = [(i, p) for i, p in enumerate(proto.pieces) if p.type in (1, 4)]
    if proto.trainer_spec.model_type == 1:
        return Vocabulary({p.piece: p.score for _, p in normal}, proto.trainer_spec.byte_fallback), None
    singles = math.log(600)  # single characters stand at a BPE vocabulary's end whatever their frequency
    scores = {p.piece: -math.log(i + 1) if len(p.piece) > 1 else -singles for i, p in normal}
    proto.normalizer_spec.add_dummy_prefix = False
    return Vocabulary(scores, proto.trainer_spec.byte_fallback), proto.SerializeToString()


def token_counts(df: DataFrame, keys: dict[str, Column], text_col: str = "text", model_path: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    """The key columns with ``tokens`` and ``viterbi_tokens`` of every row."""
    with open(model_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(sentencepiece_vocabulary(f.read()))
    loaded: list = []

    def work(rest: dict, texts: list) -> dict:
        vocabulary, model = shared.value
        if not loaded and model is not None:
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_proto=model)
            loaded.append(lambda parts: [len(x) for x in processor.encode(parts, num_threads=1)])
        checked, viterbi = count_tokens(vocabulary, texts, loaded[0] if loaded else None)
        return rest | {"tokens": pa.array(checked), "viterbi_tokens": pa.array(viterbi)}

    rows = df.select(*(c.cast("string").alias(n) for n, c in keys.items()), F.col(f"`{text_col}`").alias("text"))
    return map_texts(rows, work, ", ".join(f"{n} string" for n in keys) + ", tokens bigint, viterbi_tokens bigint")


def token_budget(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``source, lang, domain, records, tokens, viterbi_tokens``; the keys as they stand in the data."""
    counted = token_counts(df, {k: F.col(k) for k in ("source", "lang", "domain")}, text_col)
    return counted.groupBy("source", "lang", "domain").agg(*_sums())


def _sums() -> list[Column]:
    return [F.count("*").alias("records"), F.sum("tokens").alias("tokens"), F.sum("viterbi_tokens").alias("viterbi_tokens")]


def token_slices(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``slice, key, records, tokens, viterbi_tokens``: totals by each key alone, with cleaned source and language."""
    keys = {"source": F.nullif(F.lower(F.trim("source")), F.lit("")), "lang": lang_code(F.col("lang")), "domain": F.nullif(F.trim("domain"), F.lit(""))}
    counted = token_counts(df, keys, text_col).groupBy(*keys).agg(*_sums())  # one row per combination before the key is multiplied
    pairs = counted.withColumn("pair", F.explode(F.array(*(F.struct(F.lit(k).alias("slice"), F.col(k).alias("key")) for k in keys))))
    return pairs.groupBy("pair.slice", "pair.key").agg(*(F.sum(c).alias(c) for c in ("records", "tokens", "viterbi_tokens")))
