"""Evaluation texts that leak into training texts, found by winnowing.

Of every ``WINDOW`` neighbouring runs of ``K`` letters the one with the smallest hash is kept as a fingerprint, so
every span of ``K + WINDOW - 1`` letters that two texts share holds a fingerprint of both at the same place. Each hit is
extended to the longest shared run around it; runs of ``SPAN`` letters or more cover the item.

Items of up to ``BLOCK_BYTES`` in all, as evaluation suites are, go to every task and are joined with the documents'
fingerprints there, in one pass over the corpus and without a shuffle. A larger set is joined by shuffle: the
fingerprints of the documents pass a bit map of the items' fingerprints and meet them by hash; only the texts of the
pairs that met are moved and extended. An item that needs m hits is found by any of its fingerprints but m - 1, so the
most frequent m - 1 (of a common instruction line) are left out of the join without losing a pair.

Defined results: null, empty and shorter than ``SPAN`` items or documents give nothing; repeated rows of an id give
one result; items with equal texts are reported each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import join_unique, semi_join_wide
from ..session import materialize, write_step
from .frames import map_texts, named
from .letters import gram_hashes, gram_owner, letters, mix

K, WINDOW, SPAN = 12, 14, 25
FOUND_SHARE = 0.5
#: UTF-8 bytes of the items that are broadcast; they take about ten times as much in a task.
BLOCK_BYTES = 4 << 20
#: Bits of the largest map of item fingerprints.
MOST_BITS = 1 << 30


def winnow(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place among the letters and text number of the fingerprints."""
    place, owner = gram_owner(ends, K, len(codes))
    if len(place) < WINDOW:
        return np.zeros(0, np.uint64), place[:0], owner[:0]
    h = mix(gram_hashes(codes, K)[place])
    least = np.lib.stride_tricks.sliding_window_view(h, WINDOW).argmin(axis=1) + np.arange(len(h) - WINDOW + 1)
    keep = np.zeros(len(h), bool)
    keep[least] = True  # windows over a text's end only add fingerprints
    return h[keep], place[keep], owner[keep]


def hits_needed(sizes: np.ndarray) -> np.ndarray:
    """A run of L letters shared with a document holds L - SPAN + 1 windows, so no fewer fingerprints than one per SPAN + WINDOW - 1 letters."""
    return np.ceil(FOUND_SHARE * sizes / (SPAN + WINDOW - 1)).astype(np.int64)


class Items:
    """The fingerprints of a block of items, sorted by hash."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        self.codes, self.ends = letters(texts)
        h, place, owner = winnow(self.codes, self.ends)
        order = np.argsort(h, kind="stable")
        self.ids, self.sizes = np.array(ids, np.int64), np.diff(self.ends)
        self.hashes, self.first = np.unique(h[order], return_index=True)
        self.count = np.diff(np.r_[self.first, len(order)])
        self.place, self.owner = place[order], owner[order]
        self.least_hits = hits_needed(self.sizes)

    def shares(self, codes: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, float]]:
        """(text number, item number, covered share) of all pairs that can reach FOUND_SHARE."""
        h, place, owner = winnow(codes, ends)
        if not len(h) or not len(self.hashes):
            return []
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == h)
        many = self.count[at[hit]]
        if not many.sum():
            return []
        mine = np.repeat(hit, many)
        theirs = np.repeat(self.first[at[hit]], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item, doc = self.owner[theirs], owner[mine]
        shift = (place[mine] - ends[doc]) - (self.place[theirs] - self.ends[item])
        pair = doc * len(self.ids) + item
        seeds = np.unique(np.stack([pair, self.place[theirs]]), axis=1)[0]
        pairs, hits = np.unique(seeds, return_counts=True)
        keep = np.isin(pair, pairs[hits >= self.least_hits[pairs % len(self.ids)]])
        lines = np.unique(np.stack([pair[keep], shift[keep]]), axis=1).T.tolist()
        out, i = [], 0
        while i < len(lines):
            number = lines[i][0]
            d, t = divmod(number, len(self.ids))
            doc_codes, item_codes = codes[ends[d] : ends[d + 1]], self.codes[self.ends[t] : self.ends[t + 1]]
            covered = np.zeros(len(item_codes), bool)
            while i < len(lines) and lines[i][0] == number:
                _extend(doc_codes, item_codes, lines[i][1], covered)
                i += 1
            out.append((d, t, covered.sum() / max(1, len(item_codes))))
        return out


def _extend(doc: np.ndarray, item: np.ndarray, shift: int, covered: np.ndarray) -> None:
    """Marks the item's letters in runs of SPAN or more that the document holds ``shift`` places further on."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if high - low < SPAN:
        return
    same = item[low:high] == doc[low + shift : high + shift]
    edges = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if b - a >= SPAN:
            covered[low + a : low + b] = True


def leaks(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, share``: documents with passages of an item, and the share of its letters they hold.

    Pairs whose share is below FOUND_SHARE are listed only as far as their hits allowed a higher one.
    """
    texts = named(docs, doc_id=doc_col, text=text_col)
    rows = named(items, item_id=item_col, text=text_col).where("item_id is not null and length(text) > 0").distinct()
    rows, seen = write_step(rows, "items", size=F.coalesce(F.sum(F.octet_length("text")), F.lit(0)))
    if seen["size"] > BLOCK_BYTES:
        return _shuffled(texts, rows)
    held = rows.toArrow().to_pydict()
    shared = docs.sparkSession.sparkContext.broadcast(Items(held["item_id"], held["text"]))

    def work(rest: dict, texts: list) -> dict | None:
        pairs = shared.value.shares(*letters(texts))
        if not pairs:
            return None
        d, t, share = zip(*pairs)
        return {"doc_id": rest["doc_id"].take(pa.array(d)), "item_id": pa.array(shared.value.ids[list(t)]), "share": pa.array(share, pa.float64())}

    return map_texts(texts, work, "doc_id bigint, item_id bigint, share double")


def _item_prints(rest: dict, texts: list) -> dict | None:
    """A row for each fingerprint of each item, with how many of the item's it takes to find it."""
    codes, ends = letters(texts)
    h, _, owner = winnow(codes, ends)
    number = np.bincount(owner, minlength=len(texts))
    enough = number - np.maximum(1, hits_needed(np.diff(ends))) + 1
    return {"item_id": rest["item_id"].take(pa.array(owner)), "h": pa.array(h.view(np.int64)), "enough": pa.array(enough[owner])}


def _shuffled(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``leaks`` of an item set of any size."""
    prints = materialize(map_texts(items, _item_prints, "item_id bigint, h bigint, enough bigint"), "item-prints")
    often = prints.groupBy("h").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("n", "h"))  # within one item
    index = join_unique(prints, often, ["h"]).withColumn("rank", rank).where("rank <= enough").select("item_id", "h").distinct()
    index, seen = write_step(index.groupBy("h").agg(F.collect_set("item_id").alias("items")), "index", n=F.count("*"))
    bits = 1 << 16
    while bits < min(16 * seen["n"], MOST_BITS):
        bits *= 2
    mask = np.uint64(bits - 1)
    words = index.select(F.expr(f"(h & {bits - 1}L) >> 6").alias("at"), F.expr("shiftleft(1L, cast(h & 63L as int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("word")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[words.column("at").to_numpy()] = words.column("word").to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(table.tobytes())

    def work(rest: dict, texts: list) -> dict | None:
        h, _, owner = winnow(*letters(texts))
        at = (h & mask).astype(np.int64)
        some = (np.frombuffer(shared.value, np.uint8)[at >> 3] >> (at & 7)) & 1 == 1
        pairs = np.unique(np.stack([owner[some].astype(np.uint64), h[some]]), axis=1)
        return {"doc_id": rest["doc_id"].take(pa.array(pairs[0].astype(np.int64))), "h": pa.array(pairs[1].view(np.int64))}

    met = materialize(map_texts(texts.where("doc_id is not null"), work, "doc_id bigint, h bigint"), "doc-prints")
    pairs = join_unique(met, index, ["h"]).select("doc_id", F.explode("items").alias("item_id")).distinct()
    pairs = materialize(pairs, "pairs")
    needed = materialize(pairs.select("doc_id").distinct(), "needed")
    held = materialize(semi_join_wide(texts, needed, ["doc_id"]).distinct(), "held")
    both = join_unique(pairs, items.withColumnRenamed("text", "item"), ["item_id"]) if _single(items) else pairs.join(items.withColumnRenamed("text", "item"), "item_id")
    return both.join(held, "doc_id").select("doc_id", "item_id", "text", "item").mapInArrow(_extended, "doc_id bigint, item_id bigint, share double")


def _single(items: DataFrame) -> bool:
    """Whether every item has one text."""
    return items.groupBy("item_id").count().where("count > 1").isEmpty()


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The covered share of every pair of texts."""
    last, codes, ends = None, None, None
    for batch in batches:
        docs, ids, out = batch.column("text").to_pylist(), batch.column("item_id").to_pylist(), []
        for i, (text, number, item) in enumerate(zip(docs, ids, batch.column("item").to_pylist())):
            if text is not last:
                last, (codes, ends) = text, letters([text])
            out += [(i, share) for _, _, share in Items([number], [item]).shares(codes, ends)]
        rows = pa.array([i for i, _ in out], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("item_id").take(rows), pa.array([s for _, s in out], pa.float64())], ["doc_id", "item_id", "share"])


def leaks_found(docs: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(docs, items).where(F.col("share") >= FOUND_SHARE).select("doc_id", "item_id").distinct()
