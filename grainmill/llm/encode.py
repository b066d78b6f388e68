"""Encoding of a corpus with a public byte-level BPE, each distinct word encoded once.

Texts are cut into pre-tokens; a chunk of texts becomes its list of distinct words and, per text, the positions of
its words in that list. The words of all chunks meet in one shuffle by word, sorted, so that each distinct word is
encoded once; the ids go back to their chunk in a second shuffle, where they reach the task before the chunk's
texts and the texts are reassembled by position. A word of very many texts moves once per chunk, not per text.
Decoding joins the table of token bytes.

Defined results: null and empty texts give an empty list; special tokens are ordinary text; repeated rows give one
result each; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread
from .frames import named
from .letters import slices
from .pretokens import cut

TOKENIZERS = "/opt/tokenizers"
#: Characters of a chunk of texts, but for the last text.
CHUNK_CHARS = 8_000_000
#: Pre-tokens whose ids are put together at a time, but for a longer text.
MOST_WORDS = 2_000_000
_WORD, _TEXT = 0, 1
_ROWS = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("number", pa.int64()), ("data", pa.binary())])
_ROWS_SQL = "chunk bigint, kind int, number bigint, data binary"
_CODEC = pa.Codec("zstd")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file; one file of fixed size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def pack(positions: np.ndarray) -> bytes:
    """Positions as byte planes, compressed; the first eight bytes are the count."""
    planes = np.ascontiguousarray(positions.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(positions).to_bytes(8, "little") + _CODEC.compress(planes.tobytes(), asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(_CODEC.decompress(data[8:], 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _to_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, WORD, position, utf-8) for the words of a chunk and (chunk, TEXT, id, positions) for its texts.

    A chunk ends with its batch or after CHUNK_CHARS characters, so what a task holds of it doesn't grow with the texts.
    """
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
        words: dict[str, int] = {}
        packed, begun, total = [], 0, 0
        for start, end in slices(texts):
            joined, at, first, hashes = cut(texts[start:end])
            _, sample, where = np.unique(hashes, return_index=True, return_inverse=True)
            own = np.array([words.setdefault(joined[a:b], len(words)) for a, b in zip(at[sample].tolist(), at[sample + 1].tolist())], np.int64)
            positions = own[where] if len(own) else where
            packed += [pack(positions[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            total += len(joined)
            if total >= CHUNK_CHARS or end == len(texts):
                chunk = part << 32 | number
                coded = [w.encode("utf-8", "surrogatepass") for w in words]
                yield _rows(chunk, _WORD, np.arange(len(coded)), coded)
                yield _rows(chunk, _TEXT, ids.slice(begun, end - begun), packed)
                words, packed, begun, total, number = {}, [], end, 0, number + 1


def _rows(chunk: int, kind: int, numbers: object, data: list[bytes]) -> pa.RecordBatch:
    n = len(data)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk)), pa.array(np.full(n, kind, np.int32)), numbers if isinstance(numbers, pa.Array) else pa.array(numbers), pa.array(data, pa.binary())], schema=_ROWS)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """``doc_id, ids`` of every row."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        piece = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=shared.value, special_tokens={})._encode_single_piece
        word, ids = None, b""
        for batch in batches:
            out = []
            for data in batch.column("data").to_pylist():
                if data != word:
                    word, ids = data, np.array(piece(data), np.int32).tobytes()
                out.append(ids)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], schema=_ROWS)

    rows = materialize(spread(named(df, doc_id=id_col, text=text_col)).mapInArrow(_to_words, _ROWS_SQL), "words")
    coded = rows.where(F.col("kind") == _WORD).repartition("data").sortWithinPartitions("data").mapInArrow(encode_words, _ROWS_SQL)
    back = coded.unionByName(rows.where(F.col("kind") == _TEXT)).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return back.mapInArrow(_reassemble, "doc_id bigint, ids array<int>")


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's words come before its texts; only its word table is held."""
    chunk, numbers, data, table = None, [], [], None
    for batch in batches:
        chunks, kinds = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
        cuts = [0, *(np.flatnonzero((chunks[1:] != chunks[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if chunks[a] != chunk:
                chunk, numbers, data, table = chunks[a], [], [], None
            if kinds[a] == _WORD:
                numbers.append(batch.column("number").slice(a, b - a).to_numpy())
                data.append(batch.column("data").slice(a, b - a))
                continue
            if table is None:
                table, numbers, data = _table(numbers, data), [], []
            yield from _texts(batch.slice(a, b - a), *table)


def _table(numbers: list[np.ndarray], data: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place and count of the ids of each position, and all ids."""
    if not numbers:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int32),)
    order, flat = np.concatenate(numbers), pa.concat_arrays(data)
    _, offsets, raw = flat.buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(flat) + 1].astype(np.int64)
    sizes = np.diff(ends) // 4
    first, count = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    first[order], count[order] = np.cumsum(sizes) - sizes, sizes
    ids = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]].view(np.int32) if raw is not None else np.zeros(0, np.int32)
    return first, count, ids


def _texts(batch: pa.RecordBatch, first: np.ndarray, count: np.ndarray, ids: np.ndarray, at_once: int = 500) -> Iterator[pa.RecordBatch]:
    sizes = np.fromiter((int.from_bytes(x[:8], "little") for x in batch.column("data").to_pylist()), np.int64, batch.num_rows)
    group = np.cumsum(sizes) // MOST_WORDS  # long texts come in smaller batches
    starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in ((x, min(x + at_once, b)) for a, b in zip(starts, starts[1:]) for x in range(a, b, at_once)):
        part = batch.slice(start, end - start)
        positions = [unpack(x) for x in part.column("data").to_pylist()]
        every = np.concatenate(positions).astype(np.int64)
        sizes = count[every] if len(every) else np.zeros(0, np.int64)
        ends = np.r_[0, np.cumsum(sizes)]
        flat = ids[np.repeat(first[every] - ends[:-1], sizes) + np.arange(ends[-1])] if len(every) else np.zeros(0, np.int32)
        texts = np.r_[0, np.cumsum([len(p) for p in positions])]
        lists = pa.ListArray.from_arrays(pa.array(ends[texts].astype(np.int32)), pa.array(flat, pa.int32()))
        yield pa.RecordBatch.from_arrays([part.column("number"), lists], ["doc_id", "ids"])


def decode(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks_path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """``doc_id, text`` from lists of ids, by a join with the broadcast table of token bytes (of fixed size), a batch at once."""
    ranks = read_ranks(ranks_path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    shared = coded.sparkSession.sparkContext.broadcast((sizes, np.frombuffer(b"".join(tokens), np.uint8)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, raw = shared.value
        first = np.cumsum(sizes) - sizes
        for batch in batches:
            lists = batch.column("ids")
            number = np.diff(np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            long = sizes[ids] if len(ids) else np.zeros(0, np.int64)
            at = np.r_[0, np.cumsum(long)]
            data = raw[np.repeat(first[ids] - at[:-1], long) + np.arange(at[-1])].tobytes() if len(ids) else b""
            ends = at[np.r_[0, np.cumsum(number)]].tolist()
            texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return named(coded, doc_id=id_col, ids=ids_col).mapInArrow(run, "doc_id bigint, text string")


def round_trip(df: DataFrame) -> DataFrame:
    """``doc_id, same``: whether decoding the ids of each document gives its text back."""
    back = decode(encode(df)).withColumnRenamed("text", "decoded")
    return back.join(named(df, doc_id="doc_id", text="text"), "doc_id").select("doc_id", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same"))
