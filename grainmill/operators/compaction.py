"""Consolidation of very many small files into a few well-sized ones.

The input is read once and frozen as a table of its files (the manifest) and of their readable lines. From keys, sizes
and digests alone the line of each record is chosen; the files, weighed by what survives of them, are packed into bins
by first-fit decreasing; then the chosen lines are moved and each bin is written as one file. Row counts and checksums of
what was chosen and what was written are compared, and the new snapshot is committed by one atomic rename.

A record is a line that is a whole JSON object with a ``rec_key`` (a number or a string of digits); a byte-order mark
before it does not matter. Files that repeat or overlap hold some records several times: of each key the copy of the
latest attempt wins, then the one with a text, then the longest, then the one of the greatest md5.

Defined results: null, empty and cut-off bodies give what whole lines they hold; an empty table gives an empty, committed
result; a null text stays null; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path, materialize, write_step
from ..sources import snapshots

TARGET_BYTES = 128 << 20
#: Files, and full bins, packed together by one task; a bin never spans shards.
SHARD_FILES, SHARD_BINS = 500_000, 256
_RECORD = "rec_key bigint, text string, source string, lang string"
_KINDS = [("file_no", pa.int64()), ("line", pa.int32()), ("piece", pa.int32()), ("attempt", pa.int32()), ("size", pa.int64()), ("rec_key", pa.int64()), ("text", pa.string()), ("source", pa.string()), ("lang", pa.string())]
_LINES = "file_no bigint, line int, piece int, attempt int, size bigint, " + _RECORD


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each size. A size above the capacity gets a bin of its own.

    The first bin with enough room is found in a tree of the largest room below each node.
    """
    order = np.argsort(-sizes, kind="stable")
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins = np.zeros(len(sizes), np.int64)
    for i in order.tolist():
        need = min(int(sizes[i]), capacity)
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i] = node - leaves
        room[node] -= need
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins


def manifest(files: DataFrame) -> DataFrame:
    """``file_no, attempt, size``: the frozen list of files that hold anything."""
    return listing(freeze(files))


def listing(frozen: DataFrame) -> DataFrame:
    return frozen.where("line < 0").select("file_no", "attempt", "size")


def plan_bins(listed: DataFrame, target_bytes: int = TARGET_BYTES, shard_files: int = SHARD_FILES) -> DataFrame:
    """``file_no, piece, bin``: first-fit decreasing, by ``size``, within shards of bounded size."""
    rows = listed if "piece" in listed.columns else listed.withColumn("piece", F.lit(0))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = max(1, -(-n // shard_files), -(-int(size) // (SHARD_BINS * target_bytes)))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["size", "file_no", "piece"], ascending=False)
        return pd.DataFrame({"file_no": part.file_no, "piece": part.piece, "bin": first_fit_decreasing(part["size"].to_numpy(), target_bytes) * shards + part["shard"].to_numpy()})

    rows = rows.select("file_no", "piece", "size", F.pmod(F.xxhash64("file_no", "piece"), F.lit(shards)).alias("shard"))
    return rows.groupBy("shard").applyInPandas(pack, "file_no bigint, piece int, bin bigint")


def _key(value: object) -> int | None:
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, str):
        value = value.strip()
        value = int(value) if value.isascii() and value.isdigit() else None
    elif isinstance(value, float):
        value = int(value) if value.is_integer() else None
    return value if value is not None and -(1 << 63) <= value < 1 << 63 else None


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return None if value is None else value.encode("utf-8", "replace").decode("utf-8")
    return json.dumps(value, ensure_ascii=False)


def freeze(files: DataFrame, piece_bytes: int = TARGET_BYTES) -> DataFrame:
    """A row (line -1) for every file that holds anything, and one for every readable line; written once, no shuffle.

    ``size`` are the bytes of a file, and of a line packed by itself; ``piece`` cuts files of more than ``piece_bytes`` into parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_no = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows: list[list] = [[] for _ in _KINDS]
            for attempt, body in zip(*(batch.column(c).to_pylist() for c in ("attempt", "body"))):
                file_no, at = file_no + 1, 0
                found: list[tuple] = []
                for number, line in enumerate(body.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
                    line = line.strip().lstrip("\ufeff").strip()
                    if not line.startswith("{"):
                        continue
                    try:
                        record = json.loads(line)
                    except (ValueError, RecursionError):
                        continue
                    key = _key(record.get("rec_key"))
                    if key is not None:
                        size = len(zlib.compress(line.encode("utf-8", "replace"), 1))
                        found.append((file_no, number, at // piece_bytes, attempt, size, key, *(_text(record.get(c)) for c in ("text", "source", "lang"))))
                        at += size
                for row in [(file_no, -1, 0, attempt, len(body.encode("utf-8", "replace")), None, None, None, None), *found]:
                    for column, value in zip(rows, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(rows, _KINDS)], [n for n, _ in _KINDS])

    bodies = files.select(F.coalesce(F.col("attempt"), F.lit(0)).cast("int").alias("attempt"), "body").where("length(body) > 0")
    return materialize(bodies.mapInArrow(run, _LINES).withColumn("sum", _row_hash()), "frozen")


def _row_hash():
    return F.xxhash64("rec_key", "text", "source", "lang")


def chosen_lines(frozen: DataFrame) -> DataFrame:
    """``rec_key, file_no, line, piece, size, sum``: the line of each record. No text is moved for it."""
    digest = F.md5(F.concat_ws("\x1f", *(F.coalesce(c, F.lit("")) for c in ("text", "source", "lang"))).cast("binary"))
    version = F.struct("attempt", F.col("text").isNotNull().alias("has"), F.coalesce(F.length("text"), F.lit(0)).alias("long"), digest.alias("digest"), (-F.col("file_no")).alias("f"), (-F.col("line")).alias("l"))
    best = frozen.where("line >= 0").groupBy("rec_key").agg(F.max_by(F.struct("file_no", "line", "piece", "size", "sum"), version).alias("best"))
    return best.select("rec_key", "best.*")


def checksum(records: DataFrame) -> tuple:
    """Row count and an order-free sum of row hashes."""
    return tuple(records.agg(F.count("*"), F.sum(_row_hash().cast("decimal(38,0)"))).first())


def _packed_share(frozen: DataFrame) -> float:
    """Bytes of the written table for each byte of its lines packed one by one: what the output will take of theirs."""
    spark, lines = frozen.sparkSession, frozen.where("line >= 0").agg(F.sum("size")).first()[0] or 0
    path = spark._jvm.org.apache.hadoop.fs.Path(frozen._step_path)
    stored = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return min(2.0, max(0.02, stored / max(1, lines)))


def compact(files: DataFrame, out: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rewrites the records of ``files`` as the current snapshot of the table ``out`` and returns its reader."""
    spark = files.sparkSession
    frozen = freeze(files, target_bytes)
    chosen, wanted = write_step(chosen_lines(frozen), "chosen", n=F.count("*"), sum=F.sum(F.col("sum").cast("decimal(38,0)")), size=F.coalesce(F.sum("size"), F.lit(0)))
    capacity = int(target_bytes / _packed_share(frozen))
    parts = materialize(chosen.groupBy("file_no", "piece").agg(F.sum("size").alias("size"), F.collect_list("line").alias("lines")), "parts")  # the lines of one small file or piece
    bins = materialize(plan_bins(parts, capacity), "bins")
    place = parts.join(bins, ["file_no", "piece"]).select("file_no", "piece", "lines", "bin")
    records = frozen.where("line >= 0").join(place, ["file_no", "piece"]).where(F.array_contains("lines", F.col("line"))).select("rec_key", "text", "source", "lang", "bin")
    n_bins = bins.agg(F.countDistinct("bin")).first()[0]
    snapshot = snapshots.new_snapshot(out)
    records.repartition(max(1, n_bins), "bin").sortWithinPartitions("bin", "rec_key").write.option("compression", "zstd").partitionBy("bin").parquet(snapshot)
    written = spark.read.schema(f"{_RECORD}, bin bigint").parquet(snapshot)
    got = checksum(written)
    if (wanted["n"], wanted["sum"]) != got:
        snapshots.discard(spark, snapshot)
        raise RuntimeError(f"compaction would lose or repeat records: {(wanted['n'], wanted['sum'])} before, {got} after")
    snapshots.commit(spark, out, snapshot, rows=got[0], checksum=str(got[1]), bins=n_bins, target_bytes=target_bytes)
    snapshots.vacuum(spark, out)
    return committed(spark, out)


def committed(spark, out: str) -> DataFrame:
    """The records of the current snapshot of a compacted table."""
    return spark.read.schema(f"{_RECORD}, bin bigint").parquet(snapshots.current(spark, out)).drop("bin")


def compacted_keys(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``rec_key`` of every record of the compacted files, written below the shared folder."""
    return compact(files, fresh_path(files.sparkSession, "compact"), target_bytes).select("rec_key")


def compacted_records(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    return compact(files, fresh_path(files.sparkSession, "compact"), target_bytes)
