"""Writing standard tables, and reports."""

from __future__ import annotations

import json
import math
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.relational import STANDARD, standardize
from . import snapshots

#: Limits of a published file; fixed values.
MAX_FILE_BYTES, MIN_ROWS, MAX_ROWS, FILL = 280 << 20, 10_000, 500_000, 0.9


def write_standard(df: DataFrame, path: str, source: str | None = None, rows_per_file: int = MAX_ROWS, mode: str = "errorifexists") -> None:
    """Rows in the standard schema, zstd, a new file every ``rows_per_file`` rows; ``mode="append"`` adds to a table."""
    standardize(df, source).write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def split_rejected(annotated: DataFrame, kept_path: str, rejected_path: str) -> None:
    """Kept rows with their rewritten text, and rejected ones with their reason."""
    names = [c for c in annotated.columns if c not in ("reject_reason", "filtered_text")]
    kept = annotated.where("reject_reason is null").select(*(F.col("filtered_text").alias("text") if c == "text" else F.col(c) for c in names))
    kept.write.option("compression", "zstd").parquet(kept_path)
    annotated.where("reject_reason is not null").drop("filtered_text").write.option("compression", "zstd").partitionBy("reject_reason").parquet(rejected_path)


def write_consensus(df: DataFrame, path: str, max_files: int = 10) -> None:
    """Consensus texts with sorted sources in at most ``max_files`` files."""
    df.select("text", "id", F.array_sort("source").alias("source")).repartition(max_files, "id").write.option("compression", "zstd").parquet(path)


def consolidate(spark: SparkSession, path: str, max_files: int, consensus: bool = False) -> None:
    """Rewrites a folder of standard tables as at most ``max_files`` files: a new snapshot, committed by one atomic rename.

    The package's readers see the old files or the new ones; a crash before the commit leaves the old state. The old files
    are removed afterwards.
    """
    df = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").parquet(snapshots.current(spark, path))
    kinds = {"source": "array<string>"} if consensus else {}
    rows = df.select(*(F.col(c).cast(kinds.get(c, "string")).alias(c) if c in df.columns else F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in STANDARD))
    new = snapshots.new_snapshot(path)
    rows.repartition(max_files).write.option("compression", "zstd").parquet(new)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f.getPath() for f in fs.listStatus(hadoop(path)) if f.getPath().getName() not in (snapshots.FOLDER, snapshots.POINTER)]
    snapshots.commit(spark, path, new)
    for f in old:
        fs.delete(f, True)
    snapshots.vacuum(spark, path, 0)


def flatten(df: DataFrame, fallback: str = "consensus") -> DataFrame:
    """Consensus rows with their sources as text."""
    return df.select("text", "id", T.flat_sources(F.col("source"), fallback).alias("source"))


def rows_per_file(df: DataFrame, max_bytes: int = MAX_FILE_BYTES) -> int:
    """How many rows fit a file, from the mean size over all rows; packing only makes files smaller."""
    mean = df.agg(F.avg(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 1.0
    return int(min(MAX_ROWS, max(MIN_ROWS, FILL * max_bytes / mean)))


def repack(df: DataFrame, path: str, max_bytes: int = MAX_FILE_BYTES) -> None:
    """Files of at most about ``max_bytes`` with row groups that suit readers of single rows."""
    per_file = rows_per_file(df, max_bytes)
    files = max(1, math.ceil(df.count() / per_file))
    df.repartition(files).write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").option("maxRecordsPerFile", per_file).parquet(path)


def json_report(df: DataFrame, path: str | Path, **metadata: object) -> None:
    """A small result table as a JSON file, on any file system."""
    rows = [r.asDict(recursive=True) for r in df.collect()]
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(str(path))
    out = snapshots.file_system(df.sparkSession, str(path)).create(at, True)
    out.write(json.dumps({"_metadata": metadata, "rows": rows}, ensure_ascii=False, indent=2, default=str).encode())
    out.close()


def summary(df: DataFrame, by: str, keys: int = 1) -> str:
    """A small result table as text, largest ``by`` first, with the total of every number column."""
    rows = df.orderBy(F.desc(by), *df.columns[:keys]).collect()
    totals = ["total", *[""] * (keys - 1), *(sum(r[c] or 0 for r in rows) for c in df.columns[keys:])]
    cells = [df.columns, *([f"{v:,}" if isinstance(v, int) else "" if v is None else str(v) for v in r] for r in [*map(list, rows), totals])]
    wide = [max(len(r[i]) for r in cells) for i in range(len(df.columns))]
    return "\n".join("  ".join(v.ljust(w) if i < keys else v.rjust(w) for i, (v, w) in enumerate(zip(r, wide))).rstrip() for r in cells)
