"""Reading raw and standard tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from . import snapshots

STANDARD_SCHEMA = "text STRING, id STRING, source STRING"
CONSENSUS_SCHEMA = "text STRING, id STRING, source ARRAY<STRING>"
#: Folder of files that belong to no source; fixed value.
SKIPPED = "misc"


def path_source(path, root_parts: int | None = None):
    """The source of a file ``data/{lang}/{stage}/{source}/...``: the folder after the stage, or after ``root_parts`` folders."""
    if root_parts is None:
        return F.nullif(F.regexp_extract(path, r"(?:^|/)data/[^/]+/[^/]+/([^/]+)/", 1), F.lit(""))
    return F.nullif(F.split_part(path, F.lit("/"), F.lit(root_parts + 1)), F.lit(""))


def parquet_folder(spark: SparkSession, path: str, schema: str | None = None, limit: int | None = None) -> DataFrame:
    """All Parquet files below a folder, of its current snapshot if it has any; ``limit`` is over the whole folder."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    df = (reader.schema(schema) if schema else reader).parquet(snapshots.current(spark, path))
    return df if limit is None else df.limit(limit)


def sourced_folder(spark: SparkSession, path: str, columns: str = "text STRING") -> DataFrame:
    """Texts below ``path``/{source}/ with the source of each file; files right below ``path`` have the source ``.``."""
    df = parquet_folder(spark, path, columns)
    base = re.sub("^[a-zA-Z0-9]+:/+", "/", path).rstrip("/") + "/"
    rest = F.substring_index(F.col("_metadata.file_path"), base, -1)
    source = F.when(F.contains(rest, F.lit("/")), F.split_part(rest, F.lit("/"), F.lit(1))).otherwise(F.lit("."))
    return df.withColumn("source", source).where(F.col("source") != SKIPPED)


def subsets(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; a folder without any has the subset ``default``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(target) if f.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", "."))) or ["default"]


def json_lines(spark: SparkSession, path: str, pattern: str = "*.json.gz") -> DataFrame:
    """Texts of JSON-lines files, packed or plain; malformed lines and empty texts are skipped, the rest of the file is kept."""
    rows = spark.read.schema("text STRING").option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(path)
    return rows.where("text <> ''")


def chunked_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines from ``*.jsonl``, or where there is none from every file with ``chunk`` in its name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(target, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".jsonl"):
            return json_lines(spark, path, "*.jsonl")
    return json_lines(spark, path, "*chunk*")


def convert(df: DataFrame, source: str, keep_empty: bool = False) -> DataFrame:
    """Any table with a text to the standard schema; null texts are left out, empty ones unless ``keep_empty``, as
    tables are converted whole and JSON lines are not."""
    return df.where("text is not null" if keep_empty else "text <> ''").select("text", T.doc_id(F.col("text")).alias("id"), F.lit(source).alias("source"))


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    """``file, rows`` of every Parquet file; without columns to read, only footers are."""
    return parquet_folder(spark, path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"))
