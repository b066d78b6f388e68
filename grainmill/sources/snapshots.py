"""Tables that are replaced as a whole: immutable snapshot folders and one small file that names the current one.

A commit writes the name aside and renames it over the old one in one step (HDFS: an overwriting rename; local: the
operating system's; object stores: a put of one small object). A reader follows the name, so it sees the old state or the new one, whole, at any moment; a
crash before the rename leaves the old state. Superseded snapshots stay for readers that are still at work, until
``vacuum`` finds them old enough.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import SparkSession

POINTER, FOLDER = "current", "snapshots"
#: Seconds that a superseded snapshot, or one that was never committed, stays.
KEEP_SECONDS = 24 * 3600


def _at(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    fs = _at(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getRawFileSystem() if fs.getUri().getScheme() == "file" else fs  # no checksum file beside the name


def new_snapshot(table: str) -> str:
    """The path of a snapshot to be written and then committed."""
    return f"{table.rstrip('/')}/{FOLDER}/{uuid.uuid4().hex}"


def commit(spark: SparkSession, table: str, snapshot: str, **facts: object) -> None:
    """Makes a written snapshot the current one; ``facts`` are kept beside its name."""
    fs, jvm, root = file_system(spark, table), spark._jvm, table.rstrip("/")
    name, aside = _at(spark, f"{root}/{POINTER}"), _at(spark, f"{root}/_{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(json.dumps({"snapshot": snapshot.rsplit("/", 1)[1], **facts}).encode())
    out.close()
    if fs.getUri().getScheme() == "file":  # the local file system's own rename deletes first
        os.replace(aside.toUri().getPath(), name.toUri().getPath())
        return
    kind = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(aside), fs.makeQualified(name), over)


def facts(spark: SparkSession, table: str) -> dict | None:
    """What the current name's file says; None for a folder without snapshots."""
    fs, name = file_system(spark, table), _at(spark, f"{table.rstrip('/')}/{POINTER}")
    if not fs.exists(name) or fs.getFileStatus(name).isDirectory():
        return None
    stream = fs.open(name)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, table: str) -> str:
    """The folder to read: the current snapshot's, or the table's own where it has none."""
    known = facts(spark, table)
    return table if known is None else f"{table.rstrip('/')}/{FOLDER}/{known['snapshot']}"


def discard(spark: SparkSession, snapshot: str) -> None:
    """Removes a snapshot that was not committed, and the folder of snapshots if it is empty without it."""
    fs, path = file_system(spark, snapshot), _at(spark, snapshot)
    fs.delete(path, True)
    if fs.exists(path.getParent()) and not len(fs.listStatus(path.getParent())):
        fs.delete(path.getParent(), False)


def vacuum(spark: SparkSession, table: str, keep_seconds: float = KEEP_SECONDS) -> None:
    """Removes all snapshots but the current one that have not been written to for so long."""
    fs, folder, known = file_system(spark, table), _at(spark, f"{table.rstrip('/')}/{FOLDER}"), facts(spark, table)
    if known is None or not fs.exists(folder):
        return
    for f in fs.listStatus(folder):
        if f.getPath().getName() != known["snapshot"] and f.getModificationTime() <= (time.time() - keep_seconds) * 1000:
            fs.delete(f.getPath(), True)
