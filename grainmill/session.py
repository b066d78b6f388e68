"""Session defaults and materialisation points.

Lineage is cut by writing a compressed Parquet table into the shared folder named by
``spark.checkpoint.dir``: unlike a local checkpoint it survives the loss of any executor, and unlike
an RDD checkpoint it stays columnar, so later readers prune columns and push filters.
"""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

_written: list[str] = []
_own: list[str] = []


def local_session(app: str = "grainmill", cpus: int | str = 8, memory: str = "12g") -> SparkSession:
    """A single-JVM session for tests, benches and the command line."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus) if cpus != "*" else "8")
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors of a cluster, where it isn't installed."""
    if not spark.sparkContext.master.startswith("local"):
        root = Path(__file__).resolve().parent
        packed = shutil.make_archive(str(Path(tempfile.mkdtemp()) / root.name), "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(packed)


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, on a single machine a temporary one of this process."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="grainmill-"))
            _written.extend(_own)
        path = _own[0]
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and return the reader of the written table."""
    return write_step(df, name)[0]


def write_step(df: DataFrame, name: str = "step", **measures: Column) -> tuple[DataFrame, dict]:
    """``materialize``, and aggregates of the rows taken while they are written, without another job."""
    spark, seen = df.sparkSession, Observation()
    path = fresh_path(spark, name)
    rows = df.observe(seen, *(c.alias(n) for n, c in measures.items())) if measures else df
    rows.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._step_path = path
    return out, seen.get if measures else {}


def drop_steps(*tables: DataFrame) -> None:
    """Removes written tables that nothing reads any more, so that long loops don't fill the shared folder."""
    for df in tables:
        path = getattr(df, "_step_path", None)
        if path in _written:
            remove(df.sparkSession, path)
            _written.remove(path)


#: A table of at most so many bytes is dealt out to all cores before heavy work on each row.
SMALL_TABLE = 32 << 20
#: So is a table of so few row groups that no more than this share of the cores would work on it.
BUSY_SHARE = 0.25


def spread(df: DataFrame) -> DataFrame:
    """Before heavy work on each row: deals a table out to all cores if its scan can't be.

    Spark cuts files into splits for all cores, but not below a row group, so a table of one or two row groups would be
    worked on by one or two cores. What is moved is SMALL_TABLE bytes, or for each core a fourth of a row group, at most;
    a table of more row groups than a fourth of the cores, as any large one is, stays where it is.
    """
    plan = getattr(df, "_jdf", None)
    if df.isStreaming or plan is None:  # no plan to look at (remote session)
        return df
    leaves, cores = plan.queryExecution().optimizedPlan().collectLeaves(), df.sparkSession.sparkContext.defaultParallelism
    if leaves.size() != 1:
        return df
    size = int(str(leaves.apply(0).stats().sizeInBytes()))
    if size <= SMALL_TABLE or (size <= (1 << 30) * cores and _row_groups(df, math.ceil(BUSY_SHARE * cores)) < BUSY_SHARE * cores):
        return df.repartition(cores)
    return df


def _row_groups(df: DataFrame, enough: int) -> int:
    """Row groups of the files of a table; as soon as there are enough, no further file is looked at."""
    files, jvm, found = df.inputFiles(), df.sparkSession._jvm, 0
    if not files or len(files) >= enough:
        return enough
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for name in files:
        try:
            at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(at, conf))
        except Py4JJavaError:  # no Parquet file; it may be cut anywhere
            return enough
        found += reader.getRowGroups().size()
        reader.close()
        if found >= enough:
            break
    return found


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean(spark: SparkSession) -> None:
    """Removes all tables written so far; results that still read them are lost."""
    while _written:
        remove(spark, _written.pop())
    _own.clear()


@atexit.register
def _clean() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            clean(spark)
        except Exception:  # the session is going down; what is left belongs to the cluster's clean-up
            return
