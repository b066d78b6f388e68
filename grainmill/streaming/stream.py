"""The same rules over a folder that grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..functions.profiles import LanguageProfile
from ..operators import quality


def read_folder(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def annotate(stream: DataFrame, profile: LanguageProfile) -> DataFrame:
    """The quality rules are stateless, so they run on a stream as they are."""
    return quality.annotate(stream, profile)


def first_of_content(stream: DataFrame, time_col: str = "ingested_at", delay: str | None = None) -> DataFrame:
    """The first row of each content, in whatever order rows come; the state keeps an id for every content.

    A ``delay`` bounds the state by a watermark, at a price: rows that come later than that are dropped even if their
    content is new, and a content that comes again after it is returned again.
    """
    rows = stream.where("text is not null").withColumn("id", T.doc_id(F.col("text"), 32))
    return rows.dropDuplicates(["id"]) if delay is None else rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["id"])


def crawl_counts(stream: DataFrame, time_col: str = "crawled_at", width: str = "7 days") -> DataFrame:
    """Documents by source and window of crawl time; those without a time have a row by source with a null start.

    There is no watermark, so no row is too late; the state is one number by window and source, not by document.
    """
    none = F.col(time_col).isNull()
    at = F.coalesce(F.col(time_col), F.timestamp_seconds(F.lit(0)))  # a window drops null times
    rows = stream.select("source", none.alias("none"), at.alias("at"))
    counts = rows.groupBy(F.window("at", width), "none", "source").agg(F.count("*").alias("documents"))
    return counts.select(F.when(~F.col("none"), F.col("window.start")).alias("start"), "source", "documents")


def _aggregates(plan) -> bool:
    children = plan.children()
    return plan.isStreaming() and (plan.nodeName() == "Aggregate" or any(_aggregates(children.apply(i)) for i in range(children.size())))


def write_available(stream: DataFrame, out: str, checkpoint: str, mode: str | None = None) -> StreamingQuery:
    """Works off what there is and ends; a restart goes on where it ended.

    Rows are appended. Aggregates are complete by default: each batch writes all of them anew in place of the last
    state, as appending would keep back the groups that are still open.
    """
    mode = mode or ("complete" if _aggregates(stream._jdf.queryExecution().analyzed()) else "append")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "complete":
        return writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out)).start()
    return writer.format("parquet").option("path", out).start()
