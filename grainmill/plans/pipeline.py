"""The stages put together: filter by language, remove near duplicates, find the consensus, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.profiles import PROFILES
from ..operators import consensus, dedup, overlap, quality, relational, tokens
from ..session import materialize
from ..sources import readers, registry, writers


def filtered(docs: DataFrame) -> DataFrame:
    """Documents their language's rules keep, with the rewritten text."""
    rows = quality.annotate_by_language(docs).where("reject_reason is null")
    return rows.withColumn("text", F.col("filtered_text")).drop("reject_reason", "filtered_text")


def curated(docs: DataFrame) -> DataFrame:
    """Filtered and without near duplicates. The filtered table is written once; both later stages read it."""
    return dedup.minhash_dedup(materialize(filtered(docs), "filtered"))


def yields(docs: DataFrame) -> DataFrame:
    """``source, documents, kept, deduplicated, tokens``: what each source gives at each stage."""
    kept = materialize(filtered(docs), "filtered")
    left = materialize(dedup.minhash_dedup(kept), "deduplicated")
    key = F.coalesce("source", F.lit("")).alias("source")
    a = docs.groupBy(key).agg(F.count("*").alias("documents"))
    b = kept.groupBy(key).agg(F.count("*").alias("kept"))
    c = left.groupBy(key).agg(F.count("*").alias("deduplicated"), F.sum(tokens.whitespace(F.col("text"))).alias("tokens"))
    zero = lambda n: F.coalesce(n, F.lit(0)).cast("bigint").alias(n)
    return a.join(b, "source", "left").join(c, "source", "left").select("source", "documents", zero("kept"), zero("deduplicated"), zero("tokens"))


def consensus_of(docs: DataFrame, min_sources: int = 2, near: bool = True) -> DataFrame:
    """Consensus of the filtered documents, of near or of equal texts. It reads them before near duplicates are removed,
    since afterwards one copy of each is left."""
    kept = materialize(filtered(docs), "filtered")
    return consensus.minhash_consensus(kept, min_sources) if near else consensus.hash_consensus(kept, min_sources)


STAGES = ["download", "filter", "minhash", "consensus", "reports"]


def keyed(df: DataFrame) -> DataFrame:
    """Standard rows with a key that is the same on every read: the text's digest and the source."""
    return df.select("text", "id", "source", F.concat_ws(":", F.md5(F.coalesce("text", F.lit("")).cast("binary")), F.coalesce("source", F.lit(""))).alias("doc_id"))


def run(spark: SparkSession, root: str, lang: str, stages: list[str], limit: int | None = None, source_dir: str | None = None, out_dir: str | None = None, tokenizer: tokens.Tokenizer = tokens.whitespace) -> list[str]:
    """Runs stages over ``root/{lang}/...`` and returns what was written (for ``download`` the commands to run).

    Every stage reads what the one before wrote: ``downloads/{source}``, ``filtered``, ``deduped``, ``consensus``,
    ``reports``; token counts of each stage go to the log ``root/token_log``. ``source_dir`` is read by the first stage
    in place of its usual folder, ``out_dir`` is written by the last.
    """
    at, made = f"{root.rstrip('/')}/{lang}", []
    place = {"downloads": f"{at}/downloads", "filtered": f"{at}/filtered", "deduped": f"{at}/deduped", "consensus": f"{at}/consensus", "reports": f"{at}/reports"}
    reads = {"filter": "downloads", "minhash": "filtered", "consensus": "filtered", "reports": "deduped"}
    writes = {"filter": "filtered", "minhash": "deduped", "consensus": "consensus", "reports": "reports"}
    real = [s for s in stages if s != "download"]
    if source_dir and real:
        place[reads[real[0]]] = source_dir
    if out_dir and real:
        place[writes[real[-1]]] = out_dir
    standard = lambda path: readers.parquet_folder(spark, path, readers.STANDARD_SCHEMA)

    def log(path: str, stage: str) -> None:
        tokens.write_log(f"{root.rstrip('/')}/token_log", tokens.stage_log(standard(path).withColumn("lang", F.lit(lang)), stage, tokenizer))

    for stage in stages:
        if stage == "download":
            made += registry.fetch_commands(lang)
            continue
        out = place[writes[stage]]
        if stage == "filter":
            df = readers.sourced_folder(spark, place["downloads"])
            kept = quality.annotate(df if limit is None else df.limit(limit), PROFILES[lang]).where("reject_reason is null")
            writers.write_standard(kept.selectExpr("filtered_text as text", "source"), out)
            log(out, "filtered")
        elif stage == "minhash":
            rows = dedup.minhash_dedup(keyed(standard(place["filtered"]))).dropDuplicates(["doc_id"])
            rows.select("text", "id", "source").write.option("compression", "zstd").parquet(out)
            log(out, "deduped")
        elif stage == "consensus":
            writers.write_consensus(consensus.minhash_consensus(keyed(standard(place["filtered"])).dropDuplicates(["doc_id"])), out)
        else:
            rows = relational.union_null_fill(standard(place["deduped"]))
            writers.json_report(tokens.token_count(rows, tokenizer), f"{out}/tokens.json", language=lang)
            writers.json_report(overlap.pairwise_overlap(standard(place["filtered"])), f"{out}/overlap.json", language=lang)
        made.append(out)
    return made
