"""The named queries of the core and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.profiles import LENIENT_ARABIC, PROFILES, LanguageProfile
from ..operators import compaction, consensus, dedup, overlap, quality, relational, tokens
from ..session import fresh_path
from ..sources import readers, registry, writers
from ..streaming import stream
from . import oracle, pipeline

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, near-duplicate removal and yield by source."""
    return pipeline.yields(table(spark, sf_dir, "documents"))


def _docs(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: make(table(s, d, "documents"))


def _consensus(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: make(table(s, d, "consensus_docs"))


def _judged(p: LanguageProfile) -> Query:
    return _docs(lambda t: quality.annotate(t.select("doc_id", "text"), p).select("doc_id", "reject_reason", "filtered_text"))


def _joined(df: DataFrame, column: str = "sources", to: str = "sources") -> DataFrame:
    """A list as text, so that any engine's rows compare."""
    return df.withColumn(column, F.array_join(column, ",")).withColumnRenamed(column, to)


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _script_ratios(t: DataFrame) -> DataFrame:
    return t.select("doc_id", *(F.round(T.ratio(T.class_count(_text(), p.script), T.letter_count(_text())), 6).alias(k) for k, p in PROFILES.items()))


def _specific_ratios(t: DataFrame) -> DataFrame:
    return t.select("doc_id", *(F.round(T.ratio(T.class_count(_text(), PROFILES[k].specific), T.letter_count(_text())), 6).alias(k) for k in ("tr", "it")))


def _without_citations(t: DataFrame) -> DataFrame:
    return t.select("doc_id", *(F.regexp_replace("text", p.citation.replace(r"\d", r"\p{Nd}"), "").alias(k) for k, p in PROFILES.items()))


def _lines(t: DataFrame) -> DataFrame:
    rows = t.where("text is not null").select("doc_id", F.posexplode(T.lines(F.col("text"))).alias("line_no", "line"))
    return rows.select("doc_id", "line_no", "line", T.word_count(F.col("line")).alias("words"))


def _dup_ratio(t: DataFrame) -> DataFrame:
    rows = T.bind(t.select("doc_id", "text"), k=T.lines(_text()))
    return rows.select("doc_id", F.round(T.ratio(T.duplicate_chars(F.col("k")), T.total_length(F.col("k"))), 6).alias("dup_ratio"))


def _shingles(t: DataFrame) -> DataFrame:
    return dedup.shingles(t).groupBy(F.col("doc").alias("doc_id")).agg(F.count("*").alias("shingles"), F.min("s").alias("first"))


def _participation(t: DataFrame) -> DataFrame:
    return consensus.participation(consensus.hash_consensus(t))


def _written(df: DataFrame, write: Callable[[DataFrame, str], None], schema: str = readers.STANDARD_SCHEMA) -> DataFrame:
    """What a sink wrote, read back."""
    path = fresh_path(df.sparkSession, "sink")
    write(df, path)
    return readers.parquet_folder(df.sparkSession, path, schema)


def _as_json(t: DataFrame, ending: str, read: Callable) -> DataFrame:
    """The texts as packed JSON lines in files of the given ending, read back."""
    spark, path = t.sparkSession, fresh_path(t.sparkSession, "json")
    t.select("text").write.option("compression", "gzip" if ending.endswith("gz") else "none").json(path)
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for i, f in enumerate(fs.listStatus(at(path))):
        if f.getPath().getName().startswith("part-"):
            fs.rename(f.getPath(), at(f"{path}/lines{i}{ending}"))
    return read(spark, path)


def _appended(t: DataFrame, path: str) -> None:
    writers.write_standard(t, path)
    writers.write_standard(t, path, source="again", mode="append")


def _registry(spark: SparkSession, _: str) -> DataFrame:
    """The public corpora and the patterns their files are fetched by."""
    rows = [(lang, c.repo, c.subset, c.output, c.include) for lang in registry.CORPORA for c in registry.corpora(lang)]
    return spark.createDataFrame(rows, "lang string, repo string, subset string, output string, include string")


def _reported(t: DataFrame) -> DataFrame:
    """A report file, read back."""
    path = f"{fresh_path(t.sparkSession, 'report')}/tokens.json"
    writers.json_report(tokens.token_count(t), path, table="documents")
    return t.sparkSession.read.option("multiLine", "true").schema("rows array<struct<source: string, tokens: bigint, documents: bigint>>").json(path).select(F.inline("rows"))


def _subsets(t: DataFrame) -> DataFrame:
    """The folders that a table written by source has."""
    path = fresh_path(t.sparkSession, "subsets")
    t.select("doc_id", "source").write.partitionBy("source").parquet(path)
    return t.sparkSession.createDataFrame([(n,) for n in readers.subsets(t.sparkSession, path)], "subset string")


def _scored(t: DataFrame) -> DataFrame:
    """All optional rules with a made-up score of the language."""
    rows = t.select("doc_id", "text", (F.pmod(F.col("doc_id"), F.lit(100)) / 100.0).alias("lang_score"))
    return quality.annotate(rows, PROFILES["it"].with_optional_rules()).select("doc_id", "reject_reason")


def _rejected(t: DataFrame) -> DataFrame:
    """What the exclusion sink wrote."""
    path = fresh_path(t.sparkSession, "rejected")
    writers.split_rejected(quality.annotate(t.select("doc_id", "text"), PROFILES["it"]), f"{path}/kept", f"{path}/rejected")
    return t.sparkSession.read.parquet(f"{path}/rejected").select("doc_id", "reject_reason")


def _consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(df: DataFrame, path: str) -> None:
        df.select("text", "id", "source").repartition(40).write.parquet(path)
        writers.consolidate(spark, path, 4)

    return _written(table(spark, sf_dir, "standard_docs"), write)


def _summary(t: DataFrame) -> DataFrame:
    return tokens.language_summary(tokens.stage_log(t, "filtered"))


def _logged(t: DataFrame) -> DataFrame:
    """A log of two runs of a stage, the second over other texts, and of another stage."""
    path = fresh_path(t.sparkSession, "log")
    for stage, rows in (("filtered", t), ("filtered", t.where("length(text) > 200")), ("deduped", t)):
        tokens.write_log(path, tokens.stage_log(rows, stage))
    return tokens.read_log(t.sparkSession, path).drop("logged_at")


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "dup_pairs")
    points = p.select(F.col("task1").alias("task"), F.col("doc1").cast("bigint").alias("doc")).unionAll(p.select("task2", F.col("doc2").cast("bigint")))
    return relational.look_up(points, table(spark, sf_dir, "file_info"))


def _streamed(make: Callable[[DataFrame], DataFrame]) -> Query:
    """A stream over the table's files, worked off to the end; returns what it wrote."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fresh_path(spark, "stream")
        source = table(spark, sf_dir, "documents")
        rows = make(spark.readStream.schema(source.schema).parquet(f"{sf_dir}/documents.parquet*"))
        stream.write_available(rows, f"{out}/rows", f"{out}/state").awaitTermination()
        return spark.read.schema(rows.schema).parquet(f"{out}/rows")

    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "p6_found": lambda s, d: compaction.compacted_keys(table(s, d, "small_files")),
        "p6_records": lambda s, d: compaction.compacted_records(table(s, d, "small_files")),
        "q_flagship": flagship,
        "q_scan_standard": _docs(lambda t: t.select("doc_id", "text", "lang", "source", "domain")),
        "q_row_counts": lambda s, d: readers.row_counts(s, f"{d}/documents.parquet"),
        "q_json_lines": _docs(lambda t: _as_json(t, ".json.gz", readers.json_lines)),
        "q_json_chunks": _docs(lambda t: _as_json(t, "_chunk", readers.chunked_json_lines)),
        "q_file_source": lambda s, d: table(s, d, "file_info").select("filepath", readers.path_source(F.col("filepath")).alias("folder")).where(F.coalesce("folder", F.lit("")) != readers.SKIPPED),
        "q_source_normalize": _docs(lambda t: t.select("doc_id", F.array_join(T.source_list(F.col("source")), ",").alias("sources"))),
        "q_convert_standard": _docs(lambda t: readers.convert(t, "web", keep_empty=True)),
        "q_doc_id": _docs(lambda t: t.select("doc_id", T.doc_id(F.col("text")).alias("id"))),
        "q_script_ratio": _docs(_script_ratios),
        "q_specific_char_ratio": _docs(_specific_ratios),
        "q_remove_citations": _docs(_without_citations),
        "q_line_explode": _docs(_lines),
        "q_char_dup_ratio": _docs(_dup_ratio),
        "q_char_repetition": _docs(lambda t: t.select("doc_id", T.has_char_run(_text()).alias("repeats"))),
        "q_lang_repetition": _docs(lambda t: t.select("doc_id", *(_text().rlike(p.laughter).alias(k) for k, p in PROFILES.items()))),
        "q_shingles": _docs(_shingles),
        "q_reject_reason_histogram": _docs(lambda t: quality.reason_histograms(t, PROFILES)),
        "q_line_drop_histogram": _docs(lambda t: quality.line_drop_histograms(t, PROFILES)),
        "q_quality_lenient_ar": _judged(LENIENT_ARABIC),
        "q_quality_letters_it": _judged(replace(PROFILES["it"], min_specific_ratio=oracle.ITALIAN_LETTERS)),
        "q_rejected": _docs(_rejected),
        "q_quality_optional_it": _judged(PROFILES["it"].with_optional_rules()),
        "q_quality_by_language": _docs(lambda t: quality.annotate_by_language(t.select("doc_id", "lang", "text")).select("doc_id", "reject_reason")),
        "q_hash_sources": _docs(lambda t: _joined(consensus.hash_sources(t))),
        "q_consensus_hash": _docs(lambda t: _joined(consensus.hash_consensus(t), "source")),
        "q_consensus_participation": _docs(_participation),
        "q_source_unique_docs": _docs(overlap.unique_documents),
        "q_pairwise_overlap": _docs(overlap.pairwise_overlap),
        "q_overlap_tokens": _docs(lambda t: overlap.pairwise_overlap(t).where("overlap > 0").select("source_a", "source_b", "tokens")),
        "q_source_intersect": _docs(lambda t: overlap.source_intersect(t, "hplt2", "culturax")),
        "q_source_except": _docs(lambda t: overlap.source_except(t, "hplt2", "culturax")),
        "q_token_count": _docs(tokens.token_count),
        "q_registry": _registry,
        "q_json_report": _docs(_reported),
        "q_subsets": _docs(_subsets),
        "q_quality_lang_score": _docs(_scored),
        "q_token_totals": _docs(tokens.totals),
        "q_tokens_by_source": _consensus(tokens.tokens_by_source),
        "q_pairwise_tokens": _consensus(tokens.pairwise_tokens),
        "q_tokens_of_single_sources": _docs(tokens.tokens_by_source),
        "q_stats_log": _docs(_logged),
        "q_stats_summary": _docs(_summary),
        "q_minhash_signature": _docs(lambda t: dedup.signatures(t).select(F.col("doc").alias("doc_id"), F.array_join(F.col("signature").cast("array<string>"), ",").alias("signature"))),
        "q_minhash_edges": _docs(dedup.minhash_edges),
        "q_components": _docs(dedup.minhash_clusters),
        "q_minhash_dedup": _docs(lambda t: dedup.minhash_dedup(t).select("doc_id", "source")),
        "q_cross_source_edges": _docs(consensus.cross_source_edges),
        "q_minhash_consensus": _docs(lambda t: _joined(consensus.minhash_consensus(t), "source")),
        "q_exact_dedup": _docs(dedup.exact_dedup),
        "q_keep_first_window": _docs(relational.keep_first),
        "q_union_null_fill": lambda s, d: relational.union_null_fill(*(table(s, d, n) for n in ("documents", "standard_docs", "eval_items"))),
        "q_sentence_dedup": _docs(dedup.sentence_dedup),
        "q_cumulative_start": lambda s, d: relational.cumulative_starts(table(s, d, "file_info")),
        "q_address_lookup": _addresses,
        "q_repack_flatten": _consensus(writers.flatten),
        "q_write_standard": _docs(lambda t: _written(t, writers.write_standard)),
        "q_append_standard": _docs(lambda t: _written(t, _appended)),
        "q_write_consensus": _docs(lambda t: _joined(_written(consensus.hash_consensus(t), writers.write_consensus, readers.CONSENSUS_SCHEMA), "source", "source")),
        "q_consolidate": _consolidated,
        "q_repack": _consensus(lambda t: _written(writers.flatten(t), writers.repack)),
        "q_top_sources": _docs(lambda t: t.where("source <> ''").groupBy("source").agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "source").limit(5)),
        "q_stream_quality": _streamed(lambda t: stream.annotate(t.select("doc_id", "text"), PROFILES["it"])),
        "q_stream_exact_dedup": _streamed(lambda t: stream.first_of_content(t).select("id")),
        "q_stream_crawl_counts": lambda s, d: _streamed(stream.crawl_counts)(s, d).withColumn("start", F.date_format("start", "yyyy-MM-dd")),
    }
    for code, p in PROFILES.items():
        out[f"q_quality_filter_{code}"] = _judged(p)
    return out


def oracle_sql() -> dict[str, str]:
    return oracle.sql()
