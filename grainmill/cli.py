"""Command line: ``python -m grainmill.cli VERB ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .functions.profiles import PROFILES
from .operators import compaction, consensus, dedup, overlap, quality, tokens
from .plans import pipeline
from .session import ship
from .sources import readers, registry, writers


def _filter(spark: SparkSession, a: argparse.Namespace) -> None:
    df = readers.sourced_folder(spark, a.input)
    rows = quality.annotate(df if a.limit is None else df.limit(a.limit), PROFILES[a.lang])
    if a.rejected:
        writers.split_rejected(rows, a.output, a.rejected)
    else:
        kept = rows.where("reject_reason is null").selectExpr("filtered_text as text", "source")
        writers.write_standard(kept, a.output)


def _keyed(spark: SparkSession, path: str):
    return pipeline.keyed(readers.parquet_folder(spark, path, readers.STANDARD_SCHEMA))


def _minhash(spark: SparkSession, a: argparse.Namespace) -> None:
    dedup.minhash_dedup(_keyed(spark, a.input)).dropDuplicates(["doc_id"]).select("text", "id", "source").write.option("compression", "zstd").parquet(a.output)


def _consensus(spark: SparkSession, a: argparse.Namespace) -> None:
    df = _keyed(spark, a.input).dropDuplicates(["doc_id"])
    made = consensus.minhash_consensus(df, a.min_sources) if a.method == "minhash" else consensus.hash_consensus(df, a.min_sources)
    writers.write_consensus(made, a.output, a.max_files)


def _sentences(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = dedup.sentence_dedup(_keyed(spark, a.input).dropDuplicates(["doc_id"]), keep=("source",))
    writers.write_standard(rows.select("text", "source"), a.output)


def _overlap(spark: SparkSession, a: argparse.Namespace) -> None:
    writers.json_report(overlap.pairwise_overlap(readers.parquet_folder(spark, a.input, readers.STANDARD_SCHEMA)), a.output, input=a.input)


def _tokens(spark: SparkSession, a: argparse.Namespace) -> None:
    rows, counter = readers.parquet_folder(spark, a.input, limit=a.max_docs), tokens.tokenizer(a.tokenizer)
    if dict(rows.dtypes)["source"].startswith("array"):  # a consensus set: totals, by source and by pair of sources
        writers.json_report(tokens.tokens_by_source(rows, counter), a.output, input=a.input, tokenizer=a.tokenizer, max_docs=a.max_docs, pairs=[r.asDict() for r in tokens.pairwise_tokens(rows, counter).collect()], total=tokens.totals(rows, counter).first().asDict())
        return
    counts = tokens.token_count(rows, counter).cache()
    writers.json_report(counts, a.output, input=a.input, tokenizer=a.tokenizer, max_docs=a.max_docs)
    print(writers.summary(counts, "tokens"))
    if a.log:
        tokens.write_log(a.log, tokens.stage_log(rows.selectExpr("text", "source", f"'{a.lang or 'unknown'}' as lang"), a.stage, counter))


def _stats(spark: SparkSession, a: argparse.Namespace) -> None:
    log = tokens.read_log(spark, a.input)
    if log is None:
        print("nothing is logged yet")
        return
    log = log if a.lang is None else log.where(log.lang == a.lang)
    print(writers.summary(log.drop("logged_at"), "tokens", 3))
    print(writers.summary(tokens.language_summary(log).drop("sources"), "tokens", 2))


def _pipeline(spark: SparkSession, a: argparse.Namespace) -> None:
    stages = pipeline.STAGES if a.stage == "all" else [a.stage]
    if a.dry_run:
        stages = ["download"]
    print("\n".join(pipeline.run(spark, a.root, a.lang, stages, a.limit, a.input_dir, a.output_dir, tokens.tokenizer(a.tokenizer))))


def _convert(spark: SparkSession, a: argparse.Namespace) -> None:
    read = {"parquet": readers.parquet_folder, "jsonl": readers.json_lines, "chunks": readers.chunked_json_lines}[a.format]
    readers.convert(read(spark, a.input), a.source, keep_empty=a.format == "parquet").write.option("compression", "zstd").parquet(a.output)


def _compact(spark: SparkSession, a: argparse.Namespace) -> None:
    bodies = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(a.input).selectExpr("value as body", "1 as attempt")
    compaction.compact(bodies, a.output, a.target_mb << 20)


def _consolidate(spark: SparkSession, a: argparse.Namespace) -> None:
    writers.consolidate(spark, a.input, a.max_files)


def _repack(spark: SparkSession, a: argparse.Namespace) -> None:
    df = readers.parquet_folder(spark, a.input)
    lists = dict(df.dtypes)["source"].startswith("array")
    writers.repack(writers.flatten(df) if lists else df.select("text", "id", "source"), a.output, a.max_mb << 20)


def _commands(_: SparkSession, a: argparse.Namespace) -> None:
    print("\n".join(registry.fetch_commands(a.lang)))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="grainmill")
    verbs = p.add_subparsers(dest="verb", required=True)

    def verb(name: str, run, *options: tuple) -> None:
        v = verbs.add_parser(name)
        v.set_defaults(run=run)
        for flag, kw in options:
            v.add_argument(flag, **kw)

    at, to, lang = ("input", {}), ("output", {}), ("--lang", {"choices": list(PROFILES), "required": True})
    verb("filter", _filter, at, to, lang, ("--limit", {"type": int}), ("--rejected", {}))
    verb("minhash", _minhash, at, to)
    verb("consensus", _consensus, at, to, ("--method", {"choices": ["minhash", "hash"], "default": "minhash"}), ("--min-sources", {"type": int, "default": 2}), ("--max-files", {"type": int, "default": 10}))
    verb("sentences", _sentences, at, to)
    verb("overlap", _overlap, at, to)
    counter = ("--tokenizer", {"default": "words", "help": "words, or a vocabulary file (.tiktoken, .model, .json)"})
    verb("tokens", _tokens, at, to, counter, ("--max-docs", {"type": int}), ("--log", {}), ("--lang", {}), ("--stage", {"default": "unknown"}))
    verb("stats", _stats, at, ("--lang", {}))
    verb("pipeline", _pipeline, ("root", {}), lang, ("--stage", {"choices": [*pipeline.STAGES, "all"], "default": "all"}), ("--limit", {"type": int}), ("--input-dir", {}), ("--output-dir", {}), ("--dry-run", {"action": "store_true"}), counter)
    verb("convert", _convert, at, to, ("--source", {"required": True}), ("--format", {"choices": ["parquet", "jsonl", "chunks"], "default": "parquet"}))
    verb("compact", _compact, at, to, ("--target-mb", {"type": int, "default": 128}))
    verb("consolidate", _consolidate, at, ("--max-files", {"type": int, "default": 10}))
    verb("repack", _repack, at, to, ("--max-mb", {"type": int, "default": 280}))
    verb("fetch-commands", _commands, lang)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if args.verb != "fetch-commands" and spark is None:
        spark = SparkSession.builder.appName("grainmill").getOrCreate()
        ship(spark)
    args.run(spark, args)


if __name__ == "__main__":
    main()
