"""Token counts. A tokenizer is a function from a text column to a count column; words by blanks are the default."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import snapshots

Tokenizer = Callable[[Column], Column]


def whitespace(text: Column) -> Column:
    """Words; null and empty texts have none."""
    return F.coalesce(T.word_count(text), F.lit(0)).cast("bigint")


def pandas_tokenizer(load: Callable[[], Callable[[str], int]]) -> Tokenizer:
    """A tokenizer from a Python counter, loaded once per worker and fed Arrow batches."""
    loaded: list = []

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        if not loaded:
            loaded.append(load())
        return texts.map(lambda t: loaded[0](t) if t else 0).astype("int64")

    return lambda text: count(F.coalesce(text, F.lit("")))


#: Where rank files cut a text before they merge its bytes; fixed value.
RANK_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer(name: str) -> Tokenizer:
    """``words``, or the file of a vocabulary: ranks (``.tiktoken``), a sentence-piece model (``.model``) or a ``.json``.

    The file is read once on the driver and goes to the workers with the plan.
    """
    if name == "words":
        return whitespace
    with open(name, "rb") as f:
        data = f.read()

    def load() -> Callable[[str], int]:
        if name.endswith(".tiktoken"):
            import base64

            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}
            own = tiktoken.Encoding("own", pat_str=RANK_PATTERN, mergeable_ranks=ranks, special_tokens={})
            return lambda text: len(own.encode_ordinary(text))
        if name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=data)
            return lambda text: len(model.encode(text))
        from tokenizers import Tokenizer as Loaded

        made = Loaded.from_str(data.decode())
        made.encode_special_tokens = True
        return lambda text: len(made.encode(text, add_special_tokens=False).ids)

    return pandas_tokenizer(load)


def token_count(df: DataFrame, tokenizer: Tokenizer = whitespace) -> DataFrame:
    """``source, tokens, documents``; null and empty texts count as documents of 0 tokens."""
    return df.groupBy("source").agg(F.sum(tokenizer(F.col("text"))).alias("tokens"), F.count("*").alias("documents"))


def totals(df: DataFrame, tokenizer: Tokenizer = whitespace) -> DataFrame:
    return df.agg(F.coalesce(F.sum(tokenizer(F.col("text"))), F.lit(0)).cast("bigint").alias("tokens"), F.count("*").alias("documents"))


def _lists(df: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``sources, tokens``: distinct sources without nulls, sorted; none at all is ``unknown``. A single source is a list of one."""
    if dict(df.dtypes)["source"] == "string":
        df = df.select("text", F.array("source").alias("source"))
    clean = F.array_sort(F.array_distinct(F.filter("source", lambda x: x.isNotNull() & (x != ""))))
    unknown = F.array(F.lit("unknown"))
    return df.select(F.when(F.size(clean) > 0, clean).otherwise(unknown).alias("sources"), tokenizer(F.col("text")).alias("tokens"))


def tokens_by_source(df: DataFrame, tokenizer: Tokenizer = whitespace) -> DataFrame:
    """Every source of a document's list gets its full count."""
    return _lists(df, tokenizer).select(F.explode("sources").alias("source"), "tokens").groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"))


def pairwise_tokens(df: DataFrame, tokenizer: Tokenizer = whitespace) -> DataFrame:
    """``pair, tokens, documents``: every unordered pair of a document's sources gets its full count."""
    pairs = F.expr("explode(flatten(transform(sources, (a, i) -> transform(slice(sources, i + 2, size(sources)), b -> concat_ws('|', a, b)))))")
    rows = _lists(df, tokenizer).where(F.size("sources") > 1).select(pairs.alias("pair"), "tokens")
    return rows.groupBy("pair").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"))


def stage_log(df: DataFrame, stage: str, tokenizer: Tokenizer = whitespace) -> DataFrame:
    """``lang, stage, source, tokens, documents``: one stage's rows of the statistics log."""
    rows = df.groupBy("lang", "source").agg(F.sum(tokenizer(F.col("text"))).alias("tokens"), F.count("*").alias("documents"))
    return rows.select("lang", F.lit(stage).alias("stage"), "source", "tokens", "documents")


def upsert_log(log: DataFrame, new: DataFrame) -> DataFrame:
    """The log with the rows of ``new`` in place of those of the same language, stage and source."""
    keys = ["lang", "stage", "source"]
    same = [log[k].eqNullSafe(new[k]) for k in keys]
    return log.join(new, same[0] & same[1] & same[2], "left_anti").unionByName(new)


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """``lang, stage, source, tokens, documents, logged_at``; None before anything was logged."""
    return None if snapshots.facts(spark, path) is None else spark.read.parquet(snapshots.current(spark, path))


def write_log(path: str, new: DataFrame) -> None:
    """Upserts the rows of a stage into the log kept at ``path``; the log is replaced as a whole, atomically."""
    spark = new.sparkSession
    rows, old, at = new.withColumn("logged_at", F.current_timestamp()), read_log(spark, path), snapshots.new_snapshot(path)
    (rows if old is None else upsert_log(old, rows)).coalesce(1).write.parquet(at)  # a row by language, stage and source
    snapshots.commit(spark, path, at)
    snapshots.vacuum(spark, path)


def language_summary(log: DataFrame) -> DataFrame:
    """``lang, stage, sources, tokens, documents``."""
    return log.groupBy("lang", "stage").agg(F.countDistinct(F.coalesce("source", F.lit(""))).alias("sources"), F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents"))
