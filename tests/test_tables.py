import gzip
import json
from datetime import datetime

import pytest

from grainmill.functions.profiles import PROFILES
from grainmill.operators import overlap, quality, relational, tokens
from grainmill.sources import readers, registry, writers
from grainmill.streaming import stream


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


ROWS = [(1, "uno due", "a"), (2, "Uno  due", "b"), (3, "tre quattro cinque", "a"), (4, "sei", "b"), (5, "sette", "c"), (6, "", "c"), (7, None, "a"), (8, "uno due", None)]


def test_overlap_lists_every_pair(spark):
    got = {(r.source_a, r.source_b): r for r in overlap.pairwise_overlap(docs(spark, ROWS)).collect()}
    assert {k: v.overlap for k, v in got.items()} == {("a", "b"): 1, ("a", "c"): 0, ("b", "c"): 0}
    assert got["a", "b"].pct_of_a == 50.0
    assert got["a", "b"].tokens == 2
    assert [r[0] for r in overlap.source_intersect(docs(spark, ROWS), "a", "b").collect()] == [r[0] for r in overlap.source_intersect(docs(spark, ROWS), "b", "a").collect()]
    assert overlap.source_except(docs(spark, ROWS), "a", "b").count() == 1
    assert {r.source: r.documents for r in overlap.unique_documents(docs(spark, ROWS)).collect()} == {"a": 2, "b": 2, "c": 1}


def test_token_counts(spark):
    got = {r.source: (r.tokens, r.documents) for r in tokens.token_count(docs(spark, ROWS)).collect()}
    assert got == {"a": (5, 3), "b": (3, 2), "c": (1, 2), None: (2, 1)}
    assert tuple(tokens.totals(docs(spark, ROWS)).first()) == (11, 8)
    by_char = tokens.pandas_tokenizer(lambda: len)
    assert tokens.totals(docs(spark, ROWS), by_char).first().tokens == sum(len(t or "") for _, t, _ in ROWS)
    assert writers.summary(tokens.token_count(docs(spark, ROWS)), "tokens").splitlines()[-1].split() == ["total", "11", "8"]
    empty = docs(spark, [])
    assert tuple(tokens.totals(empty).first()) == (0, 0)


def test_source_lists(spark):
    rows = [("a b", ["y", "x", "x"]), ("c", ["x"]), ("d e f", None), ("g", [None, ""]), (None, ["z", "y", "x"])]
    df = spark.createDataFrame(rows, "text string, source array<string>")
    assert {r.source: (r.tokens, r.documents) for r in tokens.tokens_by_source(df).collect()} == {"x": (3, 3), "y": (2, 2), "z": (0, 1), "unknown": (4, 2)}
    assert {r.pair: (r.tokens, r.documents) for r in tokens.pairwise_tokens(df).collect()} == {"x|y": (2, 2), "x|z": (0, 1), "y|z": (0, 1)}


def test_statistics_log(spark):
    df = docs(spark, ROWS).selectExpr("*", "'it' as lang")
    log = tokens.stage_log(df, "filtered")
    again = tokens.upsert_log(log, tokens.stage_log(df.where("source = 'a'"), "filtered"))
    assert again.count() == log.count()
    assert tokens.upsert_log(log, tokens.stage_log(df, "deduped")).count() == 2 * log.count()
    assert tuple(tokens.language_summary(log).first()) == ("it", "filtered", 4, 11, 8)


def test_addresses(spark):
    files = spark.createDataFrame([(0, "f0", "a", 3, 0), (0, "f1", "b", 2000, 3), (0, "f2", "b", 0, 2003), (1, "f3", "c", 1, 0), (0, "f1", "b", 2000, 3)], "task_rank int, filepath string, source string, num_rows bigint, cumulative_start bigint")
    points = spark.createDataFrame([(0, 0), (0, 2), (0, 3), (0, 2002), (0, 2003), (1, 0), (2, 0), (None, 1), (0, -1)], "task bigint, doc bigint")
    got = {(r.task, r.doc): (r.filepath, r.row) for r in relational.look_up(points, files).collect()}
    assert got == {(0, 0): ("f0", 0), (0, 2): ("f0", 2), (0, 3): ("f1", 0), (0, 2002): ("f1", 1999), (1, 0): ("f3", 0)}
    starts = {r.filepath: r.start for r in relational.cumulative_starts(files).collect()}
    assert starts == {"f0": 0, "f1": 3, "f2": 2003, "f3": 0}


def test_union_and_keep_first(spark):
    a, b = docs(spark, ROWS), spark.createDataFrame([("x", 1)], "text string, other int")
    rows = relational.union_null_fill(a, b).collect()
    assert len(rows) == 9
    assert rows[-1].asDict() == {"text": "x", "id": None, "source": None}
    assert {r.doc_id for r in relational.keep_first(a).collect()} == {1, 3, 4, 5, 6}


def test_sinks_and_readers(spark, tmp_path):
    df = docs(spark, ROWS)
    out = str(tmp_path / "standard")
    writers.write_standard(df, out, rows_per_file=2)
    writers.write_standard(df, out, source="extra", mode="append")
    back = readers.parquet_folder(spark, out, readers.STANDARD_SCHEMA)
    assert back.columns == ["text", "id", "source"]
    assert back.count() == 12
    assert sum(r.rows for r in readers.row_counts(spark, out).collect()) == 12
    writers.consolidate(spark, out, 2)
    assert readers.parquet_folder(spark, out).count() == 12
    assert readers.row_counts(spark, out).count() <= 2
    assert readers.parquet_folder(spark, out, limit=3).count() == 3

    lists = spark.createDataFrame([("t", "i", ["b", "a"]), ("u", "j", None)], readers.CONSENSUS_SCHEMA)
    writers.write_consensus(lists, str(tmp_path / "consensus"), 1)
    assert readers.parquet_folder(spark, str(tmp_path / "consensus"), readers.CONSENSUS_SCHEMA).orderBy("id").first().source == ["a", "b"]
    writers.repack(writers.flatten(lists), str(tmp_path / "repacked"))
    assert {r.source for r in readers.parquet_folder(spark, str(tmp_path / "repacked")).collect()} == {"b,a", "consensus"}
    assert writers.rows_per_file(df) == writers.MAX_ROWS
    writers.json_report(tokens.totals(df), tmp_path / "r.json", lang="it")
    assert json.loads((tmp_path / "r.json").read_text())["rows"] == [{"tokens": 11, "documents": 8}]


def test_sources_by_folder(spark, tmp_path):
    for name in ("c4", "misc"):
        docs(spark, ROWS).select("text").coalesce(1).write.parquet(str(tmp_path / "data" / name))
    assert readers.subsets(spark, str(tmp_path / "data")) == ["c4", "misc"]
    assert readers.subsets(spark, str(tmp_path / "data" / "c4")) == ["default"]
    got = readers.sourced_folder(spark, str(tmp_path / "data")).groupBy("source").count().collect()
    assert [tuple(r) for r in got] == [("c4", 8)]


def test_json_lines(spark, tmp_path):
    lines = ['{"text": "uno", "x": 1}', "kaputt", '{"text": ""}', "[1]", '{"text": null}', '{"text": "due"}', '{"other": 1}']
    with gzip.open(tmp_path / "a.json.gz", "wt", encoding="utf-8") as f:
        f.write("\n".join(lines))
    assert sorted(r.text for r in readers.json_lines(spark, str(tmp_path)).collect()) == ["due", "uno"]
    (tmp_path / "sea").mkdir()
    (tmp_path / "sea" / "x_chunk_1").write_text("\n".join(lines))
    assert readers.chunked_json_lines(spark, str(tmp_path / "sea")).count() == 2
    (tmp_path / "sea" / "y.jsonl").write_text(lines[0])
    assert readers.chunked_json_lines(spark, str(tmp_path / "sea")).count() == 1
    assert readers.convert(readers.chunked_json_lines(spark, str(tmp_path / "sea")), "sea").first().source == "sea"


def test_rejected_rows_go_their_own_way(spark, tmp_path):
    rows = quality.annotate(docs(spark, ROWS), PROFILES["it"])
    writers.split_rejected(rows, str(tmp_path / "kept"), str(tmp_path / "rejected"))
    assert readers.parquet_folder(spark, str(tmp_path / "kept"), "text string").count() == 0
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == 8


@pytest.mark.parametrize(("repo", "subset", "expected"), [("HPLT/HPLT2.0_cleaned", "ita_Latn", "ita_Latn/*"), ("HuggingFaceFW/fineweb-2", "x", "data/x/*"), ("allenai/c4", "it", "multilingual/c4-it*"), ("vngrs-ai/vngrs-web-corpus", None, None)])
def test_include_patterns(repo, subset, expected):
    assert registry.include_pattern(repo, subset) == expected


def test_registry():
    assert {k: len(registry.corpora(k)) for k in registry.CORPORA} == {"ar": 7, "tr": 5, "hi": 6, "it": 4, "th": 5}
    assert all(c.startswith("huggingface-cli download") for c in registry.fetch_commands("th"))


def test_streams(spark, tmp_path):
    at = datetime(2025, 1, 5)
    rows = [(i, t, s, at, at) for i, t, s in ROWS]
    schema = "doc_id bigint, text string, source string, crawled_at timestamp, ingested_at timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))

    def run(name, made):
        stream.write_available(made, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()
        return spark.read.schema(made.schema).parquet(str(tmp_path / name))

    source = lambda: stream.read_folder(spark, str(tmp_path / "in"), schema)
    assert run("quality", stream.annotate(source(), PROFILES["it"])).count() == 8
    assert run("first", stream.first_of_content(source())).count() == 5
    run("counts", stream.crawl_counts(source()))


def test_streamed_counts_are_whole(spark, tmp_path):
    """Open windows, rows far behind the others and rows without a time count too, over several triggers and a restart."""
    schema = "doc_id bigint, text string, source string, crawled_at timestamp"
    late, new = datetime(2024, 1, 5), datetime(2025, 4, 5)
    path = tmp_path / "in"

    def add(name, times):
        rows = [(i, "t", ("a", "b", None)[i % 3], at) for i, at in enumerate(times)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path / name))

    def run():
        made = stream.crawl_counts(stream.read_folder(spark, str(path), schema, files_per_trigger=1))
        stream.write_available(made, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        got = spark.read.schema(made.schema).parquet(str(tmp_path / "out")).collect()
        assert len({(r.start, r.source) for r in got}) == len(got)
        assert all(r.start is None or r.start.weekday() == 3 for r in got)  # windows of 7 days start on Thursdays
        return {(r.start, r.source): r.documents for r in got}

    add("x", [new, new, None, new, datetime(1970, 1, 2)])
    add("y", [late, late, None, new])
    first = {(datetime(2025, 4, 3), "a"): 3, (datetime(2025, 4, 3), "b"): 1, (None, None): 2, (datetime(1970, 1, 1), "b"): 1}
    first |= {(datetime(2024, 1, 4), "a"): 1, (datetime(2024, 1, 4), "b"): 1}
    assert run() == first
    assert run() == first
    add("z", [late, None])
    assert run() == first | {(datetime(2024, 1, 4), "a"): 2, (None, "b"): 1}


def test_streamed_contents_in_any_order_of_time(spark, tmp_path):
    """A content behind the others' times isn't lost, and copies far apart are one, over several triggers and a restart."""
    schema = "doc_id bigint, text string, ingested_at timestamp"

    def add(name, *rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def run():
        made = stream.first_of_content(stream.read_folder(spark, str(tmp_path / "in"), schema, files_per_trigger=1))
        stream.write_available(made, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return sorted(r.text for r in spark.read.schema(made.schema).parquet(str(tmp_path / "out")).collect())

    add("x", (1, "uno", datetime(2025, 1, 6)), (2, "due", datetime(2025, 1, 6)))
    assert run() == ["due", "uno"]
    add("y", (3, "uno", datetime(2025, 6, 12)), (4, "tre", datetime(2025, 6, 12)), (5, "tre", None))
    assert run() == ["due", "tre", "uno"]
    add("z", (6, "quattro", datetime(2025, 1, 7)), (7, None, datetime(2025, 1, 7)), (8, "due", datetime(2025, 1, 7)))
    assert run() == ["due", "quattro", "tre", "uno"]
