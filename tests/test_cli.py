import json
from pathlib import Path

import pytest

from grainmill import cli
from grainmill.sources import readers

BASE = "Il treno numero {} parte ogni giorno dalla stazione di {} e la gente aspetta con calma il suo turno."
CITIES = "Torino Milano Genova Bari Parma Pisa Siena Lecce Trento Udine".split()


def text(i):
    return "\n".join(BASE.format(100 * i + k, CITIES[(i + k) % 10]) + f" Poi {CITIES[k]} resta lontana {i}." for k in range(4))


@pytest.fixture
def corpus(spark, tmp_path):
    for name, some in (("c4", range(6)), ("hplt2", range(3, 9))):
        spark.createDataFrame([(text(i),) for i in some] + [("corto",)], "text string").coalesce(1).write.parquet(str(tmp_path / "in" / name))
    return tmp_path


def test_from_filter_to_publication(spark, corpus, capsys):
    run = lambda *args: cli.main([str(a) for a in args], spark)
    run("filter", corpus / "in", corpus / "filtered", "--lang", "it")
    filtered = readers.parquet_folder(spark, str(corpus / "filtered"))
    assert filtered.count() == 12
    run("consensus", corpus / "filtered", corpus / "consensus", "--method", "hash")
    made = readers.parquet_folder(spark, str(corpus / "consensus"))
    assert {(r.text, tuple(r.source)) for r in made.collect()} == {(text(i), ("c4", "hplt2")) for i in (3, 4, 5)}
    run("minhash", corpus / "filtered", corpus / "deduped")
    assert readers.parquet_folder(spark, str(corpus / "deduped")).count() <= 9
    run("overlap", corpus / "filtered", corpus / "overlap.json")
    assert json.loads((corpus / "overlap.json").read_text())["rows"][0]["overlap"] == 3
    run("tokens", corpus / "filtered", corpus / "tokens.json")
    assert {r["documents"] for r in json.loads((corpus / "tokens.json").read_text())["rows"]} == {6}
    run("consolidate", corpus / "filtered", "--max-files", 1)
    run("repack", corpus / "consensus", corpus / "published")
    assert readers.parquet_folder(spark, str(corpus / "published")).first().source == "c4,hplt2"
    run("filter", corpus / "in", corpus / "kept", "--lang", "it", "--rejected", corpus / "rejected", "--limit", 100)
    assert spark.read.parquet(str(corpus / "rejected")).count() == 2
    run("fetch-commands", "--lang", "it")
    assert "fineweb-2" in capsys.readouterr().out


def test_compact_and_convert(spark, tmp_path):
    (tmp_path / "small").mkdir()
    for i in range(5):
        (tmp_path / "small" / f"{i}.jsonl").write_text(json.dumps({"rec_key": i % 4, "text": f"t{i % 4}"}) + "\n")
    cli.main(["compact", str(tmp_path / "small"), str(tmp_path / "big")], spark)
    assert readers.parquet_folder(spark, str(tmp_path / "big")).count() == 4
    cli.main(["convert", str(tmp_path / "small"), str(tmp_path / "std"), "--source", "x", "--format", "chunks"], spark)
    assert readers.parquet_folder(spark, str(tmp_path / "std"), readers.STANDARD_SCHEMA).count() == 5


def test_the_whole_pipeline(spark, corpus, capsys):
    root = corpus / "data"
    (root / "it").mkdir(parents=True)
    (corpus / "in").rename(root / "it" / "downloads")
    cli.main(["pipeline", str(root), "--lang", "it"], spark)
    said = capsys.readouterr().out
    assert "fineweb-2" in said
    assert readers.parquet_folder(spark, str(root / "it" / "filtered")).count() == 12
    assert 0 < readers.parquet_folder(spark, str(root / "it" / "deduped")).count() <= 9
    assert readers.parquet_folder(spark, str(root / "it" / "consensus"), readers.CONSENSUS_SCHEMA).count() > 0
    assert {p.name for p in (root / "it" / "reports").iterdir()} == {"tokens.json", "overlap.json"}
    cli.main(["stats", str(root / "token_log"), "--lang", "it"], spark)
    said = capsys.readouterr().out
    assert "deduped" in said and "hplt2" in said
    cli.main(["pipeline", str(root), "--lang", "it", "--stage", "filter", "--limit", "4", "--output-dir", str(corpus / "some")], spark)
    assert readers.parquet_folder(spark, str(corpus / "some")).count() <= 4
    cli.main(["pipeline", str(root), "--lang", "it", "--dry-run"], spark)
    cli.main(["stats", str(corpus / "none")], spark)
    assert "nothing is logged" in capsys.readouterr().out


def test_sentences_keep_the_standard_schema(spark, tmp_path):
    shared = " ".join(f"questa frase condivisa numero {k} si ripete sempre." for k in ("uno", "due", "tre"))
    rows = [(" ".join(text(10 * i + k) for k in range(4)) + " " + shared, "x", f"s{i}") for i in range(3)]
    spark.createDataFrame(rows, readers.STANDARD_SCHEMA).write.parquet(str(tmp_path / "in"))
    cli.main(["sentences", str(tmp_path / "in"), str(tmp_path / "out")], spark)
    got = readers.parquet_folder(spark, str(tmp_path / "out")).collect()
    assert {r.source for r in got} == {"s0", "s1", "s2"}
    assert all(r.id and r.id != "x" and "condivisa" not in r.text for r in got)


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_tokens_by_a_vocabulary(spark, tmp_path, name):
    path = Path("/opt/tokenizers") / name
    if not path.exists():
        pytest.skip("no vocabulary here")
    spark.createDataFrame([("il treno parte", "i", ["a", "b"]), ("ciao", "j", ["b"]), (None, "k", None)], readers.CONSENSUS_SCHEMA).write.parquet(str(tmp_path / "in"))
    cli.main(["tokens", str(tmp_path / "in"), str(tmp_path / "t.json"), "--tokenizer", str(path)], spark)
    report = json.loads((tmp_path / "t.json").read_text())
    by = {r["source"]: r["tokens"] for r in report["rows"]}
    assert by["a"] > 3 and by["b"] > by["a"] and by["unknown"] == 0
    assert report["_metadata"]["pairs"][0]["pair"] == "a|b"
    assert report["_metadata"]["total"]["documents"] == 3
