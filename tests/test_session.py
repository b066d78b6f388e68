import pytest

from grainmill import session


def test_materialized_tables_lie_in_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}")
    df = session.materialize(spark.range(5), "five")
    assert df.count() == 5
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["five"]
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


def test_the_sessions_folder_comes_first(tmp_path, monkeypatch):
    class Conf(dict):
        pass

    class Session:
        conf = Conf({"spark.checkpoint.dir": "hdfs://x/shared/"})

    monkeypatch.setattr(session, "_own", ["file:///never"])
    assert session.shared_dir(Session()) == "hdfs://x/shared"
    assert session.fresh_path(Session(), "a").startswith("hdfs://x/shared/a-")
    session._written.pop()


def test_only_tiny_tables_are_dealt_out(spark, tmp_path, monkeypatch):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(df).rdd.getNumPartitions() == cores
    assert session.spread(df.join(df.withColumnRenamed("id", "x"), df.id == 1)).columns == ["id", "x"]
    moved = lambda t: "Exchange" in session.spread(t)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(session, "SMALL_TABLE", 10)
    assert moved(df)  # one row group for all cores
    monkeypatch.setattr(session, "BUSY_SHARE", 1 / cores)
    assert not moved(df)
    monkeypatch.setattr(session, "BUSY_SHARE", 1.5 / cores)  # 6 cores at a fourth: two row groups are enough
    assert moved(df)
    spark.range(100).repartition(2).write.parquet(str(tmp_path / "two"))
    assert not moved(spark.read.parquet(str(tmp_path / "two")))
    monkeypatch.setattr(session, "BUSY_SHARE", 0.5)
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "u"))
    assert not moved(spark.read.parquet(str(tmp_path / "u")))
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "v"))
    assert moved(spark.read.parquet(str(tmp_path / "v")))
    spark.range(100).selectExpr("cast(id as string)").coalesce(1).write.text(str(tmp_path / "w"))
    assert not moved(spark.read.text(str(tmp_path / "w")))


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_dir(Session())


def test_measures_are_taken_while_writing(spark):
    from pyspark.sql import functions as F

    out, seen = session.write_step(spark.range(10), "ten", n=F.count("*"), sum=F.sum("id"))
    assert (seen["n"], seen["sum"], out.count()) == (10, 45, 10)
    session.drop_steps(out)
    assert out._step_path not in session._written
