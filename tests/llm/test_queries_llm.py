"""The queries of the operators for training data against their SQL in another engine, and those without SQL at all."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from grainmill.llm import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def rows(df):
    def cell(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return "null"
        return f"{float(x):.6g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, engine, sf_dir, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), engine.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SQL))
def test_queries_without_sql_run(spark, sf_dir, name):
    if not Path("/opt/tokenizers").exists() and name.startswith(("p1_", "p8_")):
        pytest.skip("no vocabulary here")
    assert QUERIES[name](spark, sf_dir).count() > 0
