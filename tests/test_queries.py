"""Every query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(df: pd.DataFrame) -> list:
    def value(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
            return ""
        if isinstance(x, bool):
            return str(x)
        if isinstance(x, (int, float)):
            return repr(float(x))
        return str(x)[:10] if hasattr(x, "isoformat") else str(x)

    return sorted(tuple(value(x) for x in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_is_its_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
