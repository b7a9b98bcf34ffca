"""Every query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from quire.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    return sorted((tuple(None if pd.isna(v) else round(float(v), 6) if isinstance(v, float) else v for v in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, sf_dir, duck, name):
    got, want = catalogue.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(catalogue.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs(spark, sf_dir, name):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0


def test_flagship(spark, sf_dir):
    assert catalogue.flagship(spark, sf_dir).count() >= 0
