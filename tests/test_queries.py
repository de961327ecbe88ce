"""Every registered query with an oracle against DuckDB on the smallest tables; the others must give rows."""

import duckdb
import pandas as pd
import pytest

from strainframe.plans import catalogue

SF = "/root/testdata/sf0.001"
#: Queries without SQL that have no rows on the smallest tables.
LARGER = {"t08_anchor_splits": "/root/testdata/sf0.01"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    return f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(df):
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, LARGER.get(name, SF)).toPandas()
    if name in catalogue.ORACLES:
        want = duck.execute(catalogue.ORACLES[name]).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got), "a query without SQL must give rows"
