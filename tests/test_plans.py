"""Every query with a SQL twin against DuckDB on the smallest data."""

import duckdb
import pytest

from folioforge.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect()]
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    order = [columns.index(c) for c in sorted(columns)]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(got) == sorted(tuple(str(r[i]) for i in order) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_a_twin_run(spark, name):
    df = QUERIES[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    assert len(df.columns) == len(set(df.columns))
