"""Every registered query against its DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from atlasweave.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def normal(x):
    return repr(round(x, 9)) if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    order = sorted(df.columns)
    got = sorted(tuple(normal(r[c]) for c in order) for r in df.collect())
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == order
    wanted = sorted(tuple(normal(r[columns.index(c)]) for c in order) for r in result.fetchall())
    assert got == wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
