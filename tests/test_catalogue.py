"""Every registered query against its DuckDB oracle (sf0.001), plus entry()."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from titlematch.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["part", "pages", "events", "orders", "lineitem"]


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    sql = ORACLE_SQL[name]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), dcols)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["title", "year", "production_companies", "genres", "rating", "revenue", "budget",
                          "revenue_to_budget", "url", "abstract"]
