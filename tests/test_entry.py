"""Registered queries against their SQL, run by DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from siltstone.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, list | tuple):
        return tuple(map(plain, x))
    if isinstance(x, bool):
        return int(x)
    if isinstance(x, int | float) or hasattr(x, "as_tuple"):
        return round(float(x), 6)
    return str(x)


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF).limit(1).count() == 1


def test_flagship(spark):
    assert entry.entry(spark).columns == ["qid", "doc", "rank", "final_score"]
