"""Every registered query with SQL gives the same rows as DuckDB on the same tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from rosterlens import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_same_as_sql(spark, data, duck, name):
    df = catalogue.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    mine = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    got = duck.execute(catalogue.ORACLE_SQL[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert mine == sorted((tuple(_plain(row[i]) for i in at) for row in got.fetchall()), key=repr)


def test_entry_has_no_python_udf(spark, data):
    assert os.path.exists(data)
    plan = catalogue.QUERIES["composite_score"](spark, data)._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
