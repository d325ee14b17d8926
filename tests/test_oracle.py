"""Every registered query against its SQL, on the smallest test data."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SF
from tillwright.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


def in_order(rows):
    return sorted(rows, key=lambda row: [(x is None, str(x)) for x in row])


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)
    return a == b


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    sql = driver.oracle_sql()[name]
    kinds = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema} == kinds
    columns = sorted(df.columns)
    have = in_order(tuple(row[c] for c in columns) for row in df.collect())
    result = duck.execute(sql)
    at = [[d[0] for d in result.description].index(c) for c in columns]
    want = in_order(tuple(row[i] for i in at) for row in result.fetchall())
    assert len(have) == len(want)
    for mine, theirs in zip(have, want, strict=True):
        assert all(map(same, mine, theirs)), (columns, mine, theirs)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:2] == ["sale_date", "country"] and df.count() > 0
