"""Every query that SQL can express, next to its SQL in DuckDB; and the pipeline against its parts."""

import math
from pathlib import Path

import duckdb
import pytest

from tillwright.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    want = db.execute(ORACLE[name])
    columns = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(c) for c in columns]
    rows = sorted((tuple(r[k] for k in order) for r in want.fetchall()), key=repr)
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert len(got) == len(rows)
    for a, b in zip(got, rows):
        assert all(x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12)) for x, y in zip(a, b)), (a, b)
