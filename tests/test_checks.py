import pytest

from pyspark.sql.types import StructType

from conftest import rows
from tillwright.operators import checks

EXPECTED = [
    ("raw.sales_retail", 2847293, 365), ("raw.pos_transactions", 15000000, 730), ("retail.dim_date", 73049, None),
    ("retail.returns_ledger", 500000, None), ("regional.events_eu", 1200000, 180),
]
SCHEMA = "table string, row_count bigint, partition_count bigint"


def test_parity(make):
    actual = [(t, r - (t == "retail.dim_date"), p and p + (t == "regional.events_eu")) for t, r, p in EXPECTED]
    have, want = make([*actual, ("raw.new", 1, 1)], SCHEMA), make(EXPECTED, SCHEMA)
    found = {r.table: r.status for r in checks.check_rows(have, want).collect()}
    assert found["retail.dim_date"] == "FAIL" and found["raw.new"] == "SKIPPED"
    assert sorted(found.values()) == ["FAIL", "PASS", "PASS", "PASS", "PASS", "SKIPPED"]
    found = {r.table: r.status for r in checks.check_partitions(have, want).collect()}
    assert found == {
        "raw.sales_retail": "PASS", "raw.pos_transactions": "PASS", "regional.events_eu": "FAIL", "raw.new": "SKIPPED",
    }
    assert checks.summary(have, want).count() == 5


def test_profile_counts_distinct_tuples_and_ignores_null_partitions(make):
    df = make([(2024, 1), (2024, 1), (2024, 2), (None, 2)], "y int, m int")
    out = checks.profile({"t": (df, ["y", "m"]), "plain": (df, []), "empty": (df.limit(0), ["y"])})
    assert rows(out) == [("empty", 0, 0), ("plain", 4, None), ("t", 4, 2)]


def test_null_keys(make):
    df = make([(1, None), (None, None), (3, "x")], "a int, b string")
    out = rows(checks.null_keys(df, ["a", "b"], {"b": 2}))
    assert out == [("a", 1, 0, "FAIL"), ("b", 2, 2, "PASS")]


def test_conformance(make):
    df = make([("1", "2024-01-01", '{"a":1}'), ("x", "2024-13-01", "{"), (None, None, None)], "n string, d string, j string")
    shape = StructType.fromDDL("n bigint, d date, j string")
    assert rows(checks.conformance(df, shape, ["j"]), "column", "bad_values", "status") == [
        ("d", 1, "FAIL"), ("j", 1, "FAIL"), ("n", 1, "FAIL"),
    ]


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_counts_come_from_footers(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    rows_ = spark.range(100).selectExpr("id", "CASE WHEN id % 10 > 0 THEN id % 3 END AS part", "CASE WHEN id % 2 = 0 THEN id END AS v")
    rows_.write.partitionBy("part").format(kind).save(path)
    with checks.counts_from_footers(spark):
        df = checks.partition_counts(spark, path, kind, ["part"])
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = {r.part: r.row_count for r in df.collect()}
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [part]" in plan
    assert found == {r.part: r["count"] for r in rows_.groupBy("part").count().collect()} and found[None] == 10
    got = checks.stored_profile(spark, {"t": (path, kind, ["part"]), "all": (path, kind, [])}).collect()
    assert [tuple(r) for r in got] == [("t", 100, 3), ("all", 100, None)]
    # what is read outside goes by the usual readers again
    assert "PushedAggregation" not in checks.partition_counts(spark, path, kind, ["part"])._jdf.queryExecution().executedPlan().toString()


def test_stored_profile_of_text_scans(spark, tmp_path):
    spark.range(7).selectExpr("CAST(id AS STRING) AS value", "id % 2 AS part").write.partitionBy("part").text(str(tmp_path / "t"))
    got = checks.stored_profile(spark, {"t": (str(tmp_path / "t"), "text", ["part"])}).first()
    assert (got.row_count, got.partition_count) == (7, 2)
