"""Plans: what reaches the scan, what is shuffled, and what must not appear."""

import re

import pytest

import __spark_entry__ as driver
from conftest import SF
from tillwright.plans import derived, views
from tillwright.plans.adapters import TestTables
from tillwright.plans.queries import QUERIES

# these write a file in the format at hand first, so building them runs jobs
STORED = {n for n in QUERIES if n.endswith("_feed") or n.startswith("stream_")} | {
    "partition_directories", "table_load", "load_report", "clustered_write", "address_history_merged",
    "member_sketches", "stored_profile", "variant_fields", "catalog_scan", "dry_run", "audit_row",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return TestTables(spark, SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF))
    assert not re.search(r"CartesianProduct|NestedLoop|Python|MapIn(Pandas|Arrow)|(Co)?Groups?In(Pandas|Arrow)|BatchEval|ArrowEval", plan)


@pytest.mark.parametrize("name", ["daily_sales_by_country", "customer_ltv", "cohort_retention", "top_countries"])
def test_sales_are_scanned_once(spark, name):
    assert plan_of(driver.queries()[name](spark, SF)).count("lineitem.parquet") == 1


def test_cube_levels_share_one_scan(t):
    df = derived.sales_cube(t["fact_sales"])
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("lineitem.parquet") == 1 and "ReusedExchange" in final


def test_filters_and_columns_reach_the_scan(t):
    plan = plan_of(views.vw_otd_by_carrier_30d(t, "2000-01-01"))
    assert "GreaterThanOrEqual(l_shipdate,1999-12-02" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_linestatus:string,l_shipdate:timestamp>" in plan
    plan = plan_of(views.vw_panel_continuity_score(t, "2001-08-02"))
    assert "GreaterThanOrEqual(o_orderdate,2001-05-04" in plan


def test_latest_row_is_limited_before_the_shuffle(t):
    plan = plan_of(derived.merged_returns_cdc(t["returns_cdc"]))
    assert re.search(r"WindowGroupLimit .*Final.*Exchange.*WindowGroupLimit .*Partial", plan, re.S)


def test_windows_of_ordered_jobs_run_per_slot(t):
    for df in (derived.loyalty_points_ledger(t["fact_loyalty_events"]), derived.sessionised_clicks(t["app_clicks"])):
        assert re.search(r"Exchange hashpartitioning\([^)]*_slot", plan_of(df))


def test_hot_join_key_is_split(spark, make):
    """A third of the orders belongs to one customer: adaptive execution splits that partition."""
    from pyspark.sql import functions as F

    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        orders = spark.range(0, 300_000, 1, 8).select(
            F.col("id").cast("string").alias("order_id"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"),
            F.lit("DE").alias("country_iso2"), F.lit(1).cast("decimal(14,2)").alias("line_total"),
            F.sha2(F.col("id").cast("string"), 256).alias("currency_code"),
            F.timestamp_seconds("id").alias("order_ts"),
        )
        consents = spark.range(100_000).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"),
            F.lit("MARKETING").alias("consent_type"), F.lit(True).alias("granted"),
            F.timestamp_seconds("id").alias("granted_ts"), F.lit(None).cast("timestamp").alias("withdrawn_ts"),
        )
        df = views.v_eu_orders_with_consent({"fact_orders_eu": orders, "dim_gdpr_consent": consents})
        assert len(df.collect()) == 300_000
        assert "skew=true" in plan_of(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_shuffles_grow_with_the_input(spark, t):
    from tillwright import session

    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = session.BYTES_PER_PARTITION
    session.BYTES_PER_PARTITION = 1000
    try:
        total = session.fit_shuffles(spark, t.raw("lineitem"))
        assert int(spark.conf.get(start)) == -(-total // 1000)
        session.fit_shuffles(spark, t.raw("region"))  # never lowered
        assert int(spark.conf.get(start)) == -(-total // 1000)
    finally:
        session.BYTES_PER_PARTITION = before
        spark.conf.unset(start)


def test_views_under_their_names(spark, t):
    from tillwright.plans.register import register_views

    names = register_views(spark, t, "2001-08-02", ("vw_daily_sales_by_country", "vw_sales_rollup_by_region"))
    assert names == ["vw_daily_sales_by_country", "vw_sales_rollup_by_region"]
    top = spark.sql("SELECT country, sum(orders) AS n FROM vw_daily_sales_by_country GROUP BY country")
    assert top.count() == 8


def test_category_chains_double_and_share_exchanges(spark, t):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = views.vw_category_hierarchy_recursive({"dim_category": t["dim_category"]})
        df.collect()
        final = plan_of(df).split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    made = [line for line in final.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert len(made) <= 8 and "ReusedExchange" in final
