"""Tables that may not be scanned whole, and what a bound does to the scan."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tillwright import catalog
from tillwright.plans import derived, views
from tillwright.plans.adapters import TestTables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    held = catalog.StoredTables(spark, str(tmp_path_factory.mktemp("tables")))
    sessions = derived.fact_web_session(views.omniture(TestTables(spark, SF)))
    sessions.repartition("event_date").write.partitionBy("event_date").parquet(held.path("fact_web_session"))
    return held


def test_eleven_tables_demand_a_bound():
    assert sum(t.must_bound for t in catalog.tables().values()) == 11


def test_a_view_over_an_unbounded_table_refuses(spark):
    t = TestTables(spark, SF)
    for view in (views.vw_daily_sales_by_country, views.vw_monthly_cohort_retention):
        with pytest.raises(ValueError, match="bound"):
            view(catalog.BoundedTables(t))
    year = catalog.BoundedTables(t, {"fact_sales": ("1997-01-01", "1997-12-31")})
    found = views.vw_daily_sales_by_country(year).agg(F.min("sale_date"), F.max("sale_date")).first()
    assert date(1997, 1, 1) <= found[0] <= found[1] <= date(1997, 12, 31)
    # a column of one's own where the partition column is not at hand; tables without the duty pass whole
    shipped = catalog.BoundedTables(t, {"fact_shipments": ("shipped_ts", "1998-01-01", None)})
    assert shipped["fact_shipments"].count() < t["fact_shipments"].count()
    assert shipped["dim_customer"].count() == t["dim_customer"].count()
    with pytest.raises(KeyError):
        catalog.BoundedTables(t, {"fact_nothing": (1, 2)})


def test_bounds_and_a_joined_calendar_prune_partitions(spark, stored):
    with pytest.raises(ValueError):
        catalog.BoundedTables(stored)["fact_web_session"]
    bounded = catalog.BoundedTables(stored, {"fact_web_session": ("2024-01-10", "2024-01-25")})
    days = derived.calendar(spark, "2024-01-01", "2024-01-31").filter("d_dow = 1").select("d_date")
    df = bounded["fact_web_session"].join(days, F.col("event_date") == F.col("d_date")).groupBy("event_date").count()
    run = df._jdf.queryExecution()
    filters = run.executedPlan().toString().split("PartitionFilters")[1]
    assert ">= 2024-01-10" in filters and "<= 2024-01-25" in filters
    assert "dynamicpruning" in run.optimizedPlan().toString()
    assert [r[0] for r in df.orderBy("event_date").collect()] == [date(2024, 1, 15), date(2024, 1, 22)]
