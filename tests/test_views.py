"""Edge cases of the views on small tables; their full results are compared in test_oracle."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from conftest import rows
from tillwright.plans import views

SALES = (
    "invoice_no string, customer_sk bigint, product_sk bigint, quantity bigint, "
    "line_total decimal(14,2), country string, invoice_ts timestamp, sale_date date"
)


def sale(invoice, customer, total, day, product=1, country="US", quantity=1):
    when = None if day is None else datetime(day.year, day.month, day.day)
    return (invoice, customer, product, quantity, None if total is None else Decimal(total), country, when, day)


def test_daily_sales_of_unknown_invoices_divide_safely(make):
    t = {"fact_sales": make([sale(None, 1, "5.00", date(2024, 1, 1))], SALES)}
    row = views.vw_daily_sales_by_country(t).first()
    assert (row.orders, row.revenue, row.aov, row.basket_size, row.active_customers) == (0, Decimal("5.00"), 0, 0, 1)


@pytest.mark.parametrize(
    "last, bucket",
    [(date(2024, 6, 1), "active"), (date(2024, 5, 1), "warm"), (date(2024, 3, 1), "cold"), (date(2023, 1, 1), "churned")],
)
def test_recency_buckets(make, last, bucket):
    t = {
        "fact_sales": make([sale("I1", 1, "5.00", last), sale("I1", 1, "2.50", last)], SALES),
        "dim_customer": make([(1, "c1", "US"), (2, "c2", "US")], "customer_sk bigint, customer_id string, country string"),
    }
    found = {r.customer_sk: r for r in views.vw_customer_lifetime_value(t, "2024-06-15").collect()}
    assert (found[1].rfm_bucket, found[1].orders, found[1].lifetime_revenue) == (bucket, 1, Decimal("7.50"))
    assert (found[2].rfm_bucket, found[2].orders, found[2].lifetime_revenue, found[2].recency_days) == (
        "never", 0, None, None,
    )


def test_repeated_customer_repeats_its_sales(make):
    t = {
        "fact_sales": make([sale("I1", 1, "5.00", date(2024, 1, 1))], SALES),
        "dim_customer": make([(1, "c1", "US")] * 2, "customer_sk bigint, customer_id string, country string"),
    }
    out = views.vw_customer_lifetime_value(t, "2024-06-15").collect()
    assert [(r.orders, r.lifetime_revenue) for r in out] == [(1, Decimal("10.00"))]


def test_months_are_counted_by_boundary(make):
    data = [sale("a", 1, "1", date(2024, 1, 31)), sale("b", 1, "1", date(2024, 2, 1)), sale("c", None, "1", date(2024, 2, 1))]
    out = views.vw_monthly_cohort_retention({"fact_sales": make(data, SALES)})
    assert rows(out) == [("2024-01", 0, 1), ("2024-01", 1, 1)]


def test_attribution_keeps_sessions_without_order(make):
    events = "user_id string, event_ts timestamp, context struct<referrer:string>"
    t = {
        "mobile_events": make(
            [("u1", datetime(2024, 1, 1), ("ad",)), ("u2", datetime(2024, 1, 1), None), (None, None, None)], events
        ),
        "dim_customer": make([(1, "u1")], "customer_sk bigint, customer_id string"),
        "fact_sales": make(
            [("I1", 1, datetime(2024, 1, 2), Decimal(5)), ("I2", 1, datetime(2024, 1, 2, 0, 0, 1), Decimal(6))],
            "invoice_no string, customer_sk bigint, invoice_ts timestamp, line_total decimal(14,2)",
        ),
    }
    out = views.vw_session_to_order_attribution(t)
    assert rows(out, "user_id", "referrer", "invoice_no") == [("u1", "ad", "I1"), ("u2", None, None), (None, None, None)]


def test_consents_fan_out_and_end(make):
    when = datetime(2024, 1, 10)
    orders = make([("o1", "c1", "DE", Decimal(1), "EUR", when), ("o2", "c2", "DE", Decimal(1), "EUR", when)],
                  "order_id string, customer_id string, country_iso2 string, line_total decimal(14,2), "
                  "currency_code string, order_ts timestamp")  # fmt: skip
    consents = make(
        [
            ("c1", "MARKETING", True, datetime(2024, 1, 1), None),
            ("c1", "MARKETING", True, datetime(2024, 1, 2), datetime(2024, 2, 1)),
            ("c1", "MARKETING", True, datetime(2024, 1, 3), when),  # ends at order time: no longer valid
            ("c1", "ANALYTICS", True, datetime(2024, 1, 4), None),
            ("c2", "MARKETING", False, datetime(2024, 1, 5), None),
        ],
        "customer_id string, consent_type string, granted boolean, granted_ts timestamp, withdrawn_ts timestamp",
    )
    out = views.v_eu_orders_with_consent({"fact_orders_eu": orders, "dim_gdpr_consent": consents})
    found = rows(out, "order_id", "marketing_consent", "consent_granted_ts")
    assert found == [
        ("o1", True, datetime(2024, 1, 1)), ("o1", True, datetime(2024, 1, 2)), ("o2", False, None),
    ]


def test_rollup_tells_null_regions_from_totals(make):
    day = date(2024, 6, 1)
    t = {
        "fact_sales": make([sale("a", 1, "1.00", day), sale("b", 2, "2.00", day), sale("c", 2, "9", date(2024, 1, 1))], SALES),
        "dim_store": make([(1, None), (2, "EU")], "store_sk bigint, region string"),
    }
    out = rows(views.vw_sales_rollup_by_region(t, "2024-06-05"), "region", "store_sk", "line_count", "grouping_level")
    assert out == sorted(
        [(None, 1, 1, 0), (None, None, 1, 1), ("EU", 2, 1, 0), ("EU", None, 1, 1), (None, None, 2, 3)], key=repr
    )
    empty = rows(views.vw_sales_rollup_by_region(t, "2030-01-01"))
    assert empty == [(None, None, None, 0, 3)]


def test_hierarchy_depth_orphans_and_cycles(make):
    chain = [(f"n{i}", f"n{i - 1}" if i else None, f"N{i}") for i in range(11)]
    extra = [("orphan", "gone", "O"), ("x", "y", "X"), ("y", "x", "Y"), ("root2", "", "R2"), ("leaf", "root2", "L")]
    out = views.vw_category_hierarchy_recursive(
        {"dim_category": make(chain + extra, "category_id string, parent_id string, name string")}
    )
    found = {r.category_id: (r.depth, r.path) for r in out.collect()}
    assert set(found) == {*(f"n{i}" for i in range(9)), "root2", "leaf"}
    assert found["n8"] == (8, " > ".join(f"N{i}" for i in range(9)))
    assert found["leaf"] == (1, "R2 > L") and found["n0"] == (0, "N0")


def test_undelivered_is_late_but_has_no_transit_time(make):
    ship = datetime(2024, 6, 1)
    t = {
        "fact_shipments": make(
            [("UPS", ship, datetime(2024, 6, 3)), ("UPS", ship, None), ("UPS", datetime(2020, 1, 1), None)],
            "carrier string, shipped_ts timestamp, delivered_ts timestamp",
        )
    }
    row = views.vw_otd_by_carrier_30d(t, "2024-06-15").first()
    assert (row.shipments, float(row.otd_rate), row.avg_transit_hours) == (2, 0.5, 48.0)


def test_pending_returns(make):
    schema = (
        "rma_id string, customer_id string, invoice_no string, stock_code string, quantity bigint, "
        "requested_at timestamp, approved boolean"
    )
    when = datetime(2024, 6, 1, 23, 59)
    t = {"return_authorizations": make([(str(a), "c", "i", "s", 1, when, a) for a in (None, False, True)], schema)}
    assert rows(views.v_returns_pending(t, "2024-06-03"), "rma_id", "days_pending") == [("False", 2), ("None", 2)]


def test_continuity_matches_countries_after_normalising(make):
    day = date(2024, 6, 1)
    t = {
        "fact_sales": make([sale("a", 1, "1.00", day, country="usa"), sale("b", 2, "1.00", day, country="FR")], SALES),
        "dim_customer": make([(1, " United States "), (2, "DE")], "customer_sk bigint, country string"),
    }
    assert rows(views.vw_panel_continuity_score(t, "2024-06-15")) == [(1, 1, 1, Decimal("1.00"))]


def test_members_of_unknown_stores_are_kept(make):
    schema = "member_id string, event_type string, points bigint, store_sk bigint, event_date date"
    day = date(2024, 6, 1)
    t = {
        "fact_loyalty_events": make(
            [("m1", "REDEEM", 5, 1, day), ("m1", "REDEEM", 7, 2, day), ("m2", "REDEEM", 1, 9, day), ("m3", "EARN", 1, 1, day)],
            schema,
        ),
        "dim_store": make([(1, "EU"), (2, "EU")], "store_sk bigint, region string"),
    }
    out = rows(views.vw_active_member_panel(t, "2024-06-15"))
    assert out == [("EU", 1, 1, 12), (None, 1, 1, 1)]


def test_all_views_are_listed():
    assert len(views.VIEWS) == 15
