from datetime import date, datetime, timedelta
from decimal import Decimal

from conftest import rows
from tillwright.plans import derived

T0 = datetime(2024, 1, 1)


def test_cdc_delete_then_insert(make):
    day = date(2024, 1, 1)
    data = [
        (1, T0, "old", "I", day), (1, T0 + timedelta(hours=1), "gone", "D", day), (1, T0 + timedelta(hours=2), "new", "I", day),
        (2, T0, "same time", "U", day), (2, T0, "deleted", "D", day), (3, None, "x", None, None),
    ]
    df = make(data, "return_id bigint, return_ts timestamp, status string, op string, snapshot_date date")
    out = rows(derived.merged_returns_cdc(df), "return_id", "status", "is_deleted")
    assert out == [(1, "new", False), (2, "deleted", True), (3, "x", False)]


def test_history_keeps_changes_only(make):
    at = lambda days: T0 + timedelta(days=days)
    data = [(1, at(0), "a", None), (1, at(40), "a", None), (1, at(50), None, "a"), (1, at(90), "a", None), (2, at(5), "b", "b")]
    df = make(data, "k bigint, ts timestamp, role string, dept string")
    out = derived.change_history(df, "k", ["role", "dept"], "ts")
    found = rows(out, "k", "role", "dept", "eff_from", "eff_to", "is_current")
    assert found == sorted(
        [
            (1, "a", None, at(0), at(50), False), (1, None, "a", at(50), at(90), False),
            (1, "a", None, at(90), None, True), (2, "b", "b", at(5), None, True),
        ],
        key=repr,
    )


def test_ledger_ends_with_the_sum(make):
    data = [(i, "hot" if i % 3 == 0 else f"m{i % 4}", "REDEEM" if i % 5 == 0 else "EARN", i, f"t{i}", T0 + timedelta(minutes=37 * i))
            for i in range(120)]
    df = make(data, "event_id bigint, member_id string, event_type string, points bigint, tx_id string, event_ts timestamp")
    out = derived.loyalty_points_ledger(df).collect()
    assert len(out) == 120
    for member in {r.member_id for r in out}:
        mine = sorted((r for r in out if r.member_id == member), key=lambda r: (r.event_ts, r.entry_id))
        assert mine[-1].running_balance == sum(r.points_delta for r in mine)


def test_repeated_and_bot_clicks(make):
    schema = "user_id string, event_ts timestamp, page_url string, ip string"
    human = [("u", T0, "/a", "2"), ("u", T0, "/a", "1"), ("u", T0, "/b", "3"), (None, T0, "/a", "4")]
    bot = [("bot", T0 + timedelta(seconds=s), f"/{s}", "9") for s in range(50)]
    out = derived.dedup_clickstream(make(human + bot, schema), per_minute=50)
    assert rows(out, "user_id", "page_url", "ip", "bot_score") == [
        ("u", "/a", "1", Decimal("0.040")), ("u", "/b", "3", Decimal("0.040")), (None, "/a", "4", Decimal("0.020")),
    ]


def test_cleansed_orders_prefers_the_till_on_a_tie(make):
    sales = make(
        [("I1", "c", 2, "2024-01-01 00:00:00", Decimal("1.50")), ("I2", "c", 1, "bad", Decimal("1.00"))],
        "invoice_no string, customer_id string, quantity bigint, invoice_date string, unit_price decimal(10,2)",
    )
    till = make(
        [(1, "c", "I1", T0, 1, Decimal(10), Decimal(1), Decimal(2), "CARD", False),
         (2, "c", "I3", T0, 1, Decimal(10), Decimal(1), Decimal(2), "CARD", True)],
        "txn_id bigint, customer_id string, invoice_no string, txn_ts timestamp, line_count bigint, "
        "gross_amount decimal(14,2), discount_amount decimal(14,2), tax_amount decimal(14,2), tender_type string, "
        "void_flag boolean",
    )
    out = derived.cleansed_orders(sales, till)
    assert rows(out, "invoice_no", "source_feed", "net_amount", "order_date") == [
        ("I1", "pos_transactions", Decimal("11.00"), date(2024, 1, 1)), ("I2", "sales_retail", Decimal("1.00"), None),
    ]


def test_top_countries_share_ranks(make):
    data = [("i1", "A", "5"), ("i2", "B", "5"), ("i3", "C", "3"), ("i4", "D", "1")]
    df = make([(i, c, Decimal(v), date(2024, 1, 1)) for i, c, v in data],
              "invoice_no string, country string, line_total decimal(14,2), sale_date date")
    assert rows(derived.top_countries_daily(df, 3), "country", "rank") == [("A", 1), ("B", 1), ("C", 3)]


def test_cubes_give_a_total_for_no_rows(make):
    none = make([], "country string, sale_date date, product_sk bigint, invoice_no string, line_total decimal(14,2), quantity bigint")
    cube = derived.sales_cube(none, "2024-01-01").drop("as_of_date")
    assert rows(cube) == [(0, "", None, None, None, 0, None, None)]


def test_calendar(spark):
    days = {r.d_date: r for r in derived.calendar(spark, "2024-02-28", "2024-03-01", as_of="2024-02-29").collect()}
    assert list(days) == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    leap = days[date(2024, 2, 29)]
    assert (leap.d_day_name, leap.d_dow, leap.d_qoy, leap.d_weekend, leap.d_current_day) == ("Thursday", 4, 1, "N", "Y")
    assert leap.d_last_dom - leap.d_first_dom == 28 and leap.d_fy_year == 2024
    assert days[date(2024, 3, 1)].d_month_seq == leap.d_month_seq + 1


def test_customers_without_coordinates(make):
    schema = (
        "customer_id string, email string, phone string, first_name string, last_name string, addr_line1 string, "
        "addr_city string, addr_region string, addr_country string, addr_postal string, signup_date string"
    )
    old = ("1", "A@x ", "+49 (0)12-3+4", " A ", "B", "l", "c", "r", "DE", "1", "20240101")
    new = ("1", " B@x", None, "A", "B", "l", "c", "r", "DE", "1", "20240201")
    out = derived.cleansed_customers(make([old, new], schema)).collect()
    assert [(r.email_norm, r.phone_norm, r.load_date, r.geocoded_lat) for r in out] == [("b@x", None, date(2024, 2, 1), None)]
    assert len(out[0].record_hash) == 64


def test_fraud_score_knows_no_later_signal(make):
    from datetime import datetime, timedelta

    at = lambda minutes: datetime(2024, 1, 1) + timedelta(minutes=minutes)
    pos = make([(1, "c", at(10)), (2, "c", at(30)), (3, "d", at(30)), (4, None, at(30))], "txn_id long, customer_id string, txn_ts timestamp")
    signals = make(
        [("c", "velocity", 0.9, at(20)), ("c", "address", 0.2, at(5)), ("d", "velocity", 0.95, at(31)), (None, "velocity", 1.0, at(1))],
        "customer_id string, signal_type string, score double, signal_ts timestamp",
    )
    clicks = make([("d", at(29), 0.6), ("d", at(32), 1.0), ("c", at(10), 0.1)], "user_id string, event_ts timestamp, bot_score double")
    found = {r.txn_id: r for r in derived.fraud_scored(pos, clicks, signals).collect()}
    assert [(float(found[k].fraud_score), found[k].risk_band, found[k].signals, found[k].scored_at) for k in (1, 2, 3, 4)] == [
        (0.2, "LOW", ["address"], at(10)),
        (0.9, "HIGH", ["velocity"], at(20)),
        (0.6, "MEDIUM", ["bot"], at(29)),
        (0.0, "LOW", [], at(30)),
    ]


def test_sketches_of_days_merge_to_any_window(spark, make):
    from pyspark.sql import functions as F

    events = spark.range(60_000).select(
        F.concat(F.lit("M"), F.pmod(F.xxhash64("id"), F.lit(9000))).alias("member_id"),
        F.when(F.col("id") % 5 > 0, "REDEEM").otherwise("EARN").alias("event_type"),
        F.lit(1).cast("bigint").alias("points"),
        (F.col("id") % 4).alias("store_sk"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 31).cast("int")).alias("event_date"),
    )
    stores = make([(0, "north"), (1, "north"), (2, "south")], "store_sk bigint, region string")
    daily = derived.member_sketches(events, stores)
    assert daily.count() == 31 * 3
    for first, last in (("2024-01-01", "2024-01-31"), ("2024-01-07", "2024-01-07"), ("2024-01-10", "2024-01-12")):
        panel = {r.region: r for r in derived.sketched_panel(daily, first, last).collect()}
        days = events.filter(F.col("event_date").between(first, last) & (F.col("event_type") == "REDEEM"))
        exact = days.join(stores, "store_sk", "left").groupBy("region").agg(F.count_distinct("member_id").alias("n"), F.sum("points").alias("p"))
        for r in exact.collect():
            assert abs(panel[r.region].approx_active_members - r.n) <= 0.03 * r.n and panel[r.region].total_points_redeemed == r.p
    plan = derived.sketched_panel(daily, "2024-01-01", "2024-01-31")._jdf.queryExecution().executedPlan().toString()
    assert "keys=[member_id" not in plan
