"""The fifteen analytical views.

Every view is ``name(t, as_of)``: ``t`` maps table names to DataFrames and ``as_of``
stands for today. Facts are folded to the grain a view needs before they meet a
dimension, wherever the sums allow that; the result is the same and the join then
carries one row per group instead of one per sale.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions.dates import day_key, days_before, month_label, month_number
from tillwright.functions.enrich import country_code
from tillwright.operators.grouping import with_blank_row
from tillwright.operators.joins import followed_within, with_ancestry
from tillwright.operators.ordered import rank_desc

Tables = Mapping[str, DataFrame]
Day = str | date

# Days since the last order up to which a customer is in a bucket.
RECENCY_BUCKETS = ((30, "active"), (90, "warm"), (365, "cold"))
# Columns of the positional web log that carry a meaning.
WEB_LOG_COLUMNS = {
    "col_2": "event_ts",
    "col_8": "ip",
    "col_13": "url",
    "col_14": "user_id",
    "col_50": "city",
    "col_51": "country",
    "col_53": "state",
}
DELIVERY_PROMISE_HOURS = 48
ATTRIBUTION_SECONDS = 24 * 3600
HIERARCHY_DEPTH = 8


def safe_ratio(over: Column, under: Column) -> Column:
    """``over / under`` as a double, 0 when it is undefined."""
    return F.coalesce(F.try_divide(over.cast("double"), under.cast("double")), F.lit(0.0))


def recency_bucket(orders: Column, recency_days: Column) -> Column:
    bucket = F.when(orders == 0, "never")
    for limit, name in RECENCY_BUCKETS:
        bucket = bucket.when(recency_days <= limit, name)
    return bucket.otherwise("churned")


def omniture(t: Tables, as_of: Day | None = None) -> DataFrame:
    named = [F.col(c).alias(name) for c, name in WEB_LOG_COLUMNS.items()]
    return t["omniture_logs"].select(*named, "date_ts")


def v_fraud_signals_recent(t: Tables, as_of: Day) -> DataFrame:
    return t["fraud_signals"].filter(F.col("signal_date") >= day_key(days_before(as_of, 1)))


def v_returns_pending(t: Tables, as_of: Day) -> DataFrame:
    undecided = F.col("approved").isNull() | ~F.col("approved")
    waiting = F.datediff(F.lit(as_of).cast("date"), F.to_date("requested_at")).cast("bigint")
    return t["return_authorizations"].filter(undecided).select(
        "rma_id", "customer_id", "invoice_no", "stock_code", "quantity", "requested_at",
        waiting.alias("days_pending"),
    )


def v_eu_orders_with_consent(t: Tables, as_of: Day | None = None) -> DataFrame:
    """Orders with the marketing consents valid at order time; several valid ones repeat the order."""
    o, c = t["fact_orders_eu"].alias("o"), t["dim_gdpr_consent"].alias("c")
    valid = (
        (F.col("c.customer_id") == F.col("o.customer_id"))
        & (F.col("c.consent_type") == "MARKETING")
        & F.col("c.granted")
        & (F.col("c.withdrawn_ts").isNull() | (F.col("c.withdrawn_ts") > F.col("o.order_ts")))
    )
    return o.join(c, valid, "left").select(
        "o.order_id", "o.customer_id", "o.country_iso2", "o.line_total", "o.currency_code",
        F.coalesce("c.granted", F.lit(False)).alias("marketing_consent"),
        F.col("c.granted_ts").alias("consent_granted_ts"),
    )


def vw_daily_sales_by_country(t: Tables, as_of: Day | None = None) -> DataFrame:
    per_invoice = t["fact_sales"].groupBy("sale_date", "country", "invoice_no", "customer_sk").agg(
        F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units")
    )
    daily = per_invoice.groupBy("sale_date", "country").agg(
        F.count_distinct("invoice_no").alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("units").alias("units"),
        F.count_distinct("customer_sk").alias("active_customers"),
    )
    return daily.withColumn("aov", safe_ratio(F.col("revenue"), F.col("orders"))).withColumn(
        "basket_size", safe_ratio(F.col("units"), F.col("orders"))
    )


def vw_weekly_sales_with_running_totals(t: Tables, as_of: Day | None = None) -> DataFrame:
    """Weekly sales with year-to-date, 13-row average and the value 52 rows earlier.

    The windows run over one row per calendar week, whatever the number of sales.
    """
    per_day = t["fact_sales"].groupBy("sale_date").agg(
        F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units")
    )
    calendar = t["dim_date"].select("d_date", "d_week_seq", "d_year")
    weekly = (
        per_day.join(calendar, F.col("sale_date") == F.col("d_date"))
        .groupBy("d_week_seq", "d_year")
        .agg(F.sum("revenue").alias("wk_revenue"), F.sum("units").alias("wk_units"))
    )
    # a week across New Year has two rows; the year settles their order
    in_order = Window.orderBy("d_week_seq", "d_year")
    in_year = (
        Window.partitionBy("d_year")
        .orderBy("d_week_seq")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    year_ago = F.lag("wk_revenue", 52).over(in_order)
    return weekly.select(
        "d_week_seq",
        "d_year",
        "wk_revenue",
        "wk_units",
        F.sum("wk_revenue").over(in_year).alias("ytd_revenue"),
        F.avg("wk_revenue").over(in_order.rowsBetween(-12, Window.currentRow)).alias("rolling_13wk_avg"),
        year_ago.alias("same_week_last_year"),
        (F.col("wk_revenue") - F.coalesce(year_ago, F.lit(0))).alias("yoy_delta"),
    )


def vw_customer_lifetime_value(t: Tables, as_of: Day) -> DataFrame:
    spent = (
        t["fact_sales"]
        .filter(F.col("customer_sk").isNotNull())
        .groupBy("customer_sk", "invoice_no")
        .agg(
            F.min("sale_date").alias("first_order_date"),
            F.max("sale_date").alias("last_order_date"),
            F.sum("line_total").alias("revenue"),
        )
        .groupBy("customer_sk")
        .agg(
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
            F.count("invoice_no").alias("orders"),
            F.sum("revenue").alias("revenue"),
        )
    )
    # a repeated dimension row repeats its customer's sales
    customers = t["dim_customer"].groupBy("customer_sk", "customer_id", "country").agg(
        F.count(F.lit(1)).alias("copies")
    )
    recency = F.datediff(F.lit(as_of).cast("date"), F.col("last_order_date")).cast("bigint")
    orders = F.coalesce("orders", F.lit(0).cast("bigint"))
    return customers.join(spent, "customer_sk", "left").select(
        "customer_sk",
        "customer_id",
        "country",
        "first_order_date",
        "last_order_date",
        orders.alias("orders"),
        (F.col("revenue") * F.col("copies")).alias("lifetime_revenue"),
        recency.alias("recency_days"),
        recency_bucket(orders, recency).alias("rfm_bucket"),
    )


def vw_product_performance(t: Tables, as_of: Day | None = None) -> DataFrame:
    """Sales per product and country with both ranks, recomputed whenever the view is read."""
    per_invoice = t["fact_sales"].groupBy("product_sk", "country", "invoice_no").agg(
        F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units")
    )
    per_country = per_invoice.groupBy("product_sk", "country").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("units").alias("units"),
        F.count("invoice_no").alias("orders"),
    )
    # a repeated dimension row repeats its product's sales
    # dealt by the join's key at once, which the grouping can use as well
    products = (
        t["dim_product"]
        .select("product_sk", "stock_code", "description")
        .repartition("product_sk")
        .groupBy("product_sk", "stock_code", "description")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    sold = products.join(per_country, "product_sk").select(
        "product_sk", "stock_code", "description", "country",
        (F.col("revenue") * F.col("copies")).alias("revenue"),
        (F.col("units") * F.col("copies")).alias("units"),
        "orders",
    )
    return rank_desc(sold, "revenue", ["country"], "country_rank", "global_rank")


def vw_monthly_cohort_retention(t: Tables, as_of: Day | None = None) -> DataFrame:
    """Customers active n months after the month of their first order.

    Only the set of active months is kept per customer, so the sales are shuffled once,
    and its size is bounded by the calendar.
    """
    month = month_number(F.col("sale_date"))
    customers = (
        t["fact_sales"]
        .filter(F.col("customer_sk").isNotNull())
        .groupBy("customer_sk")
        .agg(
            F.min(month).alias("cohort"),
            # wrapped, so that a sale without a date is kept as its own entry
            F.collect_set(F.struct(month.alias("month"))).alias("months"),
        )
    )
    active = customers.select("cohort", F.explode("months.month").alias("month"))
    return active.groupBy(
        F.when(F.col("cohort").isNotNull(), month_label(F.col("cohort"))).alias("cohort_month"),
        (F.col("month") - F.col("cohort")).cast("bigint").alias("months_since_first"),
    ).agg(F.count(F.lit(1)).alias("active_customers"))


def vw_session_to_order_attribution(t: Tables, as_of: Day | None = None) -> DataFrame:
    sessions = t["mobile_events"].select(
        "user_id", F.col("event_ts").alias("session_ts"), F.col("context.referrer").alias("referrer")
    )
    known = t["dim_customer"].select("customer_id", F.col("customer_sk").alias("session_customer"))
    orders = t["fact_sales"].select(
        "customer_sk", "invoice_no", F.col("invoice_ts").alias("order_ts"), "line_total"
    )
    named = sessions.join(known, F.col("user_id") == F.col("customer_id"), "left")
    attributed = followed_within(
        named, orders, [("session_customer", "customer_sk")], "session_ts", "order_ts", ATTRIBUTION_SECONDS
    )
    return attributed.select("user_id", "session_ts", "referrer", "invoice_no", "order_ts", "line_total")


def vw_active_member_panel(t: Tables, as_of: Day) -> DataFrame:
    """Members who redeemed in the last 30 days, by the region of the store they redeemed in."""
    redeemed = t["fact_loyalty_events"].filter(
        (F.col("event_type") == "REDEEM") & (F.col("event_date") >= days_before(as_of, 30))
    )
    per_member = redeemed.groupBy("store_sk", "member_id").agg(F.sum("points").alias("points"))
    stores = t["dim_store"].select("store_sk", "region")
    return (
        per_member.join(stores, "store_sk", "left")
        .groupBy("region", "member_id")
        .agg(F.sum("points").alias("points"))
        .groupBy("region")
        .agg(
            F.approx_count_distinct("member_id", 0.01).alias("approx_active_members"),
            F.count("member_id").alias("exact_active_members"),
            F.sum("points").alias("total_points_redeemed"),
        )
    )


def vw_sales_rollup_by_region(t: Tables, as_of: Day, store_key: str = "customer_sk") -> DataFrame:
    """Sales of the last week rolled up over region and store. ``store_key`` is the sales
    column matched with the store; the default is the one the view has always used."""
    recent = t["fact_sales"].filter(F.col("sale_date") >= days_before(as_of, 7))
    per_key = recent.groupBy(F.col(store_key).alias("_store")).agg(
        F.sum("line_total").alias("revenue"), F.count(F.lit(1)).alias("lines")
    )
    stores = t["dim_store"].select("store_sk", "region")
    per_store = per_key.join(stores, F.col("_store") == F.col("store_sk")).drop("_store")
    rolled = with_blank_row(per_store, "lines").rollup("region", "store_sk").agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("lines").alias("line_count"),
        F.grouping_id().cast("bigint").alias("grouping_level"),
    )
    return rolled.filter((F.col("line_count") > 0) | (F.col("grouping_level") == 3))


def vw_category_hierarchy_recursive(t: Tables, as_of: Day | None = None) -> DataFrame:
    tree = with_ancestry(t["dim_category"], "category_id", "parent_id", "name", HIERARCHY_DEPTH)
    return tree.select("category_id", "name", "parent_id", "path", "depth")


def vw_otd_by_carrier_30d(t: Tables, as_of: Day) -> DataFrame:
    """Delivery within 48 hours per carrier. A shipment without delivery counts as late,
    but not in the transit time."""
    since = days_before(as_of, 30).cast("timestamp")
    limit = F.col("shipped_ts") + F.make_dt_interval(hours=F.lit(DELIVERY_PROMISE_HOURS))
    transit = F.unix_seconds("delivered_ts") - F.unix_seconds("shipped_ts")
    return t["fact_shipments"].filter(F.col("shipped_ts") >= since).groupBy("carrier").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.avg(F.when(F.col("delivered_ts") <= limit, 1.0).otherwise(0.0)).alias("otd_rate"),
        (F.avg(transit) / 3600.0).alias("avg_transit_hours"),
    )


def vw_panel_continuity_score(t: Tables, as_of: Day) -> DataFrame:
    bought = (
        t["fact_sales"]
        .filter(F.col("sale_date") >= days_before(as_of, 90))
        .groupBy("customer_sk", "country", "sale_date", "product_sk")
        .agg(F.sum("line_total").alias("spend"))
        .withColumn("_iso", country_code("country"))
        .drop("country")
    )
    customers = t["dim_customer"].select("customer_sk", country_code("country").alias("_iso"))
    return bought.join(customers, ["customer_sk", "_iso"]).groupBy("customer_sk").agg(
        F.count_distinct("sale_date").alias("active_days"),
        F.count_distinct("product_sk").alias("distinct_products"),
        F.sum("spend").alias("total_spend"),
    )


VIEWS = {
    view.__name__: view
    for view in (
        omniture,
        v_fraud_signals_recent,
        v_returns_pending,
        v_eu_orders_with_consent,
        vw_daily_sales_by_country,
        vw_weekly_sales_with_running_totals,
        vw_customer_lifetime_value,
        vw_product_performance,
        vw_monthly_cohort_retention,
        vw_session_to_order_attribution,
        vw_active_member_panel,
        vw_sales_rollup_by_region,
        vw_category_hierarchy_recursive,
        vw_otd_by_carrier_30d,
        vw_panel_continuity_score,
    )
}
