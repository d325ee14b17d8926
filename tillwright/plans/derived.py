"""Derived tables: cleansing, history, ledgers, sessions, aggregates and cubes.

Functions take their input DataFrames and return the derived table, lazily. Where a
table needs an order inside a key (ledgers, sessions, history) the slot-wise operators
of ``operators.ordered`` are used, so a hot member, user or entity stays spread out.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.functions.dates import date_of_key, day_key, month_start
from tillwright.functions.enrich import trimmed
from tillwright.operators.grouping import with_blank_row
from tillwright.operators.history import History, attribute_hash
from tillwright.operators.ordered import (
    group_ordinal,
    last_before,
    latest_per_key,
    next_row,
    ordered_lists,
    previous_row,
    running_total,
    time_slot,
)
from tillwright.plans.views import recency_bucket

SESSION_GAP_MINUTES = 30
BOT_CLICKS_PER_MINUTE = 60
#: Bot score of a click from which on it counts as a signal of its own.
BOT_SUSPECT = 0.5

# Carrier status words and the event type they stand for.
CARRIER_STATUS = {
    "PICKED_UP": ["picked up", "pickup", "collected", "origin scan"],
    "IN_TRANSIT": ["in transit", "departed", "arrived at facility"],
    "OUT_FOR_DELIVERY": ["out for delivery", "with courier"],
    "DELIVERED": ["delivered", "proof of delivery"],
}
OTHER_STATUS = "EXCEPTION"
# Lower bounds of the fraud bands.
FRAUD_BANDS = ((0.8, "HIGH"), (0.5, "MEDIUM"), (0.0, "LOW"))


def _norm(c: str) -> Column:
    return F.lower(trimmed(c))


def _ratio(over: Column, under: Column, kind: str) -> Column:
    """Exact decimal ratio, null when undefined."""
    return F.try_divide(over.cast("decimal(20,6)"), under.cast("decimal(20,6)")).cast(kind)


# ---------------------------------------------------------------- calendar


def calendar(
    spark: SparkSession, first: str | date, last: str | date, as_of: str | date | None = None,
    fiscal_start_month: int = 7,
) -> DataFrame:
    """One row per day. Weeks start on Monday; week, month and quarter sequences count on
    from 1900-01-01, so they never restart. Holidays are New Year and Christmas Day."""
    d = F.col("d_date")
    first_day = F.lit("1900-01-01").cast("date")
    seq = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY"))
    months = (F.year(d) - 1900) * 12 + F.month(d) - 1
    fiscal = F.add_months(d, 13 - fiscal_start_month) if fiscal_start_month > 1 else d
    weeks = lambda x: F.floor(F.datediff(x, first_day) / 7)
    month_day = lambda x: F.date_format(x, "MM-dd")
    holiday = lambda x: F.when(month_day(x).isin("01-01", "12-25"), "Y").otherwise("N")
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    flag = lambda same: F.when(same, "Y").otherwise("N")
    quarter_seq = lambda x: (F.year(x) - 1900) * 4 + F.quarter(x) - 1
    day_sk = lambda x: F.datediff(x, first_day)
    columns = {
        "d_date_sk": day_sk(d),
        "d_date_id": F.date_format(d, "yyyyMMdd"),
        "d_date": d,
        "d_month_seq": months,
        "d_week_seq": weeks(d),
        "d_quarter_seq": quarter_seq(d),
        "d_year": F.year(d),
        "d_dow": F.weekday(d) + 1,
        "d_moy": F.month(d),
        "d_dom": F.dayofmonth(d),
        "d_qoy": F.quarter(d),
        "d_fy_year": F.year(fiscal),
        "d_fy_quarter_seq": quarter_seq(fiscal),
        "d_day_name": F.date_format(d, "EEEE"),
        "d_holiday": holiday(d),
        "d_weekend": flag(F.weekday(d) >= 5),
        "d_following_holiday": holiday(F.date_sub(d, 1)),
        "d_first_dom": day_sk(F.trunc(d, "month")),
        "d_last_dom": day_sk(F.last_day(d)),
        "d_same_day_ly": day_sk(F.add_months(d, -12)),
        "d_same_day_lq": day_sk(F.add_months(d, -3)),
        "d_current_day": flag(d == today),
        "d_current_week": flag(weeks(d) == weeks(today)),
        "d_current_month": flag(F.trunc(d, "month") == F.trunc(today, "month")),
        "d_current_quarter": flag(quarter_seq(d) == quarter_seq(today)),
        "d_current_year": flag(F.year(d) == F.year(today)),
    }
    numbers = {"d_date_sk", "d_month_seq", "d_week_seq", "d_quarter_seq", "d_year", "d_dow", "d_moy",
               "d_dom", "d_qoy", "d_fy_year", "d_fy_quarter_seq", "d_first_dom", "d_last_dom",
               "d_same_day_ly", "d_same_day_lq"}
    return spark.range(1).select(F.explode(seq).alias("d_date")).select(
        *[(c.cast("bigint") if name in numbers else c).alias(name) for name, c in columns.items()]
    )


# ---------------------------------------------------------------- cleansing


def cleansed_orders(sales_retail: DataFrame, pos_transactions: DataFrame) -> DataFrame:
    """One typed order per invoice out of both feeds; the later one wins, the till on a tie.
    Void till transactions are left out. net = gross - discount + tax."""
    none = F.lit(0).cast("decimal(14,2)")
    retail = (
        sales_retail.groupBy("invoice_no")
        .agg(
            F.max("customer_id").alias("customer_id"),
            F.max(F.try_to_timestamp("invoice_date", F.lit("yyyy-MM-dd HH:mm:ss"))).alias("txn_ts"),
            F.count(F.lit(1)).alias("line_count"),
            F.sum(F.col("quantity") * F.col("unit_price")).cast("decimal(14,2)").alias("gross_amount"),
        )
        .select(
            F.concat(F.lit("R-"), F.col("invoice_no")).alias("order_id"),
            "customer_id", "invoice_no", "txn_ts", "line_count", "gross_amount",
            none.alias("discount"), none.alias("tax"), F.lit(None).cast("string").alias("tender_type"),
            F.lit("sales_retail").alias("source_feed"),
        )
    )
    till = pos_transactions.filter(~F.coalesce("void_flag", F.lit(False))).select(
        F.concat(F.lit("P-"), F.col("txn_id")).alias("order_id"),
        "customer_id", "invoice_no", "txn_ts", "line_count", "gross_amount",
        F.col("discount_amount").alias("discount"), F.col("tax_amount").alias("tax"), "tender_type",
        F.lit("pos_transactions").alias("source_feed"),
    )
    newest = [F.col("txn_ts").desc_nulls_last(), F.col("source_feed").asc(), F.col("order_id").desc()]
    net = (F.col("gross_amount") - F.col("discount") + F.col("tax")).cast("decimal(14,2)")
    return (
        latest_per_key(retail.unionByName(till), ["invoice_no"], newest)
        .withColumn("net_amount", net)
        .withColumn("order_date", F.to_date("txn_ts"))
    )


CUSTOMER_ATTRIBUTES = (
    "email_norm", "phone_norm", "first_name", "last_name",
    "addr_line1", "addr_city", "addr_region", "addr_country", "addr_postal",
)


def cleansed_customers(signups: DataFrame, geocoded: DataFrame | None = None) -> DataFrame:
    """Latest sign-up per customer with normalised contact data and a hash for change detection."""
    newest = [F.col("signup_date").desc_nulls_last(), F.col("email").desc_nulls_last()]
    latest = latest_per_key(signups, ["customer_id"], newest)
    clean = latest.select(
        "customer_id",
        _norm("email").alias("email_norm"),
        F.regexp_replace("phone", r"[^0-9+]|(?<=.)\+", "").alias("phone_norm"),
        *[trimmed(c).alias(c) for c in CUSTOMER_ATTRIBUTES[2:]],
        F.try_to_timestamp(F.substring("signup_date", 1, 8), F.lit("yyyyMMdd")).alias("eff_from_ts"),
    ).withColumn("record_hash", attribute_hash(CUSTOMER_ATTRIBUTES))
    clean = clean.withColumn("load_date", F.to_date("eff_from_ts"))
    if geocoded is None:
        nowhere = F.lit(None).cast("double")
        return clean.withColumns({"geocoded_lat": nowhere, "geocoded_lon": nowhere})
    places = geocoded.select(
        F.col("raw_addr_hash").alias("_hash"),
        F.col("lat").alias("geocoded_lat"),
        F.col("lon").alias("geocoded_lon"),
    )
    return clean.withColumn("_addr", address_hash()).join(
        places, F.col("_addr") == F.col("_hash"), "left"
    ).drop("_addr", "_hash")


def cleansed_products(feed: DataFrame, as_of: str | date) -> DataFrame:
    newest = [F.col("feed_date").desc_nulls_last(), F.col("upc").desc_nulls_last()]
    today = F.lit(as_of).cast("date")
    return latest_per_key(feed, ["sku"], newest).select(
        "sku",
        "upc",
        _norm("name").alias("name_norm"),
        _norm("category").alias("category_norm"),
        "subcategory",
        _norm("color").alias("color_norm"),
        _norm("size").alias("size_norm"),
        "msrp",
        "cost",
        "supplier_id",
        (F.col("discontinued_at").isNull() | (F.col("discontinued_at") > today)).alias("available"),
        today.alias("load_date"),
    )


def dedup_clickstream(
    clicks: DataFrame, bot_limit: float = 1.0, per_minute: int = BOT_CLICKS_PER_MINUTE
) -> DataFrame:
    """Repeated clicks (same user, time and page) folded into one, bot-like minutes dropped.

    The bot score of a click is its user's number of distinct clicks in that minute over
    ``per_minute``, at most 1. Both steps are map-side combined aggregates.
    """
    same = ["user_id", "event_ts", "page_url"]
    rest = [c for c in clicks.columns if c not in same]
    # the smallest of the repeats is kept, so the choice does not depend on row order
    kept = F.min(F.struct(*rest)).alias("_kept")
    single = clicks.groupBy(*same).agg(kept).select(*same, "_kept.*")
    single = single.withColumn("_minute", F.date_trunc("minute", "event_ts"))
    rate = single.groupBy("user_id", "_minute").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("user_id").alias("_user"), F.col("_minute").alias("_at"), "_n"
    )
    score = F.least(F.lit(1.0), F.col("_n") / per_minute).cast("decimal(4,3)")
    matched = F.col("user_id").eqNullSafe(F.col("_user")) & F.col("_minute").eqNullSafe(F.col("_at"))
    kept = (
        single.join(rate, matched)
        .withColumn("bot_score", score)
        .filter(F.col("bot_score") < bot_limit)
        .drop("_minute", "_user", "_at", "_n")
    )
    layout = {"date_ts": day_key(F.col("event_ts")), "partition_date": F.to_date("event_ts")}
    if "country" in kept.columns:
        layout["country_partition"] = F.col("country")
    return kept.withColumns({name: c for name, c in layout.items() if name not in kept.columns})


def address_hash() -> Column:
    parts = ("addr_line1", "addr_city", "addr_region", "addr_country", "addr_postal")
    return F.sha2(F.concat_ws("|", *[F.coalesce(_norm(c), F.lit("")) for c in parts]), 256)


def geocoded_addresses(addresses: DataFrame, dim_geography: DataFrame, load_date: str | date) -> DataFrame:
    """Distinct standardised addresses with the coordinates of their postal area, where known."""
    columns = ["addr_line1", "addr_city", "addr_region", "addr_country", "addr_postal"]
    distinct = (
        addresses.withColumn("raw_addr_hash", address_hash())
        .groupBy("raw_addr_hash")
        .agg(F.min(F.struct(*columns)).alias("a"))
        .select("raw_addr_hash", "a.*")
    )
    place = ["country_iso2", "city", "postal_code"]
    areas = dim_geography.groupBy(*[_norm(c).alias(f"_{c}") for c in place]).agg(
        F.min_by(F.struct("latitude", "longitude"), "geo_sk").alias("_at")
    )
    on = (
        (_norm("addr_country") == F.col("_country_iso2"))
        & (_norm("addr_city") == F.col("_city"))
        & (_norm("addr_postal") == F.col("_postal_code"))
    )
    known = F.col("_at").isNotNull()
    return distinct.join(areas, on, "left").select(
        "raw_addr_hash",
        *columns,
        F.col("_at.latitude").alias("lat"),
        F.col("_at.longitude").alias("lon"),
        F.when(known, 1).otherwise(0).cast("decimal(4,3)").alias("confidence"),
        F.when(known, "dim_geography").alias("provider"),
        F.lit(load_date).cast("date").alias("load_date"),
    )


def parsed_loyalty_events(lines: DataFrame) -> DataFrame:
    """Types for the regex-parsed loyalty feed; ``key=value`` pairs become JSON."""
    event_ts = F.try_to_timestamp("event_ts_str", F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return lines.select(
        event_ts.alias("event_ts"),
        "member_id",
        "event_type",
        F.col("points").try_cast("bigint").alias("points"),
        "store_id",
        "tx_id",
        F.to_json(F.str_to_map("meta_raw", F.lit(";"), F.lit("="))).alias("meta"),
        *[c for c in ("date_ts",) if c in lines.columns],
        (date_of_key("date_ts") if "date_ts" in lines.columns else F.to_date(event_ts)).alias("partition_date"),
    )


def normalized_carrier_events(*feeds: DataFrame) -> DataFrame:
    """All carriers' tracking feeds in one model."""
    word = F.lower(trimmed(F.col("status")))
    event = F.when(word.isNull(), F.lit(None).cast("string"))
    for name, words in CARRIER_STATUS.items():
        event = event.when(word.isin(words), name)
    place = F.split("last_location", r",\s*")

    def one(feed: DataFrame) -> DataFrame:
        return feed.select(
            "tracking_no",
            F.upper(trimmed("carrier")).alias("carrier"),
            event.otherwise(OTHER_STATUS).alias("event_type"),
            F.coalesce("delivered_at", "shipped_at").alias("event_ts"),
            *[F.get(place, F.lit(i)).alias(f"location_{n}") for i, n in enumerate(("city", "region", "country"))],
            "date_ts",
            date_of_key("date_ts").alias("partition_date"),
        )

    united = one(feeds[0])
    for feed in feeds[1:]:
        united = united.unionByName(one(feed))
    return united


def merged_returns_cdc(changes: DataFrame) -> DataFrame:
    """Latest state of every return; deleted ones stay, flagged."""
    deleted = (F.col("op") == "D").cast("int")
    newest = [
        F.col("snapshot_date").desc_nulls_last(),
        F.col("return_ts").desc_nulls_last(),
        deleted.desc_nulls_last(),
    ]
    state = latest_per_key(changes, ["return_id"], newest)
    return state.withColumn("is_deleted", F.coalesce(F.col("op") == "D", F.lit(False))).drop("op")


def fraud_scored(pos_transactions: DataFrame, clicks: DataFrame, fraud_signals: DataFrame) -> DataFrame:
    """Transactions scored by what was known of their customer when they were made.

    The last fraud signal and the last click at or before a transaction count, never a later one. The score is
    the greater of the signal's score and the click's bot score; ``signals`` names the signal's type, and
    ``bot`` if the click looks like one, so it has two entries at most.
    """
    known = last_before(
        pos_transactions,
        "customer_id",
        "txn_ts",
        {
            "_signal": (fraud_signals, "customer_id", "signal_ts", ["signal_ts", "score", "signal_type"]),
            "_click": (clicks, "user_id", "event_ts", ["event_ts", "bot_score"]),
        },
    )
    of_click = F.coalesce(F.col("_click.bot_score").cast("double"), F.lit(0.0))
    score = F.greatest(F.coalesce("_signal.score", F.lit(0.0)), of_click)
    band = F.when(score >= FRAUD_BANDS[0][0], FRAUD_BANDS[0][1])
    for low, name in FRAUD_BANDS[1:]:
        band = band.when(score >= low, name)
    seen = F.array(F.col("_signal.signal_type"), F.when(of_click >= BOT_SUSPECT, F.lit("bot")))
    return known.select(
        "txn_id",
        "customer_id",
        score.cast("decimal(5,4)").alias("fraud_score"),
        band.alias("risk_band"),
        F.array_compact(seen).alias("signals"),
        F.coalesce(F.greatest("_signal.signal_ts", "_click.event_ts"), "txn_ts").alias("scored_at"),
        F.to_date("txn_ts").alias("score_date"),
    )


# ---------------------------------------------------------------- warehouse


def warehouse_kpi_snapshot(
    movements: DataFrame, picks: DataFrame, key: str = "warehouse_id"
) -> DataFrame:
    """Hourly stock flow and picking speed. The backlog is what came in and was not shipped
    so far; the running sum sees one row per warehouse and hour."""
    hour = lambda c: F.date_trunc("hour", c)
    units = lambda kind: F.sum(F.when(F.col("movement_type") == kind, F.col("quantity")).otherwise(0))
    flow = movements.groupBy(key, hour("movement_ts").alias("snapshot_ts")).agg(
        units("RECEIPT").alias("units_in"), units("SHIP").alias("units_shipped")
    )
    picked = picks.groupBy(key, hour("picked_at").alias("snapshot_ts")).agg(
        F.sum("quantity").alias("units_picked"), F.sum("duration_ms").alias("_ms"), F.count(F.lit(1)).alias("_picks")
    )
    upto = Window.partitionBy(key).orderBy("snapshot_ts").rowsBetween(Window.unboundedPreceding, 0)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    both = flow.join(picked, [key, "snapshot_ts"], "full").select(
        key, "snapshot_ts", zero("units_in"), zero("units_picked"), zero("units_shipped"), zero("_ms"), zero("_picks")
    )
    rate = _ratio(F.col("units_picked") * 3_600_000, F.col("_ms"), "decimal(8,2)")
    return both.select(
        key,
        "snapshot_ts",
        "units_in",
        "units_picked",
        "units_shipped",
        rate.alias("pick_rate_uph"),
        F.sum(F.col("units_in") - F.col("units_shipped")).over(upto).alias("backlog_units"),
        F.try_divide("_ms", "_picks").cast("bigint").alias("avg_pick_ms"),
        day_key(F.col("snapshot_ts")).alias("date_ts"),
        F.to_date("snapshot_ts").alias("partition_date"),
    )


def agg_hourly_warehouse_kpi(snapshot: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    known = dim_warehouse.select("warehouse_id", "warehouse_sk")
    return snapshot.join(known, "warehouse_id").select(
        "warehouse_sk", "units_in", "units_picked", "units_shipped", "pick_rate_uph", "backlog_units",
        (F.col("avg_pick_ms").cast("decimal(14,4)") / 1000).cast("decimal(8,2)").alias("avg_pick_seconds"),
        F.date_format("snapshot_ts", "yyyyMMddHH").alias("snapshot_hour"),
    )


def fact_inventory_snapshot(movements: DataFrame) -> DataFrame:
    """End-of-day stock per article and warehouse, one row per day with a movement.

    Receipts count up, everything else down. Allocated is what was picked and not yet
    shipped, in transit what was shipped that day; the average cost is that of all
    receipts so far. The running sums see one row per day.
    """
    kind, quantity = F.col("movement_type"), F.col("quantity")
    of = lambda name, c=quantity: F.sum(F.when(kind == name, c).otherwise(0))
    cost = F.col("unit_cost") if "unit_cost" in movements.columns else F.lit(None).cast("decimal(12,4)")
    daily = movements.groupBy("sku", "warehouse_sk", F.to_date("movement_ts").alias("snapshot_date")).agg(
        F.sum(F.when(kind == "RECEIPT", quantity).otherwise(-quantity)).alias("_delta"),
        of("RECEIPT").alias("_received"),
        F.sum(F.when(kind == "RECEIPT", quantity * cost)).alias("_paid"),
        of("PICK").alias("_picked"),
        of("SHIP").alias("_shipped"),
        F.max("movement_ts").alias("last_movement_ts"),
    )
    upto = (
        Window.partitionBy("sku", "warehouse_sk")
        .orderBy("snapshot_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    so_far = lambda c: F.sum(c).over(upto)
    stock = daily.select(
        "sku", "warehouse_sk",
        so_far("_delta").alias("on_hand_units"),
        F.greatest(so_far("_picked") - so_far("_shipped"), F.lit(0).cast("bigint")).alias("allocated_units"),
        F.col("_shipped").alias("in_transit_units"),
        _ratio(so_far("_paid"), so_far("_received"), "decimal(12,4)").alias("avg_cost"),
        "last_movement_ts", "snapshot_date",
    )
    return stock.withColumn("available_units", F.col("on_hand_units") - F.col("allocated_units"))


# ---------------------------------------------------------------- sales aggregates


def agg_daily_sales_by_store(pos_transactions: DataFrame) -> DataFrame:
    kept = pos_transactions.filter(~F.coalesce("void_flag", F.lit(False)))
    return (
        kept.groupBy("store_sk", F.to_date("txn_ts").alias("sale_date"))
        .agg(
            F.sum("gross_amount").cast("decimal(16,2)").alias("gross_revenue"),
            F.sum(F.col("gross_amount") - F.col("discount_amount")).cast("decimal(16,2)").alias("net_revenue"),
            F.sum("line_count").alias("units_sold"),
            F.count(F.lit(1)).alias("txn_count"),
        )
        .withColumn("avg_basket", _ratio(F.col("gross_revenue"), F.col("txn_count"), "decimal(12,2)"))
    )


def agg_daily_sales_by_product(
    fact_sales: DataFrame, fact_returns: DataFrame, dim_product: DataFrame, cost_share: str = "0.6"
) -> DataFrame:
    """Daily units, revenue, cost of goods and returns per product. The cost of a product is
    ``cost_share`` of its list price."""
    sold = fact_sales.groupBy("product_sk", "sale_date").agg(
        F.sum("quantity").alias("units_sold"), F.sum("line_total").alias("gross_revenue")
    )
    back = fact_returns.groupBy("product_sk", F.col("return_date").alias("sale_date")).agg(
        F.sum("quantity").alias("return_units")
    )
    costs = dim_product.select(
        "product_sk", (F.col("unit_price") * F.lit(cost_share).cast("decimal(3,2)")).alias("_cost")
    )
    units = F.coalesce("units_sold", F.lit(0)).cast("bigint")
    revenue = F.coalesce("gross_revenue", F.lit(0)).cast("decimal(16,2)")
    returned = F.coalesce("return_units", F.lit(0)).cast("bigint")
    daily = sold.join(back, ["product_sk", "sale_date"], "full").join(costs, "product_sk", "left")
    daily = daily.select(
        "product_sk", "sale_date",
        units.alias("units_sold"), revenue.alias("gross_revenue"), returned.alias("return_units"),
        (F.coalesce("_cost", F.lit(0)) * units).cast("decimal(16,2)").alias("cogs"),
        (units - returned).alias("net_units"),
    )
    margin = _ratio(F.col("gross_revenue") - F.col("cogs"), F.col("gross_revenue"), "decimal(6,4)")
    return daily.withColumn("margin_pct", margin)


def agg_weekly_customer_ltv(fact_sales: DataFrame) -> DataFrame:
    """Value to date per customer and week with an order. The windows see one row per week."""
    week = F.trunc("sale_date", "week").alias("week_start_date")
    weekly = (
        fact_sales.groupBy("customer_sk", week, "invoice_no")
        .agg(F.sum("line_total").alias("revenue"), F.max("sale_date").alias("last_day"))
        .groupBy("customer_sk", "week_start_date")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.count("invoice_no").alias("orders"),
            F.max("last_day").alias("last_day"),
        )
    )
    upto = (
        Window.partitionBy("customer_sk")
        .orderBy("week_start_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    idle = F.datediff(F.date_add("week_start_date", 6), F.col("last_day")).cast("bigint")
    orders = F.sum("orders").over(upto)
    value = F.sum("revenue").over(upto)
    risk = F.least(F.lit(1), idle.cast("decimal(10,0)") / 365).cast("decimal(4,3)")
    return weekly.select(
        "customer_sk",
        value.cast("decimal(16,2)").alias("ltv_to_date"),
        orders.alias("orders_to_date"),
        _ratio(value, orders, "decimal(12,2)").alias("avg_order_value"),
        idle.alias("days_since_last_order"),
        recency_bucket(orders, idle).alias("rfm_score"),
        risk.alias("churn_risk"),
        "week_start_date",
    )


def agg_monthly_supplier_performance(receipts: DataFrame) -> DataFrame:
    """Supplier scorecard by month of order."""
    per_order = receipts.groupBy("supplier_sk", month_start(F.col("ordered_ts")).alias("month_start"), "order_no").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("received_ts") <= F.col("due_ts")).alias("on_time"),
        F.sum("ordered_units").alias("ordered"),
        F.sum("received_units").alias("received"),
        F.sum("rejected_units").alias("rejected"),
        F.sum(F.datediff("received_ts", "ordered_ts")).alias("lead_days"),
        F.sum("line_total").alias("spend"),
    )
    total = lambda c: F.sum(c)
    return per_order.groupBy("supplier_sk", "month_start").agg(
        F.count("order_no").alias("orders_placed"),
        total("received").alias("units_received"),
        _ratio(total("on_time"), total("lines"), "decimal(5,4)").alias("on_time_pct"),
        _ratio(total("received"), total("ordered"), "decimal(5,4)").alias("fill_rate_pct"),
        _ratio(total("lead_days"), total("lines"), "decimal(6,2)").alias("avg_lead_time_days"),
        _ratio(total("lines") - total("rejected"), total("lines"), "decimal(4,3)").alias("quality_score"),
        total("spend").cast("decimal(16,2)").alias("total_spend"),
    )


def agg_daily_carrier_otd(fact_shipments: DataFrame) -> DataFrame:
    """Daily on-time share per carrier against each shipment's own promise. Undelivered
    shipments are in transit and outside the share."""
    promise = F.col("shipped_ts") + F.make_dt_interval(hours=F.col("sla_hours").cast("int"))
    done, on_time = F.col("delivered_ts").isNotNull(), F.col("delivered_ts") <= promise
    seconds = F.sum(F.unix_seconds("delivered_ts") - F.unix_seconds("shipped_ts"))
    return fact_shipments.groupBy("carrier", F.to_date("shipped_ts").alias("ship_date")).agg(
        F.count(F.lit(1)).alias("shipments_total"),
        F.count_if(on_time).alias("delivered_on_time"),
        F.count_if(done & ~on_time).alias("delivered_late"),
        F.count_if(~done).alias("in_transit"),
        _ratio(F.count_if(on_time), F.count_if(done), "decimal(5,4)").alias("otd_pct"),
        _ratio(seconds, F.count_if(done) * 3600, "decimal(8,2)").alias("avg_transit_hours"),
    )


def agg_marketing_attribution_cube(sales: DataFrame) -> DataFrame:
    """Every combination of channel, campaign and region within a period, with its grouping
    bits (1 = summed over, channel highest)."""
    period = F.col("period_date")
    grain = [F.col(c) for c in ("channel", "campaign_sk", "region")]
    folded = sales.groupBy(period, *grain).agg(
        F.sum("revenue").alias("revenue"), F.sum("units").alias("units"), F.sum("cost").alias("cost")
    )
    sets = [[period, *some] for n in range(4) for some in combinations(grain, n)]
    cube = folded.groupingSets(sets, period, *grain).agg(
        F.sum("revenue").cast("decimal(16,2)").alias("attributed_revenue"),
        F.sum("units").alias("attributed_units"),
        F.sum("cost").cast("decimal(14,2)").alias("cost"),
        F.grouping_id().cast("bigint").alias("grouping_id"),
    )
    return cube.withColumn("roas", _ratio(F.col("attributed_revenue"), F.col("cost"), "decimal(8,4)"))


def agg_returns_by_reason_monthly(fact_returns: DataFrame, fact_sales: DataFrame) -> DataFrame:
    """Monthly returns per reason, with the days since the invoice's first sale date."""
    sold = fact_sales.groupBy("invoice_no").agg(F.min("sale_date").alias("sale_date"))
    days = F.datediff("return_date", "sale_date")
    return (
        fact_returns.join(sold, "invoice_no", "left")
        .groupBy("reason_code", month_start(F.col("return_date")).alias("month_start"))
        .agg(
            F.count(F.lit(1)).alias("return_count"),
            F.sum("quantity").alias("return_units"),
            F.sum("refund_amount").cast("decimal(16,2)").alias("total_refunded"),
            _ratio(F.sum(days), F.count(days), "decimal(8,2)").alias("avg_days_to_return"),
        )
    )


def sales_cube(fact_sales: DataFrame, as_of: str | date | None = None) -> DataFrame:
    """Dashboard cube over (country, month, product), (country, month), (country) and the total.

    Only the three upper levels go through grouping sets, over rows folded to one per
    invoice; the product level is a plain aggregate. Both start from the same first
    aggregate with the same columns, so they share its scan and its shuffle.
    """
    month_key = (F.year("sale_date") * 100 + F.month("sale_date")).cast("bigint").alias("month_key")
    amounts = [F.sum("revenue").alias("revenue"), F.sum("units").alias("units")]
    lines = fact_sales.groupBy("country", month_key, "product_sk", "invoice_no").agg(
        F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units")
    )
    products = lines.groupBy("country", "month_key", "product_sk").agg(
        F.count("invoice_no").alias("orders"), *amounts, F.lit(3).alias("dim_level")
    )
    invoices = lines.groupBy("country", "month_key", "invoice_no").agg(*amounts, F.count(F.lit(1)).alias("rows"))
    c, m = F.col("country"), F.col("month_key")
    upper = with_blank_row(invoices, "rows").groupingSets([[c, m], [c], []], c, m).agg(
        F.count_distinct("invoice_no").alias("orders"),
        *amounts,
        F.sum("rows").alias("rows"),
        (2 - F.bit_count(F.grouping_id())).alias("dim_level"),
    )
    upper = upper.filter((F.col("rows") > 0) | (F.col("dim_level") == 0)).drop("rows")
    key = F.concat_ws("|", "country", F.col("month_key").cast("string"), F.col("product_sk").cast("string"))
    return products.unionByName(upper, allowMissingColumns=True).select(
        F.col("dim_level").cast("bigint").alias("dim_level"), key.alias("cube_key"),
        "country", "month_key", "product_sk", "orders",
        F.col("revenue").cast("decimal(18,2)").alias("revenue"), "units",
        (F.lit(as_of).cast("date") if as_of else F.current_date()).alias("as_of_date"),
    )


def top_countries_daily(fact_sales: DataFrame, k: int = 10) -> DataFrame:
    """The k best countries of each day; equal revenue shares a rank. The window sees one
    row per country and day, cut to k per day before its shuffle."""
    per_invoice = fact_sales.groupBy(F.col("sale_date").alias("as_of_date"), "country", "invoice_no").agg(
        F.sum("line_total").alias("revenue")
    )
    daily = per_invoice.groupBy("as_of_date", "country").agg(
        F.count("invoice_no").alias("orders"), F.sum("revenue").cast("decimal(18,2)").alias("revenue")
    )
    w = Window.partitionBy("as_of_date").orderBy(F.col("revenue").desc_nulls_last())
    return daily.withColumn("rank", F.rank().over(w).cast("bigint")).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- history, ledgers, sessions


def change_history(
    states: DataFrame, key: str, attributes: Sequence[str], changed: str, tie: str | None = None,
    grain: str = "month", carried: Sequence[str] = (),
) -> DataFrame:
    """Slowly changing history: a row per change, valid in ``[eff_from, eff_to)``.

    A state equal to the one before it is no change; ``carried`` columns come along with a
    change without being one. ``tie`` orders states of one time.
    ``history_id`` is a hash of key and start.
    """
    order = [changed, tie] if tie else [changed]
    hashed = states.select(key, *order, *attributes, *carried).withColumn("_hash", F.unhex(attribute_hash(attributes)))
    slot = time_slot(changed, grain)
    seen = previous_row(hashed, [key], order, ["_hash"], "_before", slot)
    reason = F.when(F.col("_before").isNull(), "initial").otherwise("change")
    changes = seen.filter(~F.col("_before._hash").eqNullSafe(F.col("_hash")))
    changes = changes.withColumn("change_reason", reason).drop("_before", "_hash")
    chained = next_row(changes, [key], order, [changed], "_after", slot)
    return chained.select(
        F.xxhash64(key, *order).alias("history_id"),
        key,
        *attributes,
        *carried,
        F.col(changed).alias("eff_from"),
        F.col(f"_after.{changed}").alias("eff_to"),
        F.col(f"_after.{changed}").isNull().alias("is_current"),
        "change_reason",
    )


ADDRESSES = History("customer_sk", ("address_line1", "address_city", "address_region", "address_country", "address_postal"), "changed_ts", "order_no")
#: Who made a change of terms is noted, but a new name alone is none.
SUPPLIER_TERMS = History("supplier_sk", ("payment_terms_days", "discount_pct"), "changed_on", carried=("changed_by",))
EMPLOYEES = History("employee_sk", ("role", "department", "home_store_sk", "salary_band"), "changed_on")
STORES = History("store_sk", ("store_type", "manager_employee_sk", "sq_ft"), "changed_on")


def _whole_history(states: DataFrame, h: History) -> DataFrame:
    return change_history(states, h.key, h.attributes, h.changed, h.tie, h.grain, h.carried)


def customer_address_history(states: DataFrame) -> DataFrame:
    return _whole_history(states, ADDRESSES)


def supplier_terms_history(states: DataFrame) -> DataFrame:
    return _whole_history(states, SUPPLIER_TERMS).drop("change_reason")


def employee_history(states: DataFrame) -> DataFrame:
    history = _whole_history(states, EMPLOYEES).drop("change_reason")
    return history.withColumn("eff_from_year", F.year("eff_from").cast("bigint"))


def store_history(states: DataFrame) -> DataFrame:
    return _whole_history(states, STORES)


def loyalty_points_ledger(events: DataFrame, valid_days: int = 365) -> DataFrame:
    """Every member's points movements with the balance after each. Earned points expire."""
    delta = F.when(F.col("event_type") == "REDEEM", -F.col("points")).otherwise(F.col("points"))
    entries = events.select(
        F.col("event_id").alias("entry_id"),
        "member_id",
        delta.alias("points_delta"),
        "event_ts",
        "event_type",
        F.col("tx_id").alias("reference_id"),
        F.when(F.col("event_type") != "REDEEM", F.timestamp_add("DAY", F.lit(valid_days), F.col("event_ts")))
        .alias("expiry_ts"),
    )
    return running_total(
        entries, ["member_id"], ["event_ts", "entry_id"], "points_delta", "running_balance",
        time_slot("event_ts"),
    )


def sessionised_clicks(
    clicks: DataFrame, user: str = "user_sk", ts: str = "event_ts", event_id: str = "event_id",
    gap_minutes: int = SESSION_GAP_MINUTES,
) -> DataFrame:
    """Clicks with a session id: a session ends after a pause of more than ``gap_minutes``."""
    gap = gap_minutes * 60 * 1_000_000
    numbered = group_ordinal(clicks, [user], ts, event_id, gap, "_session", time_slot(ts))
    named = {"session_id": F.concat_ws("-", user, "_session"), "event_date": F.to_date(ts)}
    if "device" in clicks.columns:
        named["platform_partition"] = F.lower("device.platform")
    return numbered.withColumns(named).drop("_session")


def session_state_snapshot(sessions: DataFrame) -> DataFrame:
    """Latest state of every session; platform and country where the clicks carry them."""
    latest = lambda c: F.max_by(c, F.struct("event_ts", "event_id"))
    bought = F.col("event_type") == "purchase"
    carried = {"platform": "device.platform", "geo_country": "geo_country"}
    carried = {name: c for name, c in carried.items() if c.split(".")[0] in sessions.columns}
    return sessions.groupBy("session_id").agg(
        latest(F.col("user_sk").cast("string")).alias("user_id"),
        F.min("event_ts").alias("started_ts"),
        F.max("event_ts").alias("last_event_ts"),
        F.sum(F.when(bought, F.col("amount")).otherwise(0)).cast("decimal(12,2)").alias("cart_value"),
        F.count_if(bought).alias("cart_items"),
        latest("screen").alias("current_screen"),
        *[latest(c).alias(name) for name, c in carried.items()],
    )


# ---------------------------------------------------------------- sketches


#: Sketches of 2^14 registers: a relative error of 0.8 % at one standard deviation.
SKETCH_BITS = 14


def member_sketches(fact_loyalty_events: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Members who redeemed, per day and region, as sketches that can be merged over any days and regions.

    Members are sketched as they are read, in map-side aggregates; no list of members is made.
    """
    redeemed = fact_loyalty_events.filter(F.col("event_type") == "REDEEM")
    per_store = redeemed.groupBy("event_date", "store_sk").agg(
        F.hll_sketch_agg("member_id", SKETCH_BITS).alias("members"), F.sum("points").alias("points")
    )
    stores = dim_store.select("store_sk", "region")
    return per_store.join(stores, "store_sk", "left").groupBy("event_date", "region").agg(
        F.hll_union_agg("members").alias("members"), F.sum("points").alias("points")
    )


def sketched_panel(sketches: DataFrame, first: str | date, last: str | date) -> DataFrame:
    """The member panel of any days out of stored sketches: one row per region, whatever the number of members."""
    days = sketches.filter(F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return days.groupBy("region").agg(
        F.hll_sketch_estimate(F.hll_union_agg("members")).alias("approx_active_members"),
        F.sum("points").alias("total_points_redeemed"),
    )


# ---------------------------------------------------------------- nested and typed facts


def supplier_invoice_lines(invoices: DataFrame) -> DataFrame:
    """One row per line of a nested supplier invoice; the line's id is a hash of its place."""
    line = F.posexplode("line_items").alias("line_no", "line")
    return invoices.select("invoice_no", "supplier_sk", "currency", "received_ts", line).select(
        F.xxhash64("invoice_no", "line_no").alias("invoice_line_id"),
        "invoice_no",
        (F.col("line_no") + 1).cast("bigint").alias("line_no"),
        "supplier_sk",
        F.col("line.sku").alias("sku"),
        F.col("line.qty").alias("quantity"),
        F.col("line.unit_price").cast("decimal(12,4)").alias("unit_cost"),
        (F.col("line.qty") * F.col("line.unit_price")).cast("decimal(14,2)").alias("line_total"),
        F.col("currency").alias("currency_code"),
        "received_ts",
        F.year("received_ts").cast("bigint").alias("invoice_year"),
        F.month("received_ts").cast("bigint").alias("invoice_month"),
        month_start(F.to_date("received_ts")).alias("partition_month"),
    )


def tracking_history(scans: DataFrame) -> DataFrame:
    """A shipment's scans of a day in time order as an array."""
    fields = ["ts", "status", "location"]
    dated = scans.withColumn("scan_date", F.to_date("ts"))
    return ordered_lists(dated, ["shipment_id", "scan_date"], fields, fields, "tracking_events")


def fact_shipments(shipments: DataFrame, scans: DataFrame) -> DataFrame:
    """Shipments with all their scans in time order, as declared; one without scans has an empty array.

    A parcel's scans are few, so one row can hold them; for a feed whose keys are not parcels use ``tracking_history``.
    """
    fields = ["ts", "status", "location"]
    events = ordered_lists(scans.filter(F.col("shipment_id").isNotNull()), ["shipment_id"], fields, fields, "tracking_events")
    none = F.array().cast(events.schema["tracking_events"].dataType)
    day = F.to_date("shipped_ts")
    return shipments.join(events, "shipment_id", "left").select(
        *shipments.columns,
        F.coalesce("tracking_events", none).alias("tracking_events"),
        *[part(day).cast("bigint").alias(f"ship_{name}") for name, part in (("year", F.year), ("month", F.month), ("day", F.dayofmonth))],
        F.col("carrier").alias("carrier_partition"),
        day.alias("partition_date"),
    )


def email_clicks(events: DataFrame) -> DataFrame:
    """The clicks of every send and day in time order, with its last event and the number of all its events."""
    sends = ["send_id", "campaign_sk", "user_sk", "event_date"]
    dated = events.withColumn("event_date", F.to_date("event_ts"))
    last = F.max(F.struct("event_ts", "link_url", "event_type")).alias("last")
    click = F.when(F.col("event_type") == "click", F.struct(F.col("event_ts").alias("ts"), F.col("link_url").alias("url")))
    found = dated.groupBy(*sends).agg(F.count(F.lit(1)).alias("events"), last, F.array_sort(F.collect_list(click)).alias("clicks"))
    return found.select(*sends, "events", "last.*", "clicks")


def fact_web_session(web_log: DataFrame) -> DataFrame:
    """The named web log with types."""
    return web_log.select(
        F.try_to_timestamp("event_ts", F.lit("yyyy-MM-dd HH:mm:ss")).alias("event_ts"),
        "ip", "url", "user_id", "city", "state",
        F.try_to_date(F.substring("date_ts", 1, 8), "yyyyMMdd").alias("event_date"),
        "country",
    )
