"""Queries over the given tables, one per operator or derived table.

Each is ``name(t)`` with ``t`` a :class:`TestTables`; results are projected to plain
column types (text for dates and times, double for decimals) so that another engine's
answer can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright import catalog
from tillwright.functions import enrich
from tillwright.operators import checks, history, ingest
from tillwright.plans import derived, register, views
from tillwright.plans.adapters import SALE_COUNTRIES, TestTables, money, pick
from tillwright.session import scratch_dir
from tillwright.sources import readers, writers
from tillwright.streaming import jobs

SALES_TODAY = "2001-08-02"
SHIPPING_TODAY = "2000-01-01"
EVENTS_TODAY = "2024-01-31"
SIGNALS_TODAY = "2024-01-20"
LOAD_BOUND = "1998-06-30T00:00:00Z"

QUERIES: dict[str, Callable[[TestTables], DataFrame]] = {}


def query(fn: Callable[[TestTables], DataFrame]) -> Callable[[TestTables], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable column types; doubles are rounded."""

    def column(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits)
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.IntegerType):
            c = c.cast("bigint")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


# ---------------------------------------------------------------- views


@query
def daily_sales_by_country(t):
    return plain(views.vw_daily_sales_by_country(t))


@query
def weekly_running_totals(t):
    df = views.vw_weekly_sales_with_running_totals(t)
    return plain(df.withColumn("rolling_13wk_avg", F.round(F.col("rolling_13wk_avg").cast("double"), 2)))


@query
def customer_ltv(t):
    return plain(views.vw_customer_lifetime_value(t, SALES_TODAY))


@query
def product_performance(t):
    return plain(views.vw_product_performance(t))


@query
def cohort_retention(t):
    return plain(views.vw_monthly_cohort_retention(t))


@query
def session_attribution(t):
    tables = {
        "mobile_events": t["mobile_events"],
        "dim_customer": t["dim_customer"],
        "fact_sales": t["purchases"],
    }
    return plain(views.vw_session_to_order_attribution(tables))


@query
def active_member_panel(t):
    # the approximate count is checked against the exact one in the tests
    return plain(views.vw_active_member_panel(t, EVENTS_TODAY).drop("approx_active_members"))


@query
def sales_rollup(t):
    return plain(views.vw_sales_rollup_by_region(t, SALES_TODAY))


@query
def category_tree(t):
    return plain(views.vw_category_hierarchy_recursive(t))


@query
def carrier_otd(t):
    return plain(views.vw_otd_by_carrier_30d(t, SHIPPING_TODAY))


@query
def panel_continuity(t):
    return plain(views.vw_panel_continuity_score(t, SALES_TODAY))


@query
def orders_with_consent(t):
    return plain(views.v_eu_orders_with_consent(t))


@query
def returns_pending(t):
    return plain(views.v_returns_pending(t, SALES_TODAY))


@query
def fraud_recent(t):
    return plain(views.v_fraud_signals_recent(t, SIGNALS_TODAY))


@query
def omniture(t):
    return plain(views.omniture(t))


# ---------------------------------------------------------------- functions


@query
def country_code(t):
    return enrich.with_country_code(t["fact_sales"], "country").groupBy("country", "country_code").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def email_hash(t):
    c = t.raw("customer")
    address = F.concat(F.lit("  "), F.col("c_name"), F.lit("@Example.COM "))
    return enrich.pseudonymise(c.select("c_custkey", address.alias("email")), "email")


@query
def sku_parts(t):
    p = t.raw("part")
    code = F.concat_ws("-", F.upper(F.substring("p_name", 1, 2)), F.col("p_partkey"), F.col("p_size"))
    return enrich.with_sku_parts(p.select("p_partkey", code.alias("sku")), "sku")


@query
def ip_region(t):
    e = t.raw("events")
    ip = F.concat_ws(".", F.col("event_id") % 260, F.lit(7), F.lit(7), F.lit(7))
    ip = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), ip)).otherwise(ip)
    return enrich.with_ip_region(e.select("event_id", ip.alias("ip")), "ip")


@query
def payment_terms(t):
    s = t.raw("supplier").select("s_suppkey", F.format_string("SUP-%03d", F.col("s_suppkey")).alias("supplier_id"))
    return enrich.with_payment_terms(s, enrich.supplier_terms(t.spark), "supplier_id")


@query
def sql_functions(t):
    """The five functions under their SQL names, called from SQL text."""
    register.register_functions(t.spark)
    c = t.raw("customer").select(
        "c_custkey",
        F.concat(F.lit(" "), pick(SALE_COUNTRIES, F.col("c_nationkey"))).alias("country"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("AB-"), F.col("c_custkey"), F.lit("-7")).alias("sku"),
        F.concat(F.col("c_custkey") % 256, F.lit(".0.0.1")).alias("ip"),
        F.format_string("SUP-%03d", F.col("c_custkey")).alias("supplier"),
    )
    return t.spark.sql(
        """SELECT c_custkey, normalize_country(country) AS country, hash_customer_email(email) AS email,
                  parse_legacy_sku(sku) AS sku, geoip_city(ip) AS region, lookup_supplier_terms(supplier) AS days
           FROM {customers}""",
        customers=c,
    )


# ---------------------------------------------------------------- ingest steps


def _keyed_orders(t) -> DataFrame:
    day = F.col("o_orderdate")
    return t.raw("orders").select(
        "o_orderkey",
        F.concat(F.date_format(day, "yyyyMMdd"), F.lit("_"), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"))
        .alias("date_ts"),
        day.alias("order_ts"),
        F.to_date(day).alias("order_date"),
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        F.unix_millis(day).alias("epoch_ms"),
    )


@query
def bound_string(t):
    return ingest.bound(_keyed_orders(t), "date_ts", LOAD_BOUND).select("o_orderkey", "date_ts")


@query
def bound_ts(t):
    return plain(ingest.bound(_keyed_orders(t), "order_ts", LOAD_BOUND).select("o_orderkey", "order_ts"))


@query
def bound_date(t):
    return plain(ingest.bound(_keyed_orders(t), "order_date", LOAD_BOUND).select("o_orderkey", "order_date"))


@query
def partition_date_from_key(t):
    df = ingest.partition_date(_keyed_orders(t), "partition_date", source="date_ts")
    return plain(df.select("o_orderkey", "date_ts", "partition_date"))


@query
def partition_date_from_parts(t):
    df = ingest.partition_date(_keyed_orders(t), "partition_date", parts=("year", "month", "day"))
    df = ingest.partition_date(df, "partition_month", parts=("year", "month"))
    return plain(df.select("o_orderkey", "partition_date", "partition_month"))


@query
def epoch_ts(t):
    df = ingest.epoch_to_ts(_keyed_orders(t), "epoch_ms", "millis")
    return plain(df.select("o_orderkey", "epoch_ms"))


@query
def map_json(t):
    e = t.raw("events")
    pairs = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    return ingest.map_to_json(e.select("event_id", pairs.alias("properties")), "properties", "props_json")


@query
def json_fields(t):
    """A field of JSON text, read when it is asked for."""
    field = F.get_json_object("payload_json", "$.k").try_cast("bigint").alias("k")
    return t["events_eu"].select("event_id", "event_type", field)


@query
def conform_types(t):
    """Widening and retyping to a declared schema."""
    shape = T.StructType.fromDDL(
        "l_orderkey bigint, l_linenumber bigint, l_quantity bigint, l_extendedprice decimal(14,2), note string"
    )
    return plain(ingest.conform(t.raw("lineitem"), shape).drop("note"))


@query
def bounded_scan(t):
    sales = t["fact_sales"]
    year = readers.scan_bounded(sales, "sale_date", "1997-01-01", "1997-12-31")
    return plain(year.groupBy("sale_date").agg(F.count(F.lit(1)).alias("n"), F.sum("line_total").alias("revenue")))


# ---------------------------------------------------------------- readers and writers
# Spark first writes the table in the format at hand into the shared scratch folder.


def _orders_text(t) -> DataFrame:
    return t.raw("orders").select(
        F.col("o_orderkey"),
        F.col("o_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        money("o_totalprice", 14).alias("total"),
        F.to_date("o_orderdate").alias("day"),
    )


ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, status string, total decimal(14,2), day date"


@query
def csv_feed(t):
    path = scratch_dir(t.spark, "csv")
    _orders_text(t).write.option("header", "true").csv(path)
    return plain(readers.read_csv(t.spark, path, ORDERS_SCHEMA))


@query
def tsv_feed(t):
    path = scratch_dir(t.spark, "tsv")
    _orders_text(t).write.option("sep", "\t").csv(path)
    return readers.read_tsv(t.spark, path, column_count=5)


@query
def orc_feed(t):
    path = scratch_dir(t.spark, "orc")
    _orders_text(t).write.orc(path)
    return plain(readers.read_orc(t.spark, path))


@query
def json_feed(t):
    path = scratch_dir(t.spark, "json")
    pairs = F.create_map(F.lit("kind"), F.col("event_type"))
    e = t.raw("events").select("event_id", "user_id", pairs.alias("properties"))
    e.write.json(path)
    schema = "event_id bigint, user_id bigint, properties map<string,string>"
    df = readers.read_json(t.spark, path, schema).filter(F.col(readers.CORRUPT).isNull())
    return ingest.map_to_json(df, "properties").drop(readers.CORRUPT)


LOYALTY_PATTERN = r"^([^|]+)\|([^|]+)\|([^|]+)\|([^|]+)\|([^|]+)\|TX:([^;]+);META:(.*)$"
LOYALTY_COLUMNS = ("event_ts_str", "member_id", "event_type", "points", "store_id", "tx_id", "meta_raw")


@query
def regex_feed(t):
    path = scratch_dir(t.spark, "regex")
    t["loyalty_lines"].write.text(path)
    parsed = derived.parsed_loyalty_events(readers.read_regex(t.spark, path, LOYALTY_PATTERN, LOYALTY_COLUMNS))
    return plain(parsed)


@query
def snapshot_feed(t):
    path = scratch_dir(t.spark, "snapshot")
    t.raw("events").select("event_id", F.unix_millis("ts").alias("last_updated_ts")).write.parquet(path)
    return plain(ingest.epoch_to_ts(readers.read_snapshot(t.spark, path), "last_updated_ts"))


@query
def partition_directories(t):
    """Directory values stay text, even when all digits."""
    path = scratch_dir(t.spark, "dirs")
    e = t.raw("events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("date_ts"))
    e.write.partitionBy("date_ts").csv(path)
    df = readers.read_csv(t.spark, path, "event_id bigint", header=False)
    return plain(ingest.partition_date(df, "partition_date", source="date_ts"))


@query
def table_load(t):
    """A whole load: delimited source, bound, partition month, partitioned write, read back."""
    source, target = scratch_dir(t.spark, "load-in"), scratch_dir(t.spark, "load-out")
    _keyed_orders(t).select("o_orderkey", "date_ts", "year", "month").write.option("header", "true").csv(source)
    spec = {
        "source": {"database": "raw", "table": "orders", "format": "textfile_csv", "path": source},
        "target": {"table": "orders"},
        "transforms": {
            "partition_key_conversion": {
                "source_cols": ["year", "month"], "target_col": "partition_month",
                "parse_fn": "DATE", "generated_column": True,
            },
            "type_widening": [{"col": "o_orderkey", "from": "INT", "to": "INT64"}],
        },
        "validation": {"watermark_col": "date_ts", "null_check_cols": ["o_orderkey"]},
    }
    ingest.load_table(t.spark, spec, LOAD_BOUND, target)
    loaded = t.spark.read.schema("o_orderkey bigint, date_ts string, partition_month date").parquet(target)
    return plain(loaded)


@query
def load_report(t):
    """What a load of damaged lines could not read, per column, beside the rows it wrote."""
    source, target = scratch_dir(t.spark, "report-in"), scratch_dir(t.spark, "report-out")
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.to_json(F.struct("o_orderkey", price.alias("o_totalprice")))
    cut = F.when(F.col("o_orderkey") % 7 == 0, F.left(line, F.lit(9))).otherwise(line)
    t.raw("orders").select(cut.alias("value")).write.text(source)
    spec = {
        "source": {
            "database": "raw", "table": "orders", "format": "json_serde", "path": source,
            "schema": "o_orderkey bigint, o_totalprice string",
        },
        "target": {"table": "orders", "schema": "o_orderkey bigint, o_totalprice double"},
        "transforms": {},
        "validation": {},
    }
    load = ingest.load_table(t.spark, spec, None, target)
    return t.spark.createDataFrame(sorted({"rows": load.rows, **load.lost}.items()), "name string, n bigint")


@query
def clustered_write(t):
    path = scratch_dir(t.spark, "write")
    monthly = t["fact_sales"].withColumn("sale_month", F.trunc("sale_date", "month"))
    writers.write_table(monthly, path, "sale_month", ["customer_sk"])
    sales = t.spark.read.parquet(path)
    return plain(
        sales.groupBy("sale_month", "sale_date").agg(
            F.count(F.lit(1)).alias("n"), F.sum("line_total").alias("revenue")
        )
    )


# ---------------------------------------------------------------- checks


def _two_profiles(t) -> tuple[DataFrame, DataFrame]:
    orders, events = _keyed_orders(t), t.raw("events").withColumn("day", F.to_date("ts"))
    bounded = ingest.bound(orders, "date_ts", LOAD_BOUND)
    have = checks.profile({
        "orders": (bounded, ["order_date"]), "events": (events, ["day"]), "customer": (t.raw("customer"), []),
    })
    want = checks.profile({"orders": (orders, ["order_date"]), "events": (events, ["day"])})
    return have, want


@query
def table_profile(t):
    return _two_profiles(t)[0]


@query
def row_parity(t):
    return checks.check_rows(*_two_profiles(t))


@query
def partition_parity(t):
    return checks.check_partitions(*_two_profiles(t))


@query
def parity_summary(t):
    return checks.summary(*_two_profiles(t))


@query
def null_key_check(t):
    s = t["fact_shipments"]
    return checks.null_keys(s, ["shipment_id", "invoice_no", "delivered_ts"], {"invoice_no": 0})


@query
def type_conformance(t):
    o = t.raw("orders").select(
        F.col("o_orderkey").cast("string").alias("order_no"),
        F.col("o_orderpriority").alias("priority"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    shape = T.StructType.fromDDL("order_no bigint, priority bigint, day date")
    return checks.conformance(o, shape)


# ---------------------------------------------------------------- derived tables


@query
def cleansed_orders(t):
    return plain(derived.cleansed_orders(t["sales_retail"], t["pos_transactions"]))


@query
def dedup_clickstream(t):
    return plain(derived.dedup_clickstream(t["clicks"], bot_limit=0.5, per_minute=8))


@query
def carrier_events(t):
    return plain(derived.normalized_carrier_events(t["shipment_tracking"], t["postal_tracking"]))


@query
def cdc_merge(t):
    return plain(derived.merged_returns_cdc(t["returns_cdc"]))


@query
def fraud_scored(t):
    clicks = derived.dedup_clickstream(t["clicks"], bot_limit=2.0, per_minute=8)
    df = derived.fraud_scored(t["online_transactions"], clicks, t["fraud_signals"])
    return plain(df.withColumn("signals", F.array_join("signals", ",")))


@query
def warehouse_kpi(t):
    return plain(derived.warehouse_kpi_snapshot(t["inventory_movements"], t["warehouse_picks"]))


@query
def hourly_warehouse_kpi(t):
    snapshot = derived.warehouse_kpi_snapshot(t["inventory_movements"], t["warehouse_picks"])
    return plain(derived.agg_hourly_warehouse_kpi(snapshot, t["dim_warehouse"]))


@query
def inventory_snapshot(t):
    return plain(derived.fact_inventory_snapshot(t["inventory_movements"]))


@query
def daily_sales_by_store(t):
    return plain(derived.agg_daily_sales_by_store(t["pos_transactions"]))


@query
def daily_sales_by_product(t):
    return plain(derived.agg_daily_sales_by_product(t["fact_sales"], t["fact_returns"], t["dim_product"]))


@query
def weekly_customer_ltv(t):
    return plain(derived.agg_weekly_customer_ltv(t["fact_sales"]))


@query
def supplier_performance(t):
    return plain(derived.agg_monthly_supplier_performance(t["supplier_receipts"]))


@query
def carrier_daily(t):
    return plain(derived.agg_daily_carrier_otd(t["fact_shipments"]))


@query
def attribution_cube(t):
    return plain(derived.agg_marketing_attribution_cube(t["attributed_sales"]))


@query
def returns_by_reason(t):
    return plain(derived.agg_returns_by_reason_monthly(t["fact_returns"], t["fact_sales"]))


@query
def sales_cube(t):
    return plain(derived.sales_cube(t["fact_sales"], SALES_TODAY))


@query
def top_countries(t):
    return plain(derived.top_countries_daily(t["fact_sales"], k=3))


@query
def address_history(t):
    return plain(derived.customer_address_history(t["customer_addresses"]).drop("history_id"))


@query
def address_history_merged(t):
    """The same history, from three batches of which the last two come late."""
    states, path = t["customer_addresses"], scratch_dir(t.spark, "address-history")
    batch = lambda k: states.filter(F.pmod("order_no", F.lit(3)) == k)
    history.create(batch(0), path, derived.ADDRESSES)
    for k in (1, 2):
        history.merge(batch(k), path, derived.ADDRESSES)
    return plain(history.changes(t.spark, path, derived.ADDRESSES, states.schema).drop("history_id"))


@query
def supplier_terms_history(t):
    return plain(derived.supplier_terms_history(t["supplier_terms_changes"]).drop("history_id"))


@query
def employee_history(t):
    return plain(derived.employee_history(t["employee_states"]).drop("history_id"))


@query
def store_history(t):
    return plain(derived.store_history(t["store_states"]).drop("history_id"))


@query
def sessionise(t):
    clicks = derived.sessionised_clicks(t["app_clicks"])
    return plain(clicks.select("*", "device.*").drop("device"))


@query
def session_state(t):
    return plain(derived.session_state_snapshot(derived.sessionised_clicks(t["app_clicks"])))


@query
def points_ledger(t):
    return plain(derived.loyalty_points_ledger(t["fact_loyalty_events"]))


@query
def supplier_invoice_lines(t):
    return plain(derived.supplier_invoice_lines(t["invoice_documents"]).drop("invoice_line_id"))


def _joined(entries: str, show: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(entries, show), ",")


@query
def tracking_history(t):
    df = derived.tracking_history(t["tracking_scans"])
    show = lambda e: F.concat_ws("@", e["status"], F.date_format(e["ts"], "yyyy-MM-dd HH"), e["location"])
    return plain(df.select("shipment_id", "scan_date", _joined("tracking_events", show).alias("history")))


@query
def shipments_tracked(t):
    df = derived.fact_shipments(t["shipment_orders"], t["tracking_scans"])
    show = lambda e: F.concat_ws("@", e["status"], F.date_format(e["ts"], "yyyy-MM-dd HH"), e["location"])
    return plain(df.withColumn("tracking_events", _joined("tracking_events", show)))


@query
def email_clicks(t):
    df = derived.email_clicks(t["email_events"])
    return plain(df.withColumn("clicks", _joined("clicks", lambda e: e["url"])))


@query
def cleansed_customers(t):
    places = derived.geocoded_addresses(t["customer_signups"], t["dim_geography"], EVENTS_TODAY)
    # the hash is compared through the history tests; here the attributes themselves are
    return plain(derived.cleansed_customers(t["customer_signups"], places).drop("record_hash"))


@query
def cleansed_products(t):
    return plain(derived.cleansed_products(t["product_catalog_feed"], EVENTS_TODAY))


@query
def geocoded_addresses(t):
    return plain(derived.geocoded_addresses(t["customer_signups"], t["dim_geography"], EVENTS_TODAY))


@query
def approx_members(t):
    """Whether the approximate member count lies within 5 % of the exact one."""
    panel = views.vw_active_member_panel(t, EVENTS_TODAY)
    off = F.abs(F.col("approx_active_members") - F.col("exact_active_members"))
    return panel.select("region", (off <= F.col("exact_active_members") * 0.05).alias("close"))


@query
def member_sketches(t):
    """A panel merged from stored daily sketches, and by how many members it misses the exact one beyond 3 %."""
    path = scratch_dir(t.spark, "member-sketches")
    daily = derived.member_sketches(t["fact_loyalty_events"], t["dim_store"])
    daily.repartition("event_date").write.partitionBy("event_date").parquet(path)
    first = F.date_sub(F.lit(EVENTS_TODAY).cast("date"), 30)
    panel = derived.sketched_panel(t.spark.read.parquet(path), first, EVENTS_TODAY)
    exact = views.vw_active_member_panel(t, EVENTS_TODAY).select(F.col("region").alias("_region"), "exact_active_members")
    both = panel.join(exact, F.col("region").eqNullSafe(F.col("_region")))
    off = F.abs(F.col("approx_active_members") - F.col("exact_active_members"))
    beyond = F.greatest(F.lit(0.0), off - 0.03 * F.col("exact_active_members"))
    return plain(both.select("region", "exact_active_members", beyond.alias("members_beyond_bound"), "total_points_redeemed"))


@query
def stored_profile(t):
    """Row and partition counts of stored tables, from footers where there are any."""
    root = scratch_dir(t.spark, "profile")
    e, o = t.raw("events"), t.raw("orders")
    e.withColumn("day", F.to_date("ts")).repartition("day").write.partitionBy("day").parquet(f"{root}/events")
    e.withColumn("day", F.to_date("ts")).repartition("day").write.partitionBy("day").orc(f"{root}/events_orc")
    o.write.parquet(f"{root}/orders")
    o.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/orders_text")
    return checks.stored_profile(
        t.spark,
        {
            "events": (f"{root}/events", "parquet", ["day"]),
            "events_orc": (f"{root}/events_orc", "orc", ["day"]),
            "orders": (f"{root}/orders", "parquet", []),
            "orders_text": (f"{root}/orders_text", "text", []),
        },
    )


@query
def variant_fields(t):
    """JSON text stored as VARIANT, its fields read with their types; broken and null texts among them."""
    path, number = scratch_dir(t.spark, "variant"), F.col("event_id").cast("bigint")
    text = F.when(number % 7 == 0, F.lit(None)).when(number % 7 == 1, F.rtrim(F.col("payload_json"), F.lit("}")))
    text = text.when(number % 7 == 2, F.lit('{"k": "many", "nested": {"list": [1, 2.5]}}')).otherwise(F.col("payload_json"))
    ingest.json_to_variant(t["events_eu"].withColumn("payload", text), "payload").drop("payload_json").write.parquet(path)
    fields = {"k": ("$.k", "bigint"), "k_text": ("$.k", "string"), "second": ("$.nested.list[1]", "decimal(4,1)")}
    found = ingest.variant_fields(t.spark.read.parquet(path), "payload", fields)
    return plain(found.select("event_id", F.col("payload").isNull().alias("is_null"), *fields))


@query
def catalog_scan(t):
    """A table that must be bounded, scanned within days and joined with the Mondays of a calendar."""
    stored = catalog.StoredTables(t.spark, scratch_dir(t.spark, "catalog"))
    sessions = derived.fact_web_session(views.omniture(t))
    sessions.repartition("event_date").write.partitionBy("event_date").parquet(stored.path("fact_web_session"))
    bounded = catalog.BoundedTables(stored, {"fact_web_session": ("2024-01-10", "2024-01-25")})
    days = derived.calendar(t.spark, "2024-01-01", "2024-01-31").filter("d_dow = 1").select("d_date")
    mondays = bounded["fact_web_session"].join(days, F.col("event_date") == F.col("d_date"))
    return plain(mondays.groupBy("event_date", "country").agg(F.count(F.lit(1)).alias("n"), F.max("event_ts").alias("last_ts")))


@query
def sequence_feed(t):
    """Tab-separated invoice lines as the values of a sequence file, written and read back."""
    path = scratch_dir(t.spark, "sequence")
    o = t.raw("orders")
    line = F.concat_ws("\t", F.concat(F.lit("INV-"), F.col("o_orderkey")), F.col("o_orderstatus"), F.col("o_custkey").cast("string"))
    o.select(F.col("o_orderkey").cast("string"), line).rdd.map(tuple).saveAsSequenceFile(path)
    return readers.read_sequence(t.spark, path, ["invoice_no", "status", "customer_id", "missing"]).drop("missing")


@query
def dry_run(t):
    """What a load would write: its rows and declared columns."""
    found = writers.dry_run(t["fact_shipments"])
    return t.spark.createDataFrame([(found.rows, found.schema.count("|--"), len(found.preview))], "row_count bigint, columns bigint, preview_rows bigint")


@query
def audit_row(t):
    """The record of a load of all orders, written over an earlier one and read back."""
    path = scratch_dir(t.spark, "audit")
    for loaded in (1, t.raw("orders").select("o_orderstatus").distinct().count()):
        record = writers.audit_row(t.spark, LOAD_BOUND, loaded, "run-7", completed_at=datetime(2024, 1, 31, 12, 30))
        writers.write_table(record, path)
    return plain(t.spark.read.parquet(path))


@query
def lenient_bound(t):
    """A bound on a column that cannot carry one: leniently, the whole table passes."""
    found = ingest.bound(t.raw("orders"), "o_custkey", LOAD_BOUND, strict=False)
    return found.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query
def parquet_feed(t):
    path = scratch_dir(t.spark, "parquet")
    _orders_text(t).write.parquet(path)
    return plain(readers.read_parquet(t.spark, path, ORDERS_SCHEMA))


@query
def web_session(t):
    return plain(derived.fact_web_session(views.omniture(t)))


@query
def date_dimension(t):
    """Orders per day with the calendar attributes of the day."""
    per_day = t.raw("orders").groupBy(F.to_date("o_orderdate").alias("d_date")).agg(F.count(F.lit(1)).alias("orders"))
    days = t["dim_date"]
    days = days.drop(*[c for c in days.columns if c.startswith("d_current_")])
    return plain(per_day.join(days, "d_date"))


# ---------------------------------------------------------------- streaming runs


@query
def stream_dedup(t):
    clicks = t.as_streams()["clicks"].select(*jobs.CLICK)
    log = scratch_dir(t.spark, "stream-dedup")
    jobs.log_clicks(clicks, log, scratch_dir(t.spark, "stream-dedup-state")).awaitTermination()
    return plain(jobs.deduplicated_clicks(t.spark, log, clicks.schema))


@query
def stream_sessions(t):
    log = scratch_dir(t.spark, "stream-sessions")
    jobs.log_click_times(t.as_streams()["app_clicks"], log, scratch_dir(t.spark, "stream-sessions-state")).awaitTermination()
    return plain(jobs.click_sessions(t.spark, log))


@query
def stream_cdc(t):
    changes = t.as_streams()["returns_cdc"]
    log = scratch_dir(t.spark, "stream-cdc")
    jobs.log_changes(changes, log, scratch_dir(t.spark, "stream-cdc-state")).awaitTermination()
    return plain(jobs.current_returns(t.spark, log, changes.schema))


def build(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: QUERIES[name](TestTables(spark, sf_dir))
