"""The given test tables, read with fixed schemas and shaped into the platform's tables.

Nothing is filtered by key or capped: every adapter covers its whole input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.plans.derived import calendar
from tillwright.session import fit_shuffles, prepare

# Columns of the given tables. Reading the file's zone-less times as
# instants (session zone UTC) keeps time filters free of casts, so they reach the scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
}

# How the eight country groups of the test nations are spelled, once as a
# sale records them and once as the customer master does.
SALE_COUNTRIES = ("usa", "United Kingdom", "DE", "france", "Italia", "canada", "in", "Atlantis")
MASTER_COUNTRIES = ("United States", " uk ", "Germany", "FR", "italy", "CA", "IN", "es")
CARRIERS = ("UPS", "FEDEX", "DHL", "USPS")
REASONS = ("DAMAGED", "WRONG_ITEM", "LATE", "NOT_NEEDED", "OTHER")
PLATFORMS = ("iOS", "Android", "web")
CHANNELS = ("email", "search", "social")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    fit_shuffles(spark, df)
    return df


def pick(options: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (number % len(options) + 1).cast("int"))


def money(c: str | Column, precision: int = 12) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({precision},2)")


def hours(number: Column) -> Column:
    return F.make_dt_interval(hours=number.cast("int"))


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of files."""
    prepare(spark)
    reader = spark.readStream.schema(SCHEMAS[name]).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


class TestTables:
    """Lazy access to the adapted tables: ``tables["fact_sales"]``."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, streaming: bool = False):
        self.spark, self.sf_dir, self.streaming = prepare(spark), sf_dir, streaming

    def raw(self, name: str) -> DataFrame:
        return (stream if self.streaming else read)(self.spark, self.sf_dir, name)

    def as_streams(self) -> TestTables:
        return TestTables(self.spark, self.sf_dir, streaming=True)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def keys(self):
        return [n for n in vars(type(self)) if not n.startswith("_") and n not in ("raw", "keys", "as_streams")]

    # -- dimensions

    def dim_customer(self) -> DataFrame:
        seen = self.raw("orders").groupBy("o_custkey").agg(
            F.min("o_orderdate").alias("first_seen_ts"), F.max("o_orderdate").alias("last_seen_ts")
        )
        c = self.raw("customer")
        return c.join(seen, c.c_custkey == seen.o_custkey, "left").select(
            F.col("c_custkey").alias("customer_sk"),
            F.col("c_custkey").cast("string").alias("customer_id"),
            pick(MASTER_COUNTRIES, F.col("c_nationkey")).alias("country"),
            "first_seen_ts",
            "last_seen_ts",
        )

    def dim_product(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_sk"),
            F.concat(F.lit("P-"), F.col("p_partkey")).alias("stock_code"),
            F.col("p_name").alias("description"),
            money("p_retailprice", 10).alias("unit_price"),
        )

    def dim_store(self) -> DataFrame:
        s, n, r = self.raw("supplier"), self.raw("nation"), self.raw("region")
        return (
            s.join(n, s.s_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(
                F.col("s_suppkey").alias("store_sk"),
                F.col("s_name").alias("store_id"),
                F.col("r_name").alias("region"),
                F.col("n_name").alias("country"),
            )
        )

    def dim_warehouse(self) -> DataFrame:
        stores = self.dim_store()
        return stores.select(
            F.col("store_sk").alias("warehouse_sk"),
            F.concat(F.lit("W-"), F.col("store_sk")).alias("warehouse_id"),
            F.col("region"),
        )

    def dim_date(self) -> DataFrame:
        """The days from the first order to the last; a table without orders has one day."""
        day = F.to_date("o_orderdate")
        span = self.raw("orders").agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
        return calendar(self.spark, span["first"] or "1970-01-01", span["last"] or "1970-01-01")

    def dim_category(self) -> DataFrame:
        """Regions, their nations and their suppliers as a tree; a root has no or an empty parent."""
        s, n, r = self.raw("supplier"), self.raw("nation"), self.raw("region")
        node = lambda stem, key: F.concat(F.lit(stem), F.col(key))
        roots = r.select(
            node("R", "r_regionkey").alias("category_id"),
            F.when(F.col("r_regionkey") % 2 == 0, "").alias("parent_id"),
            F.col("r_name").alias("name"),
        )
        middle = n.select(node("N", "n_nationkey"), node("R", "n_regionkey"), "n_name")
        leaves = s.select(node("S", "s_suppkey"), node("N", "s_nationkey"), "s_name")
        return roots.union(middle).union(leaves)

    def dim_gdpr_consent(self) -> DataFrame:
        """Three consents per customer: two for marketing, one of them withdrawn at times."""
        c = self.raw("customer")
        key = F.col("c_custkey")
        kinds = F.array(F.lit("MARKETING"), F.lit("MARKETING"), F.lit("ANALYTICS"))
        withdrawn = F.when(
            (F.col("pos") == 0) & (key % 5 == 0), F.lit("1998-01-01").cast("timestamp")
        ).when((F.col("pos") == 1) & (key % 3 == 0), F.lit("2000-06-15").cast("timestamp"))
        return c.select("c_custkey", F.posexplode(kinds).alias("pos", "consent_type")).select(
            F.concat_ws("-", key, F.col("pos")).alias("consent_id"),
            key.cast("string").alias("customer_id"),
            "consent_type",
            ((key + F.col("pos")) % 4 != 0).alias("granted"),
            F.timestamp_add("DAY", (key % 300).cast("int"), F.lit("1995-01-01").cast("timestamp")).alias("granted_ts"),
            withdrawn.alias("withdrawn_ts"),
        )

    # -- facts of the order tables

    def _sales(self) -> DataFrame:
        li, o, c = self.raw("lineitem"), self.raw("orders"), self.raw("customer")
        # orders meet their customers first, so the large side is shuffled once, by order
        bought = o.join(c, o.o_custkey == c.c_custkey)
        return li.join(bought, li.l_orderkey == bought.o_orderkey)

    def fact_sales(self) -> DataFrame:
        total = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
        return self._sales().select(
            F.concat(F.lit("INV-"), F.col("l_orderkey")).alias("invoice_no"),
            F.col("o_custkey").alias("customer_sk"),
            F.col("l_partkey").alias("product_sk"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            (money("l_extendedprice") / F.col("l_quantity").cast("decimal(10,0)"))
            .cast("decimal(10,2)").alias("unit_price"),
            money(total, 14).alias("line_total"),
            pick(SALE_COUNTRIES, F.col("c_nationkey")).alias("country"),
            F.col("o_orderdate").alias("invoice_ts"),
            F.to_date("o_orderdate").alias("sale_date"),
        )

    def fact_orders_eu(self) -> DataFrame:
        o, c = self.raw("orders"), self.raw("customer")
        return o.join(c, o.o_custkey == c.c_custkey).select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.upper(F.substring(pick(SALE_COUNTRIES, F.col("c_nationkey")), 1, 2)).alias("country_iso2"),
            money("o_totalprice", 14).alias("line_total"),
            F.lit("EUR").alias("currency_code"),
            F.col("o_orderdate").alias("order_ts"),
        )

    def fact_shipments(self) -> DataFrame:
        shipped = F.col("l_shipdate")
        delivered = shipped + hours(F.col("l_linenumber") * 12)
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("shipment_id"),
            F.concat(F.lit("INV-"), F.col("l_orderkey")).alias("invoice_no"),
            pick(CARRIERS, F.col("l_suppkey")).alias("carrier"),
            shipped.alias("shipped_ts"),
            F.when(F.col("l_linestatus") != "O", delivered).alias("delivered_ts"),
            F.lit(36).cast("bigint").alias("sla_hours"),
        )

    def return_authorizations(self) -> DataFrame:
        li, o = self.raw("lineitem"), self.raw("orders")
        decided = F.col("l_linenumber") % 3
        return li.filter(F.col("l_returnflag") == "R").join(o, li.l_orderkey == o.o_orderkey).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("rma_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.concat(F.lit("INV-"), F.col("l_orderkey")).alias("invoice_no"),
            F.concat(F.lit("P-"), F.col("l_partkey")).alias("stock_code"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_shipdate").alias("requested_at"),
            F.when(decided == 1, False).when(decided == 2, True).alias("approved"),
        )

    def fact_returns(self) -> DataFrame:
        li = self.raw("lineitem").filter(F.col("l_returnflag") == "R")
        return li.select(
            F.concat(F.lit("INV-"), F.col("l_orderkey")).alias("invoice_no"),
            F.col("l_partkey").alias("product_sk"),
            F.timestamp_add("DAY", F.col("l_linenumber"), F.col("l_shipdate")).alias("return_ts"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            money("l_extendedprice").alias("refund_amount"),
            pick(REASONS, F.col("l_partkey")).alias("reason_code"),
            F.to_date(F.timestamp_add("DAY", F.col("l_linenumber"), F.col("l_shipdate"))).alias("return_date"),
        )

    def pos_transactions(self) -> DataFrame:
        """One till transaction per order; store, tender and void flag follow from its keys."""
        o = self.raw("orders")
        gross = money("o_totalprice", 14)
        return o.select(
            F.col("o_orderkey").alias("txn_id"),
            (F.col("o_orderkey") % 10).alias("store_sk"),
            (F.col("o_orderkey") % 10).cast("string").alias("store_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.concat(F.lit("INV-"), F.col("o_orderkey")).alias("invoice_no"),
            F.col("o_orderdate").alias("txn_ts"),
            (F.col("o_orderkey") % 7 + 1).alias("line_count"),
            gross.alias("gross_amount"),
            (F.col("o_custkey") % 50).cast("decimal(14,2)").alias("discount_amount"),
            (F.col("o_custkey") % 20).cast("decimal(14,2)").alias("tax_amount"),
            F.col("o_orderpriority").alias("tender_type"),
            (F.col("o_orderstatus") == "P").alias("void_flag"),
            F.to_date("o_orderdate").alias("partition_date"),
        )

    def sales_retail(self) -> DataFrame:
        return self._sales().select(
            F.concat(F.lit("INV-"), F.col("l_orderkey")).alias("invoice_no"),
            F.concat(F.lit("P-"), F.col("l_partkey")).alias("stock_code"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("invoice_date"),
            money(F.col("l_linenumber").cast("decimal(10,2)") + 1, 10).alias("unit_price"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.date_format("o_orderdate", "yyyyMMdd_HH").alias("date_ts"),
        )

    def supplier_receipts(self) -> DataFrame:
        """Purchase lines as a supplier delivers them."""
        li, o = self.raw("lineitem"), self.raw("orders")
        ordered = F.col("l_quantity").cast("bigint")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("l_suppkey").alias("supplier_sk"),
            F.concat(F.lit("PO-"), F.col("l_orderkey")).alias("order_no"),
            F.col("o_orderdate").alias("ordered_ts"),
            F.timestamp_add("DAY", F.lit(60), F.col("o_orderdate")).alias("due_ts"),
            F.col("l_shipdate").alias("received_ts"),
            ordered.alias("ordered_units"),
            F.greatest(ordered - F.col("l_linenumber") % 3, F.lit(0)).cast("bigint").alias("received_units"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("bigint").alias("rejected_units"),
            money("l_extendedprice", 14).alias("line_total"),
        )

    def inventory_movements(self) -> DataFrame:
        """Every sale line issues stock; the first two lines of an order also receive some."""
        li = self.raw("lineitem")
        kind = F.when(F.col("l_linenumber") <= 2, "RECEIPT").when(F.col("l_linenumber") == 3, "SHIP").otherwise("PICK")
        return li.select(
            F.concat(F.lit("P-"), F.col("l_partkey")).alias("sku"),
            (F.col("l_suppkey") % 10).alias("warehouse_sk"),
            F.concat(F.lit("W-"), F.col("l_suppkey") % 10).alias("warehouse_id"),
            (F.col("l_partkey") % 90 + F.col("l_linenumber")).cast("decimal(10,2)").alias("unit_cost"),
            kind.alias("movement_type"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            (F.col("l_shipdate") + hours(F.col("l_orderkey") % 24)).alias("movement_ts"),
        )

    def warehouse_picks(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(
            F.concat(F.lit("W-"), F.col("l_suppkey") % 10).alias("warehouse_id"),
            F.concat(F.lit("P-"), F.col("l_partkey")).alias("sku"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            (F.col("l_shipdate") + hours(F.col("l_orderkey") % 24)).alias("picked_at"),
            (F.col("l_partkey") % 5000 + 1000).alias("duration_ms"),
        )

    def shipment_tracking(self) -> DataFrame:
        """Carrier feed with each carrier's own status words."""
        li = self.raw("lineitem")
        words = ("Picked Up", "in transit", "OUT FOR DELIVERY", "Delivered", "Returned")
        return li.select(
            F.concat_ws("-", F.lit("T"), "l_orderkey", "l_linenumber").alias("tracking_no"),
            F.concat(F.lit(" "), F.lower(pick(CARRIERS, F.col("l_suppkey")))).alias("carrier"),
            F.col("l_shipdate").alias("shipped_at"),
            F.when(F.col("l_linestatus") != "O", F.col("l_shipdate") + hours(F.col("l_linenumber") * 12)).alias("delivered_at"),
            pick(words, F.col("l_linenumber")).alias("status"),
            F.concat_ws(", ", F.concat(F.lit("City"), F.col("l_suppkey") % 7), F.lit("Region"), F.lit("US")).alias("last_location"),
            F.date_format("l_shipdate", "yyyyMMdd").alias("date_ts"),
        )

    def postal_tracking(self) -> DataFrame:
        """The feed of a further carrier, one parcel per order, in its own words."""
        o = self.raw("orders")
        words = ("Collected", "Departed", "With Courier", "Proof of Delivery", "Customs", None)
        return o.select(
            F.concat(F.lit("PO-"), F.col("o_orderkey")).alias("tracking_no"),
            F.lit("Post ").alias("carrier"),
            F.col("o_orderdate").alias("shipped_at"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + hours(F.lit(60))).alias("delivered_at"),
            pick(words, F.col("o_orderkey")).alias("status"),
            F.concat(F.lit("Depot"), F.col("o_custkey") % 5).alias("last_location"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("date_ts"),
        )

    def shipment_orders(self) -> DataFrame:
        """One shipment per order, before its scans are known."""
        o, key = self.raw("orders"), F.col("o_orderkey")
        return o.select(
            F.concat(F.lit("SH-"), key).alias("shipment_id"),
            F.concat(F.lit("INV-"), key).alias("invoice_no"),
            F.col("o_custkey").alias("customer_sk"),
            (key % 10).alias("warehouse_sk"),
            pick(CARRIERS, F.col("o_custkey")).alias("carrier"),
            F.concat(F.lit("T-"), key).alias("tracking_no"),
            F.col("o_orderdate").alias("shipped_ts"),
            F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + hours(F.lit(48))).alias("delivered_ts"),
            F.lit(36).cast("bigint").alias("sla_hours"),
        )

    def invoice_documents(self) -> DataFrame:
        """Nested supplier invoices: an article line and a freight line each."""
        quantity = F.col("l_quantity").cast("bigint")
        line = lambda sku, qty, price: F.struct(
            sku.alias("sku"), qty.alias("qty"), price.cast("decimal(10,2)").alias("unit_price")
        )
        article = line(F.concat(F.lit("P-"), F.col("l_partkey")), quantity, F.col("l_partkey") % 90 + 1)
        freight = line(F.lit("FREIGHT"), F.lit(1).cast("bigint"), F.col("l_linenumber") * 3)
        return self.raw("lineitem").select(
            F.concat_ws("-", F.lit("SI"), "l_orderkey", "l_partkey").alias("invoice_no"),
            F.col("l_suppkey").alias("supplier_sk"),
            F.lit("EUR").alias("currency"),
            F.col("l_shipdate").alias("received_ts"),
            F.array(article, freight).alias("line_items"),
        )

    def tracking_scans(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(
            F.concat(F.lit("SH-"), F.col("l_orderkey")).alias("shipment_id"),
            (F.col("l_shipdate") + hours(F.col("l_linenumber"))).alias("ts"),
            pick(("PICKED_UP", "IN_TRANSIT", "DELIVERED"), F.col("l_linenumber")).alias("status"),
            F.concat(F.lit("D"), F.col("l_partkey")).alias("location"),
        )

    def attributed_sales(self) -> DataFrame:
        """Orders with the channel and campaign they are credited to, and their cost."""
        o, c, n = self.raw("orders"), self.raw("customer"), self.raw("nation")
        return (
            o.join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .select(
                F.to_date(F.trunc("o_orderdate", "month")).alias("period_date"),
                pick(CHANNELS, F.col("o_orderkey")).alias("channel"),
                (F.col("o_custkey") % 4).alias("campaign_sk"),
                F.concat(F.lit("R"), F.col("n_regionkey")).alias("region"),
                money("o_totalprice", 14).alias("revenue"),
                (F.col("o_orderkey") % 9).alias("units"),
                (F.col("o_orderkey") % 1000 * 100).cast("decimal(14,2)").alias("cost"),
            )
        )

    def customer_addresses(self) -> DataFrame:
        """Address states of a customer, one per order, many of them unchanged."""
        o = self.raw("orders")
        return o.select(
            F.col("o_custkey").alias("customer_sk"),
            F.col("o_orderkey").alias("order_no"),
            F.concat(F.lit("Street "), F.col("o_orderkey") % 2).alias("address_line1"),
            F.col("o_orderstatus").alias("address_city"),
            F.concat(F.lit("R"), F.col("o_custkey") % 7).alias("address_region"),
            F.lit("US").alias("address_country"),
            F.concat(F.lit("Z"), F.col("o_orderkey") % 3).alias("address_postal"),
            F.timestamp_add("SECOND", (F.col("o_orderkey") % 86400).cast("int"), F.col("o_orderdate")).alias("changed_ts"),
        )

    def supplier_terms_changes(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("changed_on")).agg(
            F.min("l_linenumber").alias("n")
        ).select(
            F.col("l_suppkey").alias("supplier_sk"),
            (F.col("n") * 15).cast("bigint").alias("payment_terms_days"),
            (F.col("n") % 3).cast("decimal(5,2)").alias("discount_pct"),
            F.concat(F.lit("buyer"), F.dayofmonth("changed_on")).alias("changed_by"),
            F.col("changed_on"),
        )

    def employee_states(self) -> DataFrame:
        """What the staff file of a day says; a customer's orders of the day stand for it."""
        o = self.raw("orders")
        daily = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("changed_on")).agg(
            F.min("o_orderkey").alias("n"), F.min("o_orderpriority").alias("role"), F.min("o_orderstatus").alias("status")
        )
        return daily.select(
            F.col("o_custkey").alias("employee_sk"),
            "role",
            F.col("status").alias("department"),
            (F.col("n") % 2).cast("bigint").alias("home_store_sk"),
            F.concat(F.lit("B"), F.col("n") % 2).alias("salary_band"),
            "changed_on",
        )

    def store_states(self) -> DataFrame:
        """What the store file of a day says; a supplier's sale lines of the day stand for it."""
        li = self.raw("lineitem")
        return li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("changed_on")).agg(
            F.min("l_returnflag").alias("store_type"),
            F.min("l_linenumber").cast("bigint").alias("manager_employee_sk"),
            (F.max("l_linenumber") * 100).cast("bigint").alias("sq_ft"),
        ).withColumnRenamed("l_suppkey", "store_sk")

    def customer_signups(self) -> DataFrame:
        """Sign-up records, one per order, with untidy contact data."""
        o, c = self.raw("orders"), self.raw("customer")
        return o.join(c, o.o_custkey == c.c_custkey).select(
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.concat(F.lit(" Mail"), F.col("o_orderkey"), F.lit("@Example.COM ")).alias("email"),
            F.concat(F.lit("+49 (0) "), F.col("o_custkey"), F.lit("-"), F.col("o_orderkey")).alias("phone"),
            F.col("c_name").alias("first_name"),
            F.lit(" Doe ").alias("last_name"),
            F.concat(F.lit("Street "), F.col("o_orderkey") % 100).alias("addr_line1"),
            F.concat(F.lit("City"), F.col("o_custkey") % 40).alias("addr_city"),
            F.lit("R").alias("addr_region"),
            F.lit("DE").alias("addr_country"),
            (F.col("o_custkey") % 40 + 10000).cast("string").alias("addr_postal"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("signup_date"),
        )

    def dim_geography(self) -> DataFrame:
        """Postal areas, one per nation."""
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            key.cast("bigint").alias("geo_sk"),
            F.lit("de").alias("country_iso2"),
            F.concat(F.lit("CITY"), key).alias("city"),
            (key + 10000).cast("string").alias("postal_code"),
            (key / 2.0).alias("latitude"),
            (key * 2.0).alias("longitude"),
        )

    def product_catalog_feed(self) -> DataFrame:
        """Two deliveries of every product; the later one is discontinued for some."""
        p = self.raw("part")
        feed = F.explode(F.array(F.lit("20240101"), F.lit("20240201"))).alias("feed_date")
        later = F.col("feed_date") == "20240201"
        return p.select("*", feed).select(
            F.concat(F.lit("P-"), F.col("p_partkey")).alias("sku"),
            (F.col("p_partkey") * 7).cast("string").alias("upc"),
            F.concat(F.lit(" "), F.initcap("p_name")).alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            F.upper(F.substring_index("p_name", " ", 1)).alias("color"),
            F.col("p_size").cast("string").alias("size"),
            money("p_retailprice", 10).alias("msrp"),
            (F.col("p_partkey") % 500).cast("decimal(10,2)").alias("cost"),
            (F.col("p_partkey") % 10).cast("string").alias("supplier_id"),
            F.when(later & (F.col("p_partkey") % 4 == 0), F.lit("2024-01-15").cast("date"))
            .when(F.col("p_partkey") % 4 == 1, F.lit("2025-01-01").cast("date")).alias("discontinued_at"),
            "feed_date",
        )

    # -- facts of the event table

    def mobile_events(self) -> DataFrame:
        e = self.raw("events").filter(~F.col("event_type").eqNullSafe("purchase"))
        return e.select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("ts").alias("event_ts"),
            F.struct(
                F.concat_ws(".", (F.col("event_id") % 256), F.lit(1), F.lit(2), F.lit(3)).alias("ip"),
                F.lit("US").alias("country"),
                F.col("user_id").cast("string").alias("session_id"),
                F.concat(F.lit("https://ref/"), F.col("event_type")).alias("referrer"),
            ).alias("context"),
        )

    def purchases(self) -> DataFrame:
        e = self.raw("events").filter(F.col("event_type") == "purchase")
        return e.select(
            F.concat(F.lit("EV-"), F.col("event_id")).alias("invoice_no"),
            F.col("user_id").alias("customer_sk"),
            F.col("ts").alias("invoice_ts"),
            money("value", 14).alias("line_total"),
        )

    def fact_loyalty_events(self) -> DataFrame:
        e = self.raw("events")
        kind = F.when(F.col("event_type") == "click", "REDEEM").otherwise("EARN")
        return e.select(
            F.col("event_id"),
            F.concat(F.lit("M"), F.col("user_id")).alias("member_id"),
            kind.alias("event_type"),
            F.floor("value").cast("bigint").alias("points"),
            (F.col("event_id") % 10).alias("store_sk"),
            F.concat(F.lit("TX"), F.col("event_id")).alias("tx_id"),
            F.col("ts").alias("event_ts"),
            F.to_date("ts").alias("event_date"),
        )

    def loyalty_lines(self) -> DataFrame:
        """The loyalty feed as text lines."""
        e = self.raw("events")
        stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
        return e.select(
            F.concat(
                F.concat_ws("|", stamp, F.concat(F.lit("MBR"), F.col("user_id")),
                            F.when(F.col("event_type") == "click", "REDEEM").otherwise("EARN"),
                            F.floor("value"), F.concat(F.lit("STORE"), F.col("event_id") % 10)),
                F.lit("|TX:TXN"), F.col("event_id"), F.lit(";META:channel="), F.col("event_type"),
                F.lit(";tier=gold"),
            ).alias("value")
        )

    def fraud_signals(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            F.col("user_id").cast("string").alias("customer_id"),
            F.col("event_type").alias("signal_type"),
            (F.col("event_id") % 1000 / 1000.0).alias("score"),
            F.date_format("ts", "yyyyMMdd").alias("signal_date"),
            F.col("ts").alias("signal_ts"),
        )

    def online_transactions(self) -> DataFrame:
        """Till transactions of the web shop, one per purchase event; some are made by guests."""
        e = self.raw("events").filter(F.col("event_type") == "purchase")
        return e.select(
            F.col("event_id").alias("txn_id"),
            F.when(F.col("event_id") % 11 > 0, F.col("user_id").cast("string")).alias("customer_id"),
            F.col("ts").alias("txn_ts"),
            money("value", 14).alias("gross_amount"),
            F.to_date("ts").alias("partition_date"),
        )

    def omniture_logs(self) -> DataFrame:
        """The positional web log: sixty string columns, eight of them filled."""
        e = self.raw("events")
        filled = {
            1: F.col("event_id").cast("string"),
            2: F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            8: F.concat_ws(".", F.col("event_id") % 256, F.lit(0), F.lit(0), F.lit(1)),
            13: F.concat(F.lit("/page/"), F.col("event_type")),
            14: F.col("user_id").cast("string"),
            50: F.concat(F.lit("City"), F.col("user_id") % 9),
            51: pick(SALE_COUNTRIES, F.col("user_id")),
            53: F.concat(F.lit("S"), F.col("user_id") % 5),
        }
        blank = F.lit(None).cast("string")
        columns = [filled.get(i, blank).alias(f"col_{i}") for i in range(1, 61)]
        return e.select(*columns, F.date_format("ts", "yyyyMMdd_HH").alias("date_ts"))

    def clicks(self) -> DataFrame:
        """Page clicks; the time is cut to the hour so that repeats occur."""
        e = self.raw("events")
        return e.select(
            F.col("user_id").cast("string").alias("session_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.date_trunc("hour", "ts").alias("event_ts"),
            F.concat(F.lit("/p/"), F.col("event_type")).alias("page_url"),
            F.col("event_id").cast("string").alias("ip"),
            pick(SALE_COUNTRIES, F.col("user_id")).alias("country"),
            F.lit("phone").alias("device_type"),
            F.lit("https://ref/").alias("referrer_url"),
        )

    def app_clicks(self) -> DataFrame:
        e = self.raw("events")
        number = F.col("event_id")
        device = F.struct(
            pick(PLATFORMS, F.col("user_id")).alias("platform"),
            F.concat(F.lit("v"), F.col("user_id") % 3).alias("version"),
            F.concat(F.lit("M"), F.col("user_id") % 7).alias("model"),
        )
        return e.select(
            number,
            F.col("user_id").alias("user_sk"),
            F.col("ts").alias("event_ts"),
            "event_type",
            F.concat(F.lit("screen-"), F.col("event_type")).alias("screen"),
            F.when(F.col("event_type") != "view", F.concat(F.lit("item-"), number % 50)).alias("target_id"),
            F.col("props").alias("properties"),
            device.alias("device"),
            pick(("US", "DE", "JP"), F.col("user_id")).alias("geo_country"),
            F.floor("value").cast("bigint").alias("amount"),
        )

    def returns_cdc(self) -> DataFrame:
        """Change feed; about three changes per return."""
        e = self.raw("events")
        op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U")
        return e.select(
            F.floor(F.col("event_id") / 3).alias("return_id"),
            F.concat(F.lit("INV-"), F.floor(F.col("event_id") / 3)).alias("invoice_no"),
            F.col("user_id").alias("customer_sk"),
            F.col("ts").alias("return_ts"),
            money("value").alias("refund_amount"),
            pick(REASONS, F.col("user_id")).alias("reason_code"),
            F.col("event_type").alias("status"),
            op.alias("op"),
            F.to_date("ts").alias("snapshot_date"),
        )

    def events_eu(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            F.col("event_id").cast("string").alias("event_id"), F.col("ts").alias("event_ts"),
            F.col("user_id").cast("string").alias("user_id"), "event_type", F.col("props").alias("payload_json"),
        )

    def email_events(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            F.concat(F.lit("SEND-"), F.col("user_id")).alias("send_id"),
            (F.col("user_id") % 7).alias("campaign_sk"),
            F.col("user_id").alias("user_sk"),
            F.col("event_type"),
            F.col("ts").alias("event_ts"),
            F.concat(F.lit("/l/"), F.col("event_id")).alias("link_url"),
        )
