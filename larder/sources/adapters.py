"""Restaurant-shaped tables derived from the generic test tables.

The operators work on the ten source tables of a restaurant chain
(restaurants, customers, employees, menu_items, orders, order_details,
customer_reviews, daily_operations, delivery_performance, inventory). The test
data is a TPC-H-like star schema, so each source table is derived from it with
plain column expressions (or, for the two daily tables, an aggregate over
lineitem). NULLs and categories are injected by key modulus because the test
tables contain none. Everything stays lazy: Catalyst prunes what a query does
not read.

``dirty(...)`` turns a clean table into a raw ("bronze") one with padded,
lower-cased, NULL and negative values plus a rescue column, for the cleaning
and audit operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Tables


def restaurants(t: Tables) -> DataFrame:
    n, r = t.nation, t.region
    # nation/region have a fixed size (25/5 rows) at every scale factor
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).selectExpr(
        "n_nationkey AS restaurant_id", "n_name AS restaurant_name",
        "concat(n_name, ' High Street') AS address",
        "concat('W', CAST(n_regionkey AS STRING), ' ', CAST(n_nationkey AS STRING)) AS postcode",
        "r_name AS area",
        "date_add(DATE'1990-01-31', n_nationkey * 37) AS opening_date",
        "CASE WHEN n_nationkey % 11 = 10 THEN CAST(NULL AS INT) ELSE n_nationkey * 3 + 40 END AS seating_capacity",
        "n_nationkey % 5 + 1 AS delivery_radius_miles",
        "concat('020', lpad(CAST(n_nationkey AS STRING), 8, '0')) AS phone_number")


def customers(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey AS customer_id",
        "substring_index(c_name, '#', 1) AS first_name", "substring_index(c_name, '#', -1) AS last_name",
        "CASE WHEN c_custkey % 13 = 0 THEN CAST(NULL AS STRING) ELSE concat(c_name, '@X.COM') END AS email",
        "concat('07', lpad(CAST(c_custkey AS STRING), 9, '0')) AS phone",
        "concat('e', CAST(c_nationkey AS STRING), ' 1aa') AS postcode",
        "date_add(DATE'1995-01-01', CAST(c_custkey % 1000 AS INT)) AS join_date",
        "c_mktsegment AS customer_segment", "c_mktsegment AS preferred_category",
        "CASE WHEN c_custkey % 2 = 0 THEN 'delivery' ELSE 'collection' END AS preferred_order_type",
        "c_acctbal AS avg_order_value", "c_acctbal > 0 AS is_active")


def employees(t: Tables) -> DataFrame:
    hire = "date_add(DATE'1995-01-31', CAST((s_suppkey % 140) * 17 AS INT))"
    return t.supplier.selectExpr(
        "s_suppkey AS employee_id", "s_nationkey AS restaurant_id",
        "substring_index(s_name, '#', 1) AS first_name", "substring_index(s_name, '#', -1) AS last_name",
        "CASE s_suppkey % 3 WHEN 0 THEN 'kitchen_staff' WHEN 1 THEN 'delivery_driver' ELSE 'manager' END "
        "AS position",
        f"{hire} AS hire_date",
        f"CASE WHEN s_suppkey % 4 = 0 THEN date_add({hire}, 400) END AS leave_date",
        "CASE WHEN s_suppkey % 4 = 0 THEN 'Left' ELSE 'Active' END AS employment_status",
        "CAST(s_suppkey % 15 + 10 AS DOUBLE) AS salary_per_hour",
        "CAST(s_suppkey % 21 + 20 AS INT) AS hours_per_week",
        "CASE WHEN s_suppkey % 4 = 0 THEN 'Relocation' END AS reason_for_leaving",
        "CASE WHEN s_suppkey % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(s_suppkey % 5 + 1 AS DOUBLE) END "
        "AS performance_rating")


def menu_items(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_partkey AS item_id", "CAST(p_partkey % 10 AS INT) AS restaurant_id", "p_name AS item_name",
        "p_type AS category",
        "CASE WHEN p_partkey % 17 = 0 THEN CAST(NULL AS STRING) ELSE p_brand END AS sub_category",
        "p_retailprice AS price",
        "CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)), 2) AS DOUBLE) "
        "AS cost_to_make",
        "p_size AS preparation_time_mins", "p_size % 2 = 0 AS is_vegetarian", "p_size % 3 = 0 AS is_vegan",
        "p_size % 5 = 0 AS is_gluten_free", "p_size * 10 AS calories")


# TPC-H order status letters -> order status names.
ORDER_STATUS = {"F": "Completed", "O": "Cancelled", "P": "Refunded"}


def orders(t: Tables) -> DataFrame:
    status = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ORDER_STATUS.items())
    return t.orders.selectExpr(
        "o_orderkey AS order_id", "CAST(o_orderkey % 10 AS INT) AS restaurant_id",
        "CASE WHEN o_orderkey % 97 = 0 THEN CAST(NULL AS BIGINT) ELSE o_custkey END AS customer_id",
        "CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS STRING) ELSE concat('cust ', CAST(o_custkey AS STRING)) "
        "END AS customer_name",
        "CAST(o_orderdate AS DATE) AS order_date",
        "timestampadd(HOUR, CAST(o_orderkey % 24 AS INT), o_orderdate) AS order_time",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'Delivery' ELSE 'Eat-in' END AS order_type",
        "o_orderpriority AS payment_method",
        f"CASE o_orderstatus {status} END AS order_status",
        "concat('SW', CAST(o_custkey % 20 AS STRING)) AS delivery_postcode",
        "CAST(o_orderkey % 80 AS DOUBLE) / 10.0D AS delivery_distance_miles",
        "CAST(o_orderkey % 50 + 10 AS INT) AS delivery_time_mins",
        "o_totalprice AS total_amount",
        "CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS INT) ELSE CAST(o_orderkey % 5 + 1 AS INT) END "
        "AS customer_rating")


def order_details(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS order_detail_id", "l_orderkey AS order_id", "l_partkey AS item_id",
        "CAST(l_quantity AS INT) AS quantity", "l_extendedprice AS item_price_at_time",
        "CASE l_partkey % 3 WHEN 1 THEN 'no onions' WHEN 2 THEN 'extra sauce' END AS special_instructions")


def customer_reviews(t: Tables) -> DataFrame:
    d, lab = t.documents, t.labels
    # customer keys run from 1 to the number of customers at every scale
    last = t.customer.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    return d.join(lab.select("doc_id", "quality"), "doc_id", "left").withColumn(
        "customer_id", F.col("doc_id") % last + 1).selectExpr(
        "doc_id AS review_id", "customer_id", "text AS review_text", "lang AS category",
        "CAST(quality AS DOUBLE) AS rating", "CAST(n_chars AS DOUBLE) AS sentiment_score")


_MINUTES = "((l_orderkey * 7 + l_partkey) % 50 + 10)"


def delivery_performance(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS delivery_id", "l_orderkey AS order_id",
        "CAST(l_orderkey % 10 AS INT) AS restaurant_id", "l_suppkey AS driver_id",
        "l_shipdate AS dispatch_time",
        f"timestampadd(MINUTE, CAST({_MINUTES} AS INT), l_shipdate) AS delivery_time",
        "l_quantity / 10.0D AS distance_miles",
        "l_returnflag AS traffic_condition", "l_linestatus AS weather_condition",
        f"CASE WHEN {_MINUTES} <= 30 THEN 'On_Time' WHEN {_MINUTES} <= 50 THEN 'Delayed' ELSE 'Cancelled' END "
        "AS delivery_status")


_MONTH_PARTS = 16  # tasks that a month's stock may be dealt over


def inventory(t: Tables) -> DataFrame:
    """Daily stock per (supplier as restaurant, part as item, ship date): one aggregate over lineitem.

    Nearly every line is a group of its own, so lines are dealt once, by their month and a
    hash of supplier and part, and grouped where they are: what is written by month needs no second shuffle.
    """
    lines = t.lineitem.selectExpr(
        "l_partkey AS item_id", "l_orderkey", "CAST(rint(l_extendedprice * 100.0D) AS BIGINT) AS price_c", "l_suppkey AS restaurant_id",
        "CAST(l_shipdate AS DATE) AS date", "CAST(l_quantity AS INT) AS q", "l_returnflag = 'R' AS waste",
        f"(year(l_shipdate) * 12 + month(l_shipdate)) * {_MONTH_PARTS} + pmod(xxhash64(l_suppkey, l_partkey), {_MONTH_PARTS}) AS _month_part")
    g = lines.repartition("_month_part").groupBy("restaurant_id", "item_id", "date", "_month_part").agg(
        F.expr("min(l_orderkey) AS inventory_id"),
        F.expr("coalesce(sum(CASE WHEN NOT waste THEN q END), 0L) AS used_stock"),
        F.expr("sum(CASE WHEN waste THEN q END) AS waste_stock"),
        F.expr("sum(price_c) / 100.0D AS stock_value"),
        F.expr("sum(CASE WHEN waste THEN price_c END) / 100.0D AS waste_value"),
    )
    return g.selectExpr(
        "inventory_id", "restaurant_id", "date", "item_id", "CAST(100 + item_id % 37 AS INT) AS opening_stock",
        "used_stock + coalesce(waste_stock, 0) AS received_stock", "used_stock", "waste_stock",
        "CAST(100 + item_id % 37 + restaurant_id % 5 AS INT) AS closing_stock", "stock_value", "waste_value")


# Fixed per-order cost rates of the daily operations adapter.
UTILITY_RATES = {
    "electricity_cost": "1.10",
    "water_cost": "0.35",
    "gas_cost": "0.80",
    "maintenance_cost": "2.00",
    "other_bills_cost": "0.15",
}


def daily_operations(t: Tables) -> DataFrame:
    """Per (supplier mod 10 as restaurant, ship date): one aggregate over lineitem."""
    price_c = "CAST(rint(l_extendedprice * 100.0D) AS BIGINT)"
    g = t.lineitem.groupBy(
        F.expr("CAST(l_suppkey % 10 AS INT) AS restaurant_id"), F.expr("CAST(l_shipdate AS DATE) AS date"),
    ).agg(
        F.expr("min(l_orderkey) AS operation_id"),
        F.expr("count_if(l_linestatus = 'F') AS eat_in"),
        F.expr("count_if(l_linestatus = 'O') AS delivery"),
        F.expr("count(1) AS total_orders"),
        F.expr(f"sum({price_c}) / 100.0D AS daily_revenue"),
    )
    return g.selectExpr(
        "operation_id", "restaurant_id", "date",
        "eat_in AS total_customers_eat_in", "delivery AS total_customers_delivery", "total_orders",
        "delivery AS delivery_orders_count", "eat_in AS eat_in_orders_count",
        "total_orders % 20 + 5 AS average_wait_time_mins", "total_orders % 9 + 1 AS staff_on_shift",
        *[f"CAST(total_orders * CAST({rate} AS DECIMAL(4,2)) AS DOUBLE) AS {name}"
          for name, rate in UTILITY_RATES.items()],
        "daily_revenue")


SOURCES = {
    "restaurants": restaurants,
    "customers": customers,
    "employees": employees,
    "menu_items": menu_items,
    "orders": orders,
    "order_details": order_details,
    "customer_reviews": customer_reviews,
    "daily_operations": daily_operations,
    "delivery_performance": delivery_performance,
    "inventory": inventory,
}

# tables whose rows of a month come together
BY_MONTH = ("inventory",)

# tables derived by an aggregate, written once where they are read more than once
AGGREGATED = ("daily_operations", "inventory")

# Fixed values that must equal the reference's: declared keys of the raw tables.
PRIMARY_KEYS = {
    "restaurants": ["restaurant_id"],
    "customers": ["customer_id"],
    "employees": ["employee_id"],
    "menu_items": ["item_id", "restaurant_id"],
    "orders": ["order_id"],
    "order_details": ["order_detail_id"],
    "customer_reviews": ["review_id"],
    "daily_operations": ["operation_id"],
    "delivery_performance": ["delivery_id"],
    "inventory": ["inventory_id"],
}


def source(t: Tables, name: str) -> DataFrame:
    return SOURCES[name](t)


# ---------------------------------------------------------------- dirty data

def dirty(df: DataFrame, key: str, string_cols: Sequence[str] = (),
          numeric_cols: Sequence[str] = (), rescue: bool = True) -> DataFrame:
    """Inject raw-file defects by key modulus (see FIXTURES.md §3.1)."""
    rep = {}
    for i, c in enumerate([*string_cols, *numeric_cols]):
        k = f"({key} + {3 * i})"  # each column's defects fall on other rows
        if c in string_cols:
            rep[c] = (f"CASE WHEN {k} % 23 = 0 THEN CAST(NULL AS STRING) WHEN {k} % 5 = 0 THEN concat('  ', {c}, ' ') "
                      f"WHEN {k} % 7 = 0 THEN lower({c}) ELSE {c} END")
        else:
            rep[c] = f"CASE WHEN {k} % 23 = 0 THEN NULL WHEN {k} % 19 = 0 THEN -{c} ELSE {c} END"
    cols = df.columns
    exprs = [f"{rep[c]} AS {c}" if c in rep else c for c in cols]
    if rescue:
        exprs.append(f"CASE WHEN {key} % 29 = 0 THEN concat('k:', CAST({key} AS STRING)) END AS _rescued_data")
    return df.selectExpr(*exprs)


def raw_customer_id(df: DataFrame, key: str) -> DataFrame:
    """customer_id as a raw CSV read infers it: double, some fractional."""
    return df.selectExpr(*[
        (f"CASE WHEN {key} % 97 = 0 THEN CAST(NULL AS DOUBLE) WHEN {key} % 101 = 0 "
         f"THEN CAST(customer_id AS DOUBLE) + 0.5D ELSE CAST(customer_id AS DOUBLE) END AS customer_id")
        if c == "customer_id" else c for c in df.columns])


# which columns each raw table gets dirt in
DIRT = {
    "restaurants": (["restaurant_name", "address", "postcode", "area", "phone_number"], ["seating_capacity"]),
    "customers": (["first_name", "last_name", "email", "phone", "postcode", "customer_segment",
                   "preferred_category", "preferred_order_type"], ["avg_order_value"]),
    "employees": (["first_name", "last_name", "position", "reason_for_leaving", "employment_status"],
                  ["salary_per_hour", "performance_rating"]),
    "menu_items": (["item_name", "category", "sub_category"],
                   ["preparation_time_mins", "cost_to_make", "price"]),
    "orders": (["customer_name", "delivery_postcode", "order_type", "payment_method", "order_status"],
               ["total_amount", "delivery_time_mins", "delivery_distance_miles"]),
    "order_details": (["special_instructions"], ["item_price_at_time"]),
    "customer_reviews": (["review_text", "category"], ["rating", "sentiment_score"]),
    "daily_operations": ([], ["total_customers_eat_in", "total_customers_delivery", "total_orders",
                              "delivery_orders_count", "eat_in_orders_count", "daily_revenue",
                              "staff_on_shift"]),
    "delivery_performance": (["traffic_condition", "weather_condition", "delivery_status"],
                             ["distance_miles"]),
    "inventory": ([], ["stock_value", "waste_value", "closing_stock", "opening_stock"]),
}


def raw(t: Tables, name: str) -> DataFrame:
    """The raw ("bronze") form of a source table."""
    df = source(t, name)
    key = PRIMARY_KEYS[name][0]
    strings, numbers = DIRT[name]
    if name == "daily_operations":
        # repeated (restaurant_id, date) rows with a changed measure
        extra = df.where("operation_id % 10 = 0").withColumn("daily_revenue", F.expr("daily_revenue + 1.0D"))
        df = df.unionByName(extra)
    out = dirty(df, key, strings, numbers)
    if name in ("orders", "customer_reviews"):
        out = raw_customer_id(out, key)
    return out
