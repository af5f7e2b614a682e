"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the test tables of ``sf_dir`` through the adapters
(sources.adapters) and runs one operator over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import adapters as A
from ..sources.tables import Tables
from ..functions.numeric import UNIT, half_up_sql, round_units_sql
from . import dims, facts, marts

# fixed "today" so results do not depend on the wall clock
AS_OF = "2001-12-31"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ----------------------------------------------------------- shared builders

def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def fct_orders_of(t: Tables) -> DataFrame:
    return facts.fct_orders(A.orders(t), A.order_details(t))


def fct_orders_priced_of(t: Tables) -> DataFrame:
    """fct_orders whose single per-order pass over the lines also carries margin and cost."""
    details = A.order_details(t)
    summary = facts.order_line_summary(details, A.menu_items(t))
    return facts.fct_orders(A.orders(t), details, summary)


def fct_order_items_of(t: Tables) -> DataFrame:
    return facts.fct_order_items(A.order_details(t), A.orders(t), A.menu_items(t))


def dim_customer_of(t: Tables, direction: str = "as_reference") -> DataFrame:
    return dims.dim_customer(A.customers(t), A.orders(t), AS_OF, direction)


def _customer_base(t: Tables) -> DataFrame:
    base = dims.conformed_customers(A.customers(t))
    summary = dims.customer_order_summary(A.orders(t))
    return dims.customer_recency(base, summary, AS_OF)


# ------------------------------------------------------------ written layers

_WRITTEN: dict[tuple, dict[str, DataFrame]] = {}


def written_layer(t: Tables, layer: str) -> dict[str, DataFrame]:
    """The raw tables that are aggregates, the ten silver or the 22 gold tables of one folder: raw -> silver -> gold, each written and read back.

    Kept by application, folder and its files (paths, sizes and times), so queries
    over a layer read the written tables like a scheduled refresh's consumers do, and
    changed files are refreshed. ``silver_refresh`` and ``gold_refresh`` time the layers.
    """
    from ..sources.files import file_inventory, materialize, scratch_path
    from .refresh import refresh_gold, refresh_silver, together
    files = file_inventory(t.spark, t.sf_dir).agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("path", "size", "modified"))).first()
    key = (t.spark.sparkContext.applicationId, t.sf_dir, layer, tuple(files))
    if key not in _WRITTEN:
        target = scratch_path(t.spark, layer)
        if layer == "raw":
            _WRITTEN[key] = together({name: lambda name=name: materialize(A.raw(t, name), f"{target}/{name}") for name in A.AGGREGATED})
        elif layer == "silver":
            written = written_layer(t, "raw")
            _WRITTEN[key] = refresh_silver({name: A.raw(t, name) for name in A.SOURCES} | written, target, written=tuple(written))
        else:
            _WRITTEN[key] = refresh_gold(written_layer(t, "silver"), target, AS_OF, by_month=A.BY_MONTH)
    return _WRITTEN[key]


# ---------------------------------------------------------------- dimensions

@query("dim_date")
def q_dim_date(spark, sf_dir):
    """Calendar spanning the order dates (the reference uses fixed 2023-2026)."""
    return dims.dim_date_spanning(A.orders(_t(spark, sf_dir)), "order_date")


@query("dim_restaurant")
def q_dim_restaurant(spark, sf_dir):
    return dims.dim_restaurant(A.restaurants(_t(spark, sf_dir)), AS_OF)


@query("customer_order_summary")
def q_customer_order_summary(spark, sf_dir):
    s = dims.customer_order_summary(A.orders(_t(spark, sf_dir)))
    return s.selectExpr(
        "customer_id", "orders_cnt", f"{round_units_sql('spent_u')} AS total_spent",
        f"{half_up_sql('spent_u', f'amount_cnt * {UNIT}', 2)} AS avg_spent",
        "first_order_date", "last_order_date")


@query("customer_recency")
def q_customer_recency(spark, sf_dir):
    return _customer_base(_t(spark, sf_dir)).select(
        "customer_id", "join_date", "last_order_date", "recency_days")


@query("rfm_scores")
def q_rfm_scores(spark, sf_dir):
    scored = dims.rfm_scores(_customer_base(_t(spark, sf_dir)), "customer_id", "as_reference")
    return scored.select("customer_id", "recency_days", "r_score", "f_score", "m_score")


@query("rfm_scores_high_is_best")
def q_rfm_scores_high(spark, sf_dir):
    scored = dims.rfm_scores(_customer_base(_t(spark, sf_dir)), "customer_id", "high_is_best")
    return scored.select("customer_id", "recency_days", "r_score", "f_score", "m_score")


@query("rfm_segments")
def q_rfm_segments(spark, sf_dir):
    scored = dims.rfm_scores(_customer_base(_t(spark, sf_dir)), "customer_id", "as_reference")
    return scored.select("customer_id", dims.rfm_segment().alias("rfm_segment"))


@query("customer_ltv")
def q_customer_ltv(spark, sf_dir):
    return dims.customer_ltv_columns(_customer_base(_t(spark, sf_dir))).select(
        "customer_id", "total_orders", "total_spent", "avg_order_value_actual",
        "customer_lifetime_value")


@query("dim_customer")
def q_dim_customer(spark, sf_dir):
    return dim_customer_of(_t(spark, sf_dir))


@query("dim_menu_item")
def q_dim_menu_item(spark, sf_dir):
    return dims.dim_menu_item(A.menu_items(_t(spark, sf_dir)))


@query("dim_employee")
def q_dim_employee(spark, sf_dir):
    return dims.dim_employee(A.employees(_t(spark, sf_dir)), AS_OF)


# --------------------------------------------------------------------- facts

@query("fct_orders")
def q_fct_orders(spark, sf_dir):
    return fct_orders_of(_t(spark, sf_dir))


@query("fct_order_items")
def q_fct_order_items(spark, sf_dir):
    return fct_order_items_of(_t(spark, sf_dir))


@query("fct_delivery")
def q_fct_delivery(spark, sf_dir):
    return facts.fct_delivery(A.delivery_performance(_t(spark, sf_dir)))


@query("fct_inventory_daily")
def q_fct_inventory_daily(spark, sf_dir):
    return facts.fct_inventory_daily(A.inventory(_t(spark, sf_dir)))


@query("fct_daily_ops")
def q_fct_daily_ops(spark, sf_dir):
    return facts.fct_daily_ops(A.daily_operations(_t(spark, sf_dir)))


# --------------------------------------------------------------------- marts

@query("agg_revenue_monthly")
def q_agg_revenue_monthly(spark, sf_dir):
    return marts.agg_revenue_monthly(fct_orders_priced_of(_t(spark, sf_dir)))


@query("agg_revenue_by_category")
def q_agg_revenue_by_category(spark, sf_dir):
    return marts.agg_revenue_by_category(fct_order_items_of(_t(spark, sf_dir)))


@query("agg_restaurant_performance")
def q_agg_restaurant_performance(spark, sf_dir):
    return marts.agg_restaurant_performance(fct_orders_priced_of(_t(spark, sf_dir)))


@query("two_level_margin")
def q_two_level_margin(spark, sf_dir):
    return marts.two_level_margin(fct_order_items_of(_t(spark, sf_dir)))


@query("agg_hourly_demand")
def q_agg_hourly_demand(spark, sf_dir):
    return marts.agg_hourly_demand(fct_orders_of(_t(spark, sf_dir)))


@query("hourly_activity_events")
def q_hourly_activity_events(spark, sf_dir):
    return marts.hourly_activity(_t(spark, sf_dir).events)


@query("agg_customer_cohorts")
def q_agg_customer_cohorts(spark, sf_dir):
    t = _t(spark, sf_dir)
    return marts.agg_customer_cohorts(dims.conformed_customers(A.customers(t)), fct_orders_of(t))


@query("agg_customer_lifetime")
def q_agg_customer_lifetime(spark, sf_dir):
    return marts.agg_customer_lifetime(dim_customer_of(_t(spark, sf_dir)))


@query("agg_item_performance")
def q_agg_item_performance(spark, sf_dir):
    return marts.agg_item_performance(fct_order_items_of(_t(spark, sf_dir)))


@query("agg_menu_engineering")
def q_agg_menu_engineering(spark, sf_dir):
    t = _t(spark, sf_dir)
    return marts.agg_menu_engineering(marts.agg_item_performance(fct_order_items_of(t)), dims.dim_menu_item(A.menu_items(t)))


@query("agg_menu_engineering_approx")
def q_agg_menu_engineering_approx(spark, sf_dir):
    """Medians by percentile_approx, as the reference computes them (no exact oracle)."""
    t = _t(spark, sf_dir)
    return marts.agg_menu_engineering(marts.agg_item_performance(fct_order_items_of(t)), dims.dim_menu_item(A.menu_items(t)),
                                      exact=False)


@query("agg_ops_costs")
def q_agg_ops_costs(spark, sf_dir):
    return marts.agg_ops_costs(facts.fct_daily_ops(A.daily_operations(_t(spark, sf_dir))))


@query("agg_staffing_efficiency")
def q_agg_staffing_efficiency(spark, sf_dir):
    return marts.agg_staffing_efficiency(dims.dim_employee(A.employees(_t(spark, sf_dir)), AS_OF))


@query("agg_delivery_by_condition")
def q_agg_delivery_by_condition(spark, sf_dir):
    return marts.agg_delivery_by_condition(facts.fct_delivery(A.delivery_performance(_t(spark, sf_dir))))


@query("agg_driver_performance")
def q_agg_driver_performance(spark, sf_dir):
    return marts.agg_driver_performance(facts.fct_delivery(A.delivery_performance(_t(spark, sf_dir))))


# -------------------------------------------------------------------- silver

from . import silver  # noqa: E402
from ..operators import clean as C  # noqa: E402


@query("cap_outliers_iqr")
def q_cap_outliers_iqr(spark, sf_dir):
    return C.cap_outliers(_t(spark, sf_dir).events, ["value"])


@query("cap_outliers_multi")
def q_cap_outliers_multi(spark, sf_dir):
    return C.cap_outliers(_t(spark, sf_dir).events, ["value", "user_id"])


@query("cap_outliers_approx")
def q_cap_outliers_approx(spark, sf_dir):
    """The reference's estimator: percentile_approx quartiles (no exact oracle)."""
    return C.cap_outliers(_t(spark, sf_dir).events, ["value", "user_id"], exact=False)


@query("dedup_by_key")
def q_dedup_by_key(spark, sf_dir):
    return C.dedup_by_key(_t(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


def _clean_query(table: str):
    def run(spark, sf_dir):
        return silver.CLEANERS[table](A.raw(_t(spark, sf_dir), table))
    return run


CLEAN_QUERY_NAMES = {
    "restaurants": "clean_restaurants", "customers": "clean_customers",
    "employees": "clean_employees", "menu_items": "clean_menu_items", "orders": "clean_orders",
    "order_details": "clean_order_details", "customer_reviews": "clean_reviews",
    "daily_operations": "clean_daily_ops", "delivery_performance": "clean_delivery",
    "inventory": "clean_inventory",
}

for _table, _name in CLEAN_QUERY_NAMES.items():
    QUERIES[_name] = _clean_query(_table)


# ------------------------------------------------------ gold over silver, as written

from .refresh import GOLD_TABLES  # noqa: E402


def _gold_query(name: str):
    def run(spark, sf_dir):
        df = written_layer(_t(spark, sf_dir), "gold")[name]
        return df.drop("order_margin_c", "order_cost_c")
    return run


for _table in GOLD_TABLES:
    QUERIES[f"gold_{_table}"] = _gold_query(_table)


@query("restaurant_performance_joined")
def q_restaurant_performance_joined(spark, sf_dir):
    """Restaurant KPIs joined with the two-level margin (the margin isn't on the orders here)."""
    t = _t(spark, sf_dir)
    return marts.agg_restaurant_performance(fct_orders_of(t), fct_order_items_of(t))
