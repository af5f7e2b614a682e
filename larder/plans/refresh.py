"""Silver and gold refresh: cleaned tables, then dimensions, facts and marts written as tables in dependency order.

Mirrors the reference's materialized-view refresh: each table is written once
and the tables built on it read the written copy, so the order lines are joined
and priced once for all four order marts instead of once per mart, and every
later job starts from files (a lineage cut an executor loss cannot undo).
Facts with a month column are partitioned by it, so month filters prune files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import year_month_sql
from ..sources.files import gathered, materialize
from ..sources.warehouse import deals_evenly, publish, replace_partitions, save_table, within
from . import dims, facts, marts
from .silver import CLEANERS

GOLD_TABLES = (
    "dim_date", "dim_restaurant", "dim_customer", "dim_menu_item", "dim_employee",
    "fct_orders", "fct_order_items", "fct_delivery", "fct_inventory_daily", "fct_daily_ops",
    "agg_revenue_monthly", "agg_revenue_by_category", "agg_restaurant_performance", "agg_hourly_demand",
    "agg_customer_cohorts", "agg_customer_lifetime", "agg_item_performance", "agg_menu_engineering",
    "agg_ops_costs", "agg_staffing_efficiency", "agg_delivery_by_condition", "agg_driver_performance",
)


def together(jobs: Mapping[str, Callable[[], DataFrame]], at_once: int = 4) -> dict[str, DataFrame]:
    """Independent writes submitted side by side, so that a small table's job fills the gaps of a large one's."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: r.result() for name, r in running.items()}


def refresh_silver(raw: Mapping[str, DataFrame], target: str, exact: bool = True, written: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Clean the ten raw tables, write each under ``target``/<name> and return them read back.

    ``written`` names the raw tables that are files already, which can be read more than once.
    """
    def job(name: str) -> Callable[[], DataFrame]:
        clean, how = CLEANERS[name], {} if name == "restaurants" else {"exact": exact}
        if name == "inventory":
            how["written"] = name in written
        return lambda: materialize(clean(raw[name], **how), f"{target.rstrip('/')}/{name}")

    return together({name: job(name) for name in raw})


def refresh_gold(silver: Mapping[str, DataFrame], target: str, as_of: str | None = None,
                 exact: bool = True, by_month: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Write all gold tables under ``target``/<name>; return them read back.

    ``silver`` holds the ten cleaned source tables by name. The dimensions and the
    facts that need no mart are written side by side, then the marts, whose
    margins come from the written order lines. ``by_month`` names the
    silver tables whose rows of a month lie together already, so that they aren't moved to be written by month.
    Lines and item performance are written in buckets of the item, so that the marts of items are
    grouped and joined where the lines lie; not so where some items have so many of the lines
    that a bucket would be far above the others.
    """
    s = silver
    out: dict[str, DataFrame] = {}
    spark, names = s["orders"].sparkSession, f"larder_{uuid.uuid4().hex[:12]}_"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets if deals_evenly(s["order_details"], "item_id", buckets) else None
    by_item = ("fct_order_items", "agg_item_performance")  # tables that stay in buckets of their item, from line to mart

    def put(tables: Mapping[str, Callable[[], DataFrame]], partitioned: Sequence[str] = (), gather: Sequence[str] = (),
            bucketed: Mapping[str, Callable[[], DataFrame]] | None = None) -> None:
        path = lambda name: f"{target.rstrip('/')}/{name}"
        save = lambda name, make: lambda: save_table(make(), names + name, path(name), ["item_id"], buckets, dealt=True)
        write = lambda name, make: lambda: materialize(
            make(), path(name), ["year_month"] if name in partitioned else (), gather=name in gather)
        first = {name: (save if buckets else write)(name, make) for name, make in (bucketed or {}).items()}
        out.update(together(first | {name: write(name, make) for name, make in tables.items()}))

    try:
        _put_gold(s, out, put, buckets, as_of, exact, by_month)
    finally:
        for name in by_item:
            spark.sql(f"DROP TABLE IF EXISTS {names}{name}")  # the name alone: the files stay
    out.update({name: spark.read.parquet(f"{target.rstrip('/')}/{name}") for name in by_item})
    return {name: out[name] for name in GOLD_TABLES}


def _put_gold(s: Mapping[str, DataFrame], out: Mapping[str, DataFrame], put: Callable, buckets: int | None, as_of: str | None,
              exact: bool, by_month: Sequence[str]) -> None:
    """The steps of ``refresh_gold``, whose ``put`` writes tables side by side into ``out``."""
    put({
        "dim_customer": lambda: dims.dim_customer(s["customers"], s["orders"], as_of),
        "dim_date": lambda: dims.dim_date_spanning(s["orders"], "order_date"),
        "dim_restaurant": lambda: dims.dim_restaurant(s["restaurants"], as_of),
        "dim_menu_item": lambda: dims.dim_menu_item(s["menu_items"]),
        "dim_employee": lambda: dims.dim_employee(s["employees"], as_of),
        "fct_delivery": lambda: facts.fct_delivery(s["delivery_performance"]),
        "fct_inventory_daily": lambda: facts.fct_inventory_daily(
            s["inventory"] if "inventory" in by_month else gathered(s["inventory"], year_month_sql("to_date(date)"))),
        "fct_daily_ops": lambda: facts.fct_daily_ops(s["daily_operations"]),
    }, ["fct_inventory_daily", "fct_daily_ops"], ["fct_daily_ops"], {
        "fct_order_items": lambda: facts.fct_order_items(s["order_details"], s["orders"], s["menu_items"], buckets=buckets)})
    put({"fct_orders": lambda: facts.fct_orders_dealt(s["orders"], s["order_details"])}, ["fct_orders"])
    unique = facts.unique_orders(s["orders"])
    put({
        "agg_revenue_monthly": lambda: marts.agg_revenue_monthly(out["fct_orders"], out["fct_order_items"], unique),
        "agg_revenue_by_category": lambda: marts.agg_revenue_by_category(out["fct_order_items"]),
        "agg_restaurant_performance": lambda: marts.agg_restaurant_performance(out["fct_orders"], out["fct_order_items"], written=True),
        "agg_hourly_demand": lambda: marts.agg_hourly_demand(out["fct_orders"]),
        "agg_customer_cohorts": lambda: marts.agg_customer_cohorts(out["dim_customer"], out["fct_orders"]),
        "agg_customer_lifetime": lambda: marts.agg_customer_lifetime(out["dim_customer"]),
        "agg_ops_costs": lambda: marts.agg_ops_costs(out["fct_daily_ops"]),
        "agg_staffing_efficiency": lambda: marts.agg_staffing_efficiency(out["dim_employee"]),
        "agg_delivery_by_condition": lambda: marts.agg_delivery_by_condition(out["fct_delivery"]),
        "agg_driver_performance": lambda: marts.agg_driver_performance(out["fct_delivery"]),
    }, bucketed={"agg_item_performance": lambda: marts.agg_item_performance(out["fct_order_items"])})
    put({"agg_menu_engineering": lambda: marts.agg_menu_engineering(
        out["agg_item_performance"], out["dim_menu_item"], exact=exact, by_item=buckets is not None)})


def publish_gold(silver: Mapping[str, DataFrame], root: str, as_of: str | None = None, exact: bool = True,
                 by_month: Sequence[str] = ()) -> dict[str, DataFrame]:
    """``refresh_gold`` as a new version under ``root``, current once all 22 tables are written; returns its tables."""
    spark = next(iter(silver.values())).sparkSession
    path = publish(spark, root, lambda version: refresh_gold(silver, version, as_of, exact, by_month))
    return {name: spark.read.parquet(f"{path}/{name}") for name in GOLD_TABLES}


def touched_months(new_orders: DataFrame, new_details: DataFrame, orders: DataFrame) -> DataFrame:
    """year_month of every order that is new or has a new line (one row a calendar month).

    ``orders`` are all orders: a late line counts for the month of its order.
    """
    month = F.expr(year_month_sql("to_date(order_date)")).alias("year_month")
    late = orders.join(new_details.select("order_id").distinct(), "order_id", "left_semi")
    return new_orders.select(month).union(late.select(month)).distinct()


def refresh_months(orders: DataFrame, order_details: DataFrame, menu_items: DataFrame, months: DataFrame, target: str) -> dict[str, DataFrame]:
    """Rebuild ``fct_orders`` and ``agg_revenue_monthly`` under ``target`` for ``months`` alone.

    Both tables are partitioned by year_month; only the given months' partitions are
    replaced. Orders, and the lines of those orders, of other months aren't joined or
    written. Where a month's rows are local to it, as here, the result is that of a full refresh.
    """
    month = F.expr(year_month_sql("to_date(order_date)"))
    some = within(orders.withColumn("_month", month), months, "_month").drop("_month")
    lines = order_details.join(some.select("order_id").distinct(), "order_id", "left_semi")
    base = target.rstrip("/")
    fct = facts.fct_orders(some, lines, facts.order_line_summary(lines, menu_items), by_month=True)
    written = replace_partitions(fct, f"{base}/fct_orders", ["year_month"], gather=False)
    mart = marts.agg_revenue_monthly(within(written, months, "year_month"))
    return {"fct_orders": written, "agg_revenue_monthly": replace_partitions(mart, f"{base}/agg_revenue_monthly", ["year_month"])}


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table, rows for a set of (written) tables."""
    frames = [df.agg(F.expr("count(1) AS rows")).selectExpr(f"'{name}' AS table", "rows")
              for name, df in tables.items()]
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f)
    return result
