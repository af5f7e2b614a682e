"""Queries over tables by name, published layers, touched months, hot join keys and audits at write time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import locate, observe, skew
from ..sources import adapters as A
from ..sources import files as io
from ..sources.tables import Tables
from ..sources.warehouse import CatalogTables, publish, read_published
from ..streaming.by_name import read_ingested
from ..streaming.ingest import ingest_stream
from . import facts, marts
from .quality import NEGATIVE_CHECKS, layer_pairs, raw_tables
from .refresh import refresh_gold, refresh_months, refresh_silver, table_row_counts, together, touched_months
from .registry import AS_OF, query
from .silver import CLEANERS

# Tables that meet on the order, in buckets of it.
BY_ORDER = {"orders": ["order_id"], "order_details": ["order_id"]}


# --------------------------------------------------------------- tables by name

def catalog_sources(spark, sf_dir) -> CatalogTables:
    """The ten source tables saved in the catalog, orders and their lines in buckets of the order."""
    t = Tables(spark, sf_dir)
    tables = CatalogTables(spark)
    tables.save_all({name: A.source(t, name) for name in A.SOURCES}, BY_ORDER)
    return tables


@query("catalog_tables")
def q_catalog_tables(spark, sf_dir):
    """Rows of every table, read by name."""
    tables = catalog_sources(spark, sf_dir)
    out = None
    for name in tables.names():
        rows = tables[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("catalog_fct_orders")
def q_catalog_fct_orders(spark, sf_dir):
    """Line summary and order join over bucketed tables: neither shuffles."""
    tables = catalog_sources(spark, sf_dir)
    return facts.fct_orders(tables["orders"], tables["order_details"])


@query("catalog_fct_order_items")
def q_catalog_fct_order_items(spark, sf_dir):
    """Lines joined to their orders bucket by bucket, then to the menu."""
    tables = catalog_sources(spark, sf_dir)
    return facts.fct_order_items(tables["order_details"], tables["orders"], tables["menu_items"])


@query("catalog_revenue_monthly")
def q_catalog_revenue_monthly(spark, sf_dir):
    """Monthly revenue from facts that were saved in buckets of the order: margins join without a shuffle."""
    tables = catalog_sources(spark, sf_dir)
    tables.save("fct_orders", facts.fct_orders(tables["orders"], tables["order_details"]), bucket_by=["order_id"])
    tables.save("fct_order_items", facts.fct_order_items(tables["order_details"], tables["orders"], tables["menu_items"]), bucket_by=["order_id"])
    return marts.agg_revenue_monthly(tables["fct_orders"], tables["fct_order_items"])


@query("silver_refresh")
def q_silver_refresh(spark, sf_dir):
    """All ten silver tables cleaned and written; rows per written table."""
    return table_row_counts(refresh_silver(raw_tables(Tables(spark, sf_dir)), io.scratch_path(spark, "silver")))


# ------------------------------------------------------------- published versions

@query("published_gold")
def q_published_gold(spark, sf_dir):
    """Item performance of the current version: gold published, a second refresh that fails halfway, then read."""
    t = Tables(spark, sf_dir)
    silver = {name: A.source(t, name) for name in A.SOURCES}
    root = io.scratch_path(spark, "published")
    publish(spark, root, lambda path: refresh_gold(silver, path, AS_OF, by_month=A.BY_MONTH))

    def fails(path):
        io.materialize(silver["menu_items"].limit(0), f"{path}/agg_item_performance")
        raise ValueError("refresh failed")

    try:
        publish(spark, root, fails)
    except ValueError:
        pass
    return read_published(spark, root, "agg_item_performance")


# ------------------------------------------------------------------ touched months

def late_order(key: str) -> str:
    """Which orders arrive in the second batch: some of the last three years."""
    return f"({key} % 7 = 0 AND order_date >= DATE'1996-01-01')"


def _two_batches(spark, sf_dir):
    """Orders and lines ingested as two batches of CSV files: (bronze tables by name, folder of each, menu)."""
    t = Tables(spark, sf_dir)
    orders, details = A.orders(t), A.order_details(t)
    base = io.scratch_path(spark, "months")
    late = orders.where(late_order("order_id")).selectExpr("order_id", "true AS _late").distinct()
    # the lines meet their orders once, for both batches
    marked = io.materialize(details.join(late, "order_id", "left").select(*details.columns, "_late"), f"{base}/lines")
    split = {"orders": (orders.where(f"NOT coalesce({late_order('order_id')}, false)"), orders.where(late_order("order_id"))),
             "order_details": (marked.where("_late IS NULL").drop("_late"), marked.where("_late").drop("_late"))}
    schemas = {"orders": orders.schema, "order_details": details.schema}

    def take(batch: int) -> dict:
        out = {}
        for name, parts in split.items():
            io.write_csv(parts[batch], f"{base}/landing/{name}", mode="append", compression="gzip")
            out[name] = ingest_stream(spark, f"{base}/landing/{name}", schemas[name], f"{base}/bronze/{name}", f"{base}/checkpoint/{name}",
                                      options={"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}, glob="*.csv.gz")
        return out

    return base, A.menu_items(t), take


def refreshed_by_months(spark, sf_dir) -> dict:
    """Facts and mart after a first full refresh and a second batch that touches some months."""
    base, menu, take = _two_batches(spark, sf_dir)
    target, out = f"{base}/gold", {}
    for batch in (0, 1):
        bronze = take(batch)
        new = {name: read_ingested(spark, f"{base}/bronze/{name}", batch) for name in bronze}
        months = touched_months(new["orders"], new["order_details"], bronze["orders"])
        out = refresh_months(bronze["orders"], bronze["order_details"], menu, months, target)
    return out


@query("refresh_touched_orders")
def q_refresh_touched_orders(spark, sf_dir):
    """fct_orders whose touched months were rebuilt after a second batch; equals a full refresh."""
    return refreshed_by_months(spark, sf_dir)["fct_orders"].drop("order_margin_c", "order_cost_c")


@query("refresh_touched_monthly")
def q_refresh_touched_monthly(spark, sf_dir):
    return refreshed_by_months(spark, sf_dir)["agg_revenue_monthly"]


# --------------------------------------------------------------------- hot join keys

@query("order_items_hot_item")
def q_order_items_hot_item(spark, sf_dir):
    """Lines joined to the menu where one item has a third of all lines: that item alone is split over tasks."""
    t = Tables(spark, sf_dir)
    lines = A.order_details(t).withColumn("item_id", F.expr("CASE WHEN order_id % 3 = 0 THEN 1 ELSE item_id END"))
    menu = A.menu_items(t).select("item_id", "category", "sub_category", "cost_to_make")
    return skew.salted_join(lines, menu, "item_id", ["order_detail_id"])


# ----------------------------------------------------------------- audits at write time

def _observed(spark, sf_dir):
    """Metrics of the ten silver tables, gathered while they were cleaned and written."""
    raw = raw_tables(Tables(spark, sf_dir))
    clean = {name: CLEANERS[name](df) for name, df in raw.items()}
    return observe.write_all_observed(clean, io.scratch_path(spark, "observed"), NEGATIVE_CHECKS)[1]


@query("observed_overview")
def q_observed_overview(spark, sf_dir):
    return observe.overview(_observed(spark, sf_dir))


@query("observed_nulls")
def q_observed_nulls(spark, sf_dir):
    return observe.nulls(_observed(spark, sf_dir))


@query("observed_negatives")
def q_observed_negatives(spark, sf_dir):
    return observe.negatives(_observed(spark, sf_dir))


# ------------------------------------------------------------------ located differences

# What tells the rows of each table apart: its declared key, with more columns that cleaning leaves alone where the key repeats.
LOCATED = A.PRIMARY_KEYS | {"order_details": ["order_detail_id", "item_id"], "delivery_performance": ["delivery_id", "driver_id"],
                            "daily_operations": ["restaurant_id", "date"], "inventory": ["restaurant_id", "item_id", "date"]}


@query("located_differences")
def q_located_differences(spark, sf_dir):
    """Cells that cleaning changed in each of the ten tables, per table, column and kind, from rows of differing buckets alone."""
    def job(name, left, right):
        return lambda: locate.difference_counts(left.drop("_rescued_data"), right, LOCATED[name]).select(
            F.lit(name).alias("table"), "column", "kind", "cells")

    found = together({name: job(name, *pair) for name, pair in layer_pairs(Tables(spark, sf_dir)).items()})
    return reduce(DataFrame.unionByName, found.values())


@query("changed_menu_prices")
def q_changed_menu_prices(spark, sf_dir):
    """Every changed price and cost of the menu: key, column, value before and after."""
    left, right = layer_pairs(Tables(spark, sf_dir))["menu_items"]
    return locate.differences(left, right, A.PRIMARY_KEYS["menu_items"], ["price", "cost_to_make"]).select(
        "item_id", "restaurant_id", "column", "kind", F.col("left_value").cast("double").alias("left_value"),
        F.col("right_value").cast("double").alias("right_value"))


