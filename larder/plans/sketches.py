"""Queries over mergeable sketches and bitmaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import year_month_sql
from ..operators import audit as Q
from ..operators import sketch
from ..sources import adapters as A
from ..sources import files as io
from ..sources.tables import Tables
from .quality import CATEGORICAL_CHECKS, layer_pairs, raw_tables
from .registry import fct_orders_of, query

# numeric measures audited by month
MONTHLY_MEASURES = {"orders": ("order_date", ["total_amount", "delivery_distance_miles", "delivery_time_mins", "customer_rating"]),
                    "inventory": ("date", ["opening_stock", "closing_stock", "stock_value", "waste_value"])}


def monthly_sketches(spark, sf_dir, name: str, path: str):
    """Sketches of a raw table's measures, stored by month in two audits: the second reads only the months after 1995."""
    date, columns = MONTHLY_MEASURES[name]
    raw = A.raw(Tables(spark, sf_dir), name).withColumn("year_month", F.expr(year_month_sql(f"to_date({date})")))
    table = io.materialize(raw.select("year_month", *columns), f"{path}/{name}", ["year_month"])
    sketch.update_sketches(table.where("year_month < '1996-01'"), columns, "year_month", f"{path}/{name}_sketches")
    return table, sketch.update_sketches(table, columns, "year_month", f"{path}/{name}_sketches")


@query("outliers_sketched")
def q_outliers_sketched(spark, sf_dir):
    """IQR outlier report of monthly sketches (approximate: ranks within KLL_RANK_ERROR)."""
    base, out = io.scratch_path(spark, "sketches"), None
    for name in MONTHLY_MEASURES:
        found = sketch.outliers_from_sketches(monthly_sketches(spark, sf_dir, name, base)[1]).select(F.lit(name).alias("table"), "*")
        out = found if out is None else out.unionByName(found)
    return out


@query("outliers_sketched_error")
def q_outliers_sketched_error(spark, sf_dir):
    """Per measure: rows, and whether the sketched quartiles and the outliers estimated for their bounds are within the stated errors of counts."""
    base, out = io.scratch_path(spark, "sketches"), None
    for name, (_, columns) in MONTHLY_MEASURES.items():
        table, stored = monthly_sketches(spark, sf_dir, name, base)
        found = F.broadcast(sketch.outliers_from_sketches(stored, min_distinct=0, max_distinct_share=2.0))  # one row per column
        values = Q._stack_values(table, columns, "double").where("value IS NOT NULL").join(found, "column")
        counts = values.groupBy("column", "rows", "outlier_estimate", "outlier_error").agg(
            *[F.expr(f"{agg} AS {n}") for n, agg in {
                "n": "count(1)", "b1": "count_if(value < q1)", "u1": "count_if(value <= q1)", "b3": "count_if(value < q3)", "u3": "count_if(value <= q3)",
                "o": "count_if(value < lower_bound OR value > upper_bound)"}.items()])
        off = lambda b, u, p: f"(greatest({b} - {p} * n, {p} * n - {u}, 0) <= {sketch.KLL_RANK_ERROR} * n + 1)"
        rows = counts.selectExpr(f"'{name}' AS table", "column", "rows", f"{off('b1', 'u1', '0.25D')} AND {off('b3', 'u3', '0.75D')} AS quartiles_within",
                                 "abs(o - outlier_estimate) <= outlier_error AS outliers_within")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("reconcile_distinct_sketched")
def q_reconcile_distinct_sketched(spark, sf_dir):
    """Distinct values of raw and silver columns by sketches, and whether either side has values that the other lacks (approximate)."""
    out = None
    for name, (left, right) in layer_pairs(Tables(spark, sf_dir)).items():
        shared = [c for c in left.columns if c in set(right.columns)]
        found = sketch.reconcile_estimates(left, right, shared).select(F.lit(name).alias("table"), "*")
        out = found if out is None else out.unionByName(found)
    return out


@query("casing_sketched")
def q_casing_sketched(spark, sf_dir):
    """Columns with values that differ in case alone, by sketches (exact while a column has few values)."""
    out = None
    for name, df in raw_tables(Tables(spark, sf_dir)).items():
        columns = [c for c in CATEGORICAL_CHECKS.get(name, []) if c in df.columns]
        if columns:
            found = sketch.casing_estimates(df, columns).selectExpr(f"'{name}' AS table", "column", "inconsistent")
            out = found if out is None else out.unionByName(found)
    return out


# wide columns with some frequent values
FREQUENT = {"orders": ["o_custkey", "o_orderpriority", "o_orderstatus"], "lineitem": ["l_partkey", "l_quantity", "l_returnflag"],
            "events": ["user_id", "event_type"], "documents": ["source", "lang"]}


@query("frequent_values")
def q_frequent_values(spark, sf_dir):
    """Values that hold a hundredth or more of their column, whatever the number of its distinct values."""
    t, out = Tables(spark, sf_dir), None
    for name, columns in FREQUENT.items():
        found = sketch.frequent_values(t[name], columns).selectExpr(f"'{name}' AS table", "column", "value", "count")
        out = found if out is None else out.unionByName(found)
    return out


def customer_bitmaps(fct):
    """Completed orders' customers by day and hour, one pass over the fact."""
    rows = fct.where("is_completed").select("order_date", "year_month", "restaurant_id", "day_of_week", "hour_of_day", "customer_id")
    return sketch.id_bitmaps(rows, ["order_date", "year_month", "restaurant_id", "day_of_week", "hour_of_day"], "customer_id")


@query("distinct_customers_rolled_up")
def q_distinct_customers_rolled_up(spark, sf_dir):
    """Distinct customers by month, restaurant, hour and day from one stored set of daily bitmaps."""
    daily = io.materialize(customer_bitmaps(fct_orders_of(Tables(spark, sf_dir))), io.scratch_path(spark, "bitmaps"))
    levels = {"month": "year_month", "restaurant": "CAST(restaurant_id AS STRING)", "day": "CAST(order_date AS STRING)",
              "hour": "concat_ws('-', day_of_week, hour_of_day)", "all": "'all'"}
    out = None
    for level, value in levels.items():
        rolled = sketch.roll_up_bitmaps(daily, {"value": value})
        found = sketch.count_bitmaps(rolled, ["value"], "customers").select(F.lit(level).alias("level"), "value", "customers")
        out = found if out is None else out.unionByName(found)
    return out
