"""Conformed dimensions: date, restaurant, customer (with RFM + CLV), menu item, employee.

Every function maps DataFrames to a DataFrame. ``as_of`` replaces the wall
clock (``current_date()``) so results are reproducible; ``None`` means today.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import (UK_HOLIDAYS, date_key_sql, holiday_sql, months_between_e8_sql,
                                  year_month_sql)
from ..functions.numeric import UNIT, half_up_sql, pct_sql, round_units_sql, units_sql
from ..operators.rank import ntile_columns


# ------------------------------------------------------------------ dim_date

def calendar_columns(df: DataFrame, date_col: str = "date", holidays=UK_HOLIDAYS) -> DataFrame:
    d = date_col
    return df.selectExpr(
        "*",
        f"{date_key_sql(d)} AS date_key",
        f"year({d}) AS year", f"quarter({d}) AS quarter", f"month({d}) AS month",
        f"date_format({d}, 'MMMM') AS month_name", f"date_format({d}, 'MMM') AS month_short",
        f"weekofyear({d}) AS week_of_year", f"dayofmonth({d}) AS day_of_month",
        f"dayofweek({d}) AS day_of_week", f"date_format({d}, 'EEEE') AS day_name",
        f"date_format({d}, 'EEE') AS day_short",
        f"dayofweek({d}) IN (1, 7) AS is_weekend",
        f"{holiday_sql(d, holidays)} AS is_holiday",
        f"{year_month_sql(d)} AS year_month",
        f"concat_ws('-Q', year({d}), quarter({d})) AS year_quarter")


def dim_date(spark: SparkSession, start: str = "2023-01-01", end: str = "2026-12-31",
             holidays=UK_HOLIDAYS) -> DataFrame:
    """Daily calendar between two fixed dates (the reference's 2023-2026)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias("date"))
    return calendar_columns(days, "date", holidays)


def dim_date_spanning(df: DataFrame, date_col: str, holidays=UK_HOLIDAYS) -> DataFrame:
    """Daily calendar covering the dates of ``date_col`` in ``df`` (min..max).

    The span is one aggregate row; the explode produces one row per day of
    the span, bounded by the calendar range rather than by the data volume.
    """
    span = df.agg(F.min(F.col(date_col).cast("date")).alias("_lo"),
                  F.max(F.col(date_col).cast("date")).alias("_hi"))
    days = span.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return calendar_columns(days, "date", holidays)


# ------------------------------------------------------------ dim_restaurant

def _as_of_sql(as_of) -> str:
    return "current_date()" if as_of is None else f"DATE'{as_of}'"


def dim_restaurant(restaurants: DataFrame, as_of: str | None = None) -> DataFrame:
    years = half_up_sql(months_between_e8_sql(_as_of_sql(as_of), "opening_date"), str(12 * 10 ** 8), 1)
    return restaurants.selectExpr(
        "restaurant_id AS restaurant_key", "restaurant_id", "restaurant_name", "address", "postcode",
        "upper(area) AS area", "opening_date", "CAST(seating_capacity AS INT) AS seating_capacity",
        "CAST(delivery_radius_miles AS INT) AS delivery_radius_miles", "phone_number",
        f"{years} AS years_in_operation",
        "CASE WHEN seating_capacity < 60 THEN 'Small' WHEN seating_capacity < 80 THEN 'Medium' "
        "ELSE 'Large' END AS size_band")


# -------------------------------------------------------------- dim_customer

def conformed_customers(customers: DataFrame) -> DataFrame:
    return customers.selectExpr(
        "customer_id AS customer_key", "customer_id", "first_name", "last_name",
        "concat_ws(' ', first_name, last_name) AS full_name", "lower(email) AS email", "phone",
        "upper(postcode) AS postcode", "to_date(join_date) AS join_date",
        "initcap(customer_segment) AS customer_segment", "initcap(preferred_category) AS preferred_category",
        "initcap(preferred_order_type) AS preferred_order_type",
        "CAST(avg_order_value AS DOUBLE) AS avg_order_value", "CAST(is_active AS BOOLEAN) AS is_active")


def customer_order_summary(orders: DataFrame, status: str = "Completed") -> DataFrame:
    """Per customer over orders with ``status``: count, exact spend (units), first/last date."""
    return orders.where(F.col("order_status") == status).groupBy("customer_id").agg(
        F.expr("count(order_id) AS orders_cnt"),
        F.expr(f"sum({units_sql('total_amount')}) AS spent_u"),
        F.expr("count(total_amount) AS amount_cnt"),
        F.expr("max(to_date(order_date)) AS last_order_date"),
        F.expr("min(to_date(order_date)) AS first_order_date"),
    )


def customer_recency(customers: DataFrame, summary: DataFrame, as_of: str | None = None) -> DataFrame:
    """Customers left-joined to their order summary, with recency in days."""
    return customers.join(summary, "customer_id", "left").selectExpr(
        "*", f"datediff({_as_of_sql(as_of)}, coalesce(last_order_date, join_date)) AS recency_days")


RFM_DIRECTIONS = ("as_reference", "high_is_best")


def rfm_scores(df: DataFrame, key: str = "customer_id", direction: str = "as_reference", k: int = 5) -> DataFrame:
    """Add r_score, f_score, m_score as ntile(k) over three global orderings.

    ``as_reference``: tile 1 = most recent / most orders / biggest spend.
    ``high_is_best``: the three orders are reversed, so 5 is best.
    Customers without orders score 1 on all three but keep their slot in the
    tiles (last as_reference, first otherwise). Ties are broken by ``key``, a
    unique long, so the result is deterministic. The tiles' edges are found by
    counting (see operators.rank), without a sort of the customers.
    """
    if direction not in RFM_DIRECTIONS:
        raise ValueError(f"direction must be one of {RFM_DIRECTIONS}")
    sign, empty = ("-", 2**63 - 1) if direction == "as_reference" else ("", -2**63)
    recency = "recency_days" if direction == "as_reference" else "-recency_days"
    measured = df.selectExpr(
        "*", f"CAST(coalesce({recency}, {_long_sql(2**63 - 1)}) AS BIGINT) AS _recency",
        f"CAST(coalesce({sign}orders_cnt, {_long_sql(empty)}) AS BIGINT) AS _orders",
        f"CAST(coalesce({sign}spent_u, {_long_sql(empty)}) AS BIGINT) AS _spent")
    scored = ntile_columns(measured, k, {"_r": "_recency", "_f": "_orders", "_m": "_spent"}, key)
    return scored.selectExpr(
        "* EXCEPT (_recency, _orders, _spent, _r, _f, _m)",
        "CASE WHEN orders_cnt IS NULL THEN 1 ELSE _r END AS r_score",
        "CASE WHEN orders_cnt IS NULL THEN 1 ELSE _f END AS f_score",
        "CASE WHEN spent_u IS NULL THEN 1 ELSE _m END AS m_score")


def _long_sql(value: int) -> str:
    return f"CAST('{value}' AS BIGINT)"


# Fixed values that must equal the reference's: segment rules and names.
RFM_SEGMENT_SQL = (
    "CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champion' "
    "WHEN r_score >= 3 AND f_score >= 4 THEN 'Loyal' "
    "WHEN r_score >= 4 AND f_score <= 2 THEN 'New / Promising' "
    "WHEN r_score <= 2 AND f_score >= 4 THEN 'At Risk' "
    "WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost' "
    "ELSE 'Need Attention' END"
)


def rfm_segment() -> Column:
    """Segment from r/f/m scores; the first matching rule wins."""
    return F.expr(RFM_SEGMENT_SQL)


def customer_ltv_columns(df: DataFrame) -> DataFrame:
    """total_orders, total_spent, avg_order_value_actual, customer_lifetime_value.

    CLV is the mean completed spend times the completed orders. The mean skips
    orders without an amount, the count does not. Without any amount the
    customer's own avg_order_value stands for the mean; a customer without orders
    has 0.0, or NULL when avg_order_value is NULL too.
    """
    clv = (f"CASE WHEN amount_cnt > 0 THEN {half_up_sql('spent_u * orders_cnt', f'amount_cnt * {UNIT}', 2)} "
           f"ELSE {round_units_sql(units_sql('avg_order_value') + ' * coalesce(orders_cnt, 0)')} END")
    return df.selectExpr(
        "*",
        "CAST(coalesce(orders_cnt, 0) AS INT) AS total_orders",
        f"coalesce({round_units_sql('spent_u')}, 0.0D) AS total_spent",
        f"coalesce({half_up_sql('spent_u', f'amount_cnt * {UNIT}', 2)}, 0.0D) AS avg_order_value_actual",
        f"{clv} AS customer_lifetime_value")


def dim_customer(customers: DataFrame, orders: DataFrame, as_of: str | None = None,
                 direction: str = "as_reference") -> DataFrame:
    base = conformed_customers(customers)
    joined = customer_recency(base, customer_order_summary(orders), as_of)
    scored = rfm_scores(joined, "customer_id", direction)
    out = customer_ltv_columns(scored)
    return out.selectExpr(
        "* EXCEPT (orders_cnt, spent_u, amount_cnt)",
        f"{RFM_SEGMENT_SQL} AS rfm_segment",
        "concat_ws('', r_score, f_score, m_score) AS rfm_score")


# ------------------------------------------------------------- dim_menu_item

def dim_menu_item(menu_items: DataFrame) -> DataFrame:
    margin = f"({units_sql('price')} - {units_sql('cost_to_make')})"
    return menu_items.selectExpr(
        "item_id AS item_key", "item_id", "CAST(restaurant_id AS INT) AS restaurant_id",
        "item_name", "category", "sub_category", "CAST(price AS DOUBLE) AS price",
        "CAST(cost_to_make AS DOUBLE) AS cost_to_make",
        "CAST(preparation_time_mins AS INT) AS preparation_time_mins",
        "CAST(is_vegetarian AS BOOLEAN) AS is_vegetarian", "CAST(is_vegan AS BOOLEAN) AS is_vegan",
        "CAST(is_gluten_free AS BOOLEAN) AS is_gluten_free", "CAST(calories AS INT) AS calories",
        f"{round_units_sql(margin)} AS gross_margin_gbp",
        f"{pct_sql(margin, units_sql('price'), 'price')} AS gross_margin_pct",
        "concat_ws(',', CASE WHEN is_vegetarian THEN 'Vegetarian' END, CASE WHEN is_vegan THEN 'Vegan' END, "
        "CASE WHEN is_gluten_free THEN 'Gluten-Free' END) AS dietary_flags")


# -------------------------------------------------------------- dim_employee

def dim_employee(employees: DataFrame, as_of: str | None = None) -> DataFrame:
    base = employees.selectExpr(
        "employee_id AS employee_key", "employee_id", "CAST(restaurant_id AS INT) AS restaurant_id",
        "first_name", "last_name", "concat_ws(' ', first_name, last_name) AS full_name",
        "regexp_replace(initcap(position), '_', ' ') AS position",
        "to_date(hire_date) AS hire_date", "to_date(leave_date) AS leave_date",
        "CAST(salary_per_hour AS DOUBLE) AS salary_per_hour", "CAST(hours_per_week AS INT) AS hours_per_week",
        "employment_status", "reason_for_leaving", "CAST(performance_rating AS DOUBLE) AS performance_rating")
    tenure = half_up_sql(
        months_between_e8_sql(f"coalesce(leave_date, {_as_of_sql(as_of)})", "hire_date"), str(10 ** 8), 1)
    return base.selectExpr(
        "*", f"{tenure} AS tenure_months",
        "coalesce(employment_status = 'Active', false) AS is_active",
        f"{round_units_sql(units_sql('salary_per_hour') + ' * hours_per_week')} AS weekly_cost_gbp")
