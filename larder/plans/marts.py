"""KPI marts over the facts and dimensions.

Status scope follows the reference: monthly revenue, hourly demand and cohorts
count completed orders only; category, restaurant and item marts count every
order status. Money is summed exactly in integer units and rounded to cents once;
line amounts are already whole cents. Rounded means and percentages are HALF_UP of the exact quotient
(functions.numeric). Every aggregate pre-aggregates map-side (partial
HashAggregate) before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import year_month_sql
from ..functions.numeric import (avg_int_sql, avg_money_sql, avg_scaled_sql, cents_sql, from_cents_sql,
                                 pct_sql, sum_cents_sql, sum_money_sql)
from ..operators.rank import quantile_table
from ..session import stored
from ..sources.files import materialize, scratch_path
from .facts import order_margins


def _agg(df: DataFrame, keys, *exprs: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(e) for e in exprs])


def _flag_count_sql(c: str) -> str:
    return f"sum(CASE WHEN {c} THEN 1 ELSE 0 END)"


def agg_revenue_monthly(fct_orders: DataFrame, fct_order_items: DataFrame | None = None, unique_orders: bool = False) -> DataFrame:
    """Completed orders per month: orders, customers, revenue, AOV, margin, COGS, items.

    If ``fct_orders`` already carries per-order margin/cost cents (built with
    ``facts.order_line_summary(details, menu)``) the lines are not read again;
    otherwise margin and cost are pre-aggregated per order from
    ``fct_order_items`` and joined, as the reference does. Where every order has an id of its
    own (``unique_orders``), its lines carry its date and status, and are summed by month at once: the same sums.
    """
    orders = fct_orders.where("is_completed")
    keys, direct = ["year", "month", "year_month"], unique_orders and "order_margin_c" not in fct_orders.columns
    if "order_margin_c" not in fct_orders.columns and not unique_orders:
        orders = orders.join(order_margins(fct_order_items), "order_id", "left")
    g = _agg(orders, keys,
             "count(order_id) AS total_orders",
             "count(DISTINCT customer_id) AS unique_customers",
             f"{sum_cents_sql('total_amount')} AS _rev",
             f"{avg_money_sql('total_amount')} AS aov",
             *([] if direct else ["sum(order_margin_c) AS _gm", "sum(order_cost_c) AS _cogs"]),
             "sum(total_quantity) AS items_sold")
    if direct:
        lines = fct_order_items.where("order_status = 'Completed'").withColumn("_month", F.expr(year_month_sql("order_date")))
        sums = _agg(lines, ["_month"], f"sum({cents_sql('line_margin')}) AS _gm", f"sum({cents_sql('line_cost')}) AS _cogs")
        g = g.join(sums, g["year_month"].eqNullSafe(sums["_month"]), "left")
    return g.selectExpr(
        "year", "month", "year_month", "total_orders", "unique_customers",
        f"{from_cents_sql('_rev')} AS revenue", "aov",
        f"{from_cents_sql('_gm')} AS gross_margin", f"{from_cents_sql('_cogs')} AS total_cogs",
        "items_sold", f"{pct_sql('_gm', '_rev')} AS gross_margin_pct",
    ).orderBy("year", "month")


def agg_revenue_by_category(fct_order_items: DataFrame) -> DataFrame:
    g = _agg(fct_order_items, ["category", "sub_category"],
             f"sum({cents_sql('line_revenue')}) AS _rev",
             f"sum({cents_sql('line_cost')}) AS _cost",
             f"sum({cents_sql('line_margin')}) AS _margin",
             "sum(quantity) AS units_sold", "count(order_detail_id) AS line_items")
    return g.selectExpr(
        "category", "sub_category", f"{from_cents_sql('_rev')} AS revenue",
        f"{from_cents_sql('_cost')} AS cost", f"{from_cents_sql('_margin')} AS margin",
        "units_sold", "line_items", f"{pct_sql('_margin', '_rev')} AS margin_pct")


def restaurant_margin(fct_order_items: DataFrame) -> DataFrame:
    """Two-level aggregation: margin per (restaurant, order), then per restaurant (cents)."""
    per_order = _agg(fct_order_items, ["restaurant_id", "order_id"],
                     f"sum({cents_sql('line_margin')}) AS order_margin_c")
    return _agg(per_order, ["restaurant_id"], "sum(order_margin_c) AS gross_margin_c")


def two_level_margin(fct_order_items: DataFrame) -> DataFrame:
    return restaurant_margin(fct_order_items).selectExpr(
        "restaurant_id", f"{from_cents_sql('gross_margin_c')} AS gross_margin")


def agg_restaurant_performance(fct_orders: DataFrame, fct_order_items: DataFrame | None = None, written: bool = False) -> DataFrame:
    """Per restaurant over all orders: volume, revenue, AOV, customers, channel mix,
    completed-order rating and gross margin.

    With per-order margin cents on ``fct_orders`` the margin is summed in the
    same aggregate (each order belongs to one restaurant, so this equals the
    two-level order -> restaurant sum); otherwise it is the reference's
    two-level aggregation over ``fct_order_items`` joined back.
    ``written``: both are written tables, so they are read once for each measure that would move rows with the
    others: customers are counted apart from the sums, and margins are summed by restaurant at once (a sum of sums).
    """
    merged = "order_margin_c" in fct_orders.columns
    customers = "count(DISTINCT customer_id) AS unique_customers"
    df = _agg(fct_orders, ["restaurant_id"],
              "count(order_id) AS total_orders",
              f"{sum_cents_sql('total_amount')} AS _rev",
              f"{avg_money_sql('total_amount')} AS aov",
              *([] if written else [customers]),
              f"{_flag_count_sql('is_delivery')} AS delivery_orders",
              f"{_flag_count_sql('is_eat_in')} AS eat_in_orders",
              f"{avg_int_sql('CASE WHEN is_completed THEN customer_rating END', 2)} AS avg_rating",
              *(["sum(order_margin_c) AS gross_margin_c"] if merged else []))
    if written:
        who = _agg(fct_orders, ["restaurant_id"], customers).withColumnRenamed("restaurant_id", "_id")
        df = df.join(who, df["restaurant_id"].eqNullSafe(who["_id"])).drop("_id")
    # one row per restaurant on both sides, AQE broadcasts it when small
    if not merged:
        margin = _agg(fct_order_items, ["restaurant_id"], f"sum({cents_sql('line_margin')}) AS gross_margin_c") if written else restaurant_margin(fct_order_items)
        df = df.join(margin, "restaurant_id", "left")
    return df.selectExpr(
        "restaurant_id", "total_orders", f"{from_cents_sql('_rev')} AS revenue", "aov",
        "unique_customers", "delivery_orders", "eat_in_orders", "avg_rating",
        f"{from_cents_sql('gross_margin_c')} AS gross_margin",
        f"{pct_sql('delivery_orders', 'total_orders')} AS delivery_share_pct",
        f"{pct_sql('gross_margin_c', '_rev')} AS gross_margin_pct")


def agg_hourly_demand(fct_orders: DataFrame) -> DataFrame:
    return _agg(fct_orders.where("is_completed"), ["day_of_week", "hour_of_day"],
                "count(order_id) AS orders",
                f"{sum_money_sql('total_amount')} AS revenue",
                f"{avg_money_sql('total_amount')} AS aov")


def hourly_activity(events: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    """The same day-of-week x hour demand profile over any event stream."""
    return events.groupBy(F.expr(f"dayofweek({ts}) AS day_of_week"), F.expr(f"hour({ts}) AS hour_of_day")).agg(
        F.expr("count(1) AS events"),
        F.expr(f"{sum_money_sql(value)} AS total_value"),
        F.expr(f"{avg_money_sql(value)} AS avg_value"))


def agg_customer_cohorts(customers: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Distinct active customers per (signup month, order month); completed orders."""
    cust = customers.selectExpr("customer_id", "date_format(join_date, 'yyyy-MM') AS cohort_month")
    # one row per customer and month before the join, so it moves far fewer rows
    orders = fct_orders.where("is_completed AND customer_id IS NOT NULL").selectExpr(
        "customer_id", "date_format(order_date, 'yyyy-MM') AS order_month").distinct()
    g = _agg(cust.join(orders, "customer_id", "inner"), ["cohort_month", "order_month"],
             "count(DISTINCT customer_id) AS active_customers")
    return g.selectExpr(
        "*",
        "(year(to_date(order_month || '-01')) - year(to_date(cohort_month || '-01'))) * 12 "
        "+ (month(to_date(order_month || '-01')) - month(to_date(cohort_month || '-01'))) AS months_since_join")


def agg_customer_lifetime(dim_customer: DataFrame) -> DataFrame:
    return _agg(dim_customer, ["customer_segment", "rfm_segment"],
                "count(customer_id) AS customers",
                f"{avg_int_sql('total_orders', 2)} AS avg_orders",
                f"{avg_money_sql('total_spent')} AS avg_spend",
                f"{avg_money_sql('customer_lifetime_value')} AS avg_clv",
                f"{sum_money_sql('customer_lifetime_value')} AS total_clv",
                f"{avg_int_sql('recency_days', 1)} AS avg_recency_days")


def agg_item_performance(fct_order_items: DataFrame) -> DataFrame:
    g = _agg(fct_order_items, ["restaurant_id", "item_id", "category", "sub_category"],
             "sum(quantity) AS units_sold", "count(order_detail_id) AS times_ordered",
             f"sum({cents_sql('line_revenue')}) AS _rev",
             f"sum({cents_sql('line_margin')}) AS _margin",
             f"{avg_money_sql('item_price_at_time')} AS avg_price")
    return g.selectExpr(
        "restaurant_id", "item_id", "category", "sub_category", "units_sold", "times_ordered",
        f"{from_cents_sql('_rev')} AS revenue", f"{from_cents_sql('_margin')} AS margin", "avg_price",
        f"{pct_sql('_margin', '_rev')} AS margin_pct")


def quadrant_by_group_median(df: DataFrame, group: str, x: str, y: str,
                             exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Label rows High/Low against their group's median of ``x`` and of ``y``.

    Medians are exact (``percentile_disc(0.5)``, by counting) by default, or ``percentile_approx`` with ``exact=False``. The per-group medians are
    one row per group, written first, so that their size is known when the join is planned
    and ``df`` stays where it is unless they are many. ``df`` is stored: the medians read it a few times.
    """
    df = stored(df)
    med = quantile_table(df, [x, y], [0.5], ["median"], [group], exact=exact, accuracy=accuracy)
    wide = _agg(med, [group],
                f"max(CASE WHEN column = '{x}' THEN median END) AS med_{x}",
                f"max(CASE WHEN column = '{y}' THEN median END) AS med_{y}")
    wide = materialize(wide, scratch_path(df.sparkSession, "medians"))
    return df.join(wide, group, "left").selectExpr(
        "*",
        f"CASE WHEN {x} >= med_{x} THEN 'High' ELSE 'Low' END AS popularity",
        f"CASE WHEN {y} >= med_{y} THEN 'High' ELSE 'Low' END AS profitability")


def agg_menu_engineering(item_performance: DataFrame, dim_menu_item: DataFrame,
                         exact: bool = True, by_item: bool = False) -> DataFrame:
    """Items against their restaurant's medians of units and margin.

    ``by_item``: ``item_performance`` is a table in buckets of the item, so that only the menu moves to meet it: the
    restaurants of an item are compared where it lies.
    """
    menu = dim_menu_item.select("item_id", "restaurant_id", "item_name", "price", "cost_to_make", "gross_margin_gbp", "gross_margin_pct")
    if by_item:
        # a difference, as two equalities would be the join's key, and the buckets are of one
        menu = menu.withColumnRenamed("item_id", "_item").withColumnRenamed("restaurant_id", "_restaurant")
        meets = (F.col("item_id") == F.col("_item")) & F.expr("CAST(restaurant_id AS BIGINT) - CAST(_restaurant AS BIGINT) = 0")
        perf = item_performance.join(menu, meets, "left").drop("_item", "_restaurant")
        keys = ["item_id", "restaurant_id"]
        perf = perf.select(*keys, *[c for c in perf.columns if c not in keys])
    else:
        perf = item_performance.join(menu, ["item_id", "restaurant_id"], "left")
    df = quadrant_by_group_median(perf, "restaurant_id", "units_sold", "margin_pct", exact=exact)
    return df.withColumnRenamed("med_units_sold", "med_units").selectExpr(
        "*",
        # fixed values: the quadrants' names
        "CASE WHEN popularity = 'High' AND profitability = 'High' THEN 'Star' "
        "WHEN popularity = 'Low' AND profitability = 'High' THEN 'Puzzle' "
        "WHEN popularity = 'High' AND profitability = 'Low' THEN 'Plowhorse' "
        "ELSE 'Dog' END AS classification")


def agg_ops_costs(fct_daily_ops: DataFrame) -> DataFrame:
    parts = {"electricity": "electricity_cost", "water": "water_cost", "gas": "gas_cost",
             "maintenance": "maintenance_cost", "other": "other_bills_cost"}
    g = _agg(fct_daily_ops, ["restaurant_id", "year_month"],
             *[f"{sum_cents_sql(src)} AS _{name}" for name, src in parts.items()],
             f"sum({cents_sql('total_operating_cost')}) AS _cost",
             f"{sum_cents_sql('daily_revenue')} AS _rev",
             f"{avg_int_sql('average_wait_time_mins', 1)} AS avg_wait_time_mins",
             f"{avg_int_sql('staff_on_shift', 1)} AS avg_staff_on_shift")
    return g.selectExpr(
        "restaurant_id", "year_month",
        *[f"{from_cents_sql('_' + name)} AS {name}" for name in parts],
        f"{from_cents_sql('_cost')} AS total_cost", f"{from_cents_sql('_rev')} AS revenue",
        "avg_wait_time_mins", "avg_staff_on_shift",
        f"{pct_sql('_cost', '_rev')} AS cost_to_revenue_pct")


def agg_staffing_efficiency(dim_employee: DataFrame) -> DataFrame:
    g = _agg(dim_employee, ["restaurant_id", "position"],
             "count(employee_id) AS headcount",
             f"{_flag_count_sql('is_active')} AS active_headcount",
             "sum(CASE WHEN is_active = false THEN 1 ELSE 0 END) AS left_headcount",
             f"{avg_money_sql('salary_per_hour')} AS avg_hourly_rate",
             f"{avg_int_sql('hours_per_week', 1)} AS avg_hours_per_week",
             f"{avg_money_sql('performance_rating')} AS avg_rating",
             f"{avg_scaled_sql('tenure_months', 1, 1)} AS avg_tenure_months",
             f"{sum_money_sql('weekly_cost_gbp')} AS weekly_payroll")
    return g.selectExpr("*", f"{pct_sql('left_headcount', 'headcount')} AS turnover_pct")


def _delivery_measures():
    return [
        f"{avg_money_sql('delivery_minutes')} AS avg_delivery_mins",
        f"{avg_money_sql('distance_miles')} AS avg_distance_miles",
        f"{_flag_count_sql('is_on_time')} AS on_time_count",
        f"{_flag_count_sql('is_delayed')} AS delayed_count",
        f"{_flag_count_sql('is_cancelled')} AS cancelled_count",
    ]


def agg_delivery_by_condition(fct_delivery: DataFrame) -> DataFrame:
    g = _agg(fct_delivery, ["traffic_condition", "weather_condition"],
             "count(delivery_id) AS deliveries", *_delivery_measures())
    return g.selectExpr("*", f"{pct_sql('on_time_count', 'deliveries')} AS on_time_pct")


def agg_driver_performance(fct_delivery: DataFrame) -> DataFrame:
    """Per-driver trips and on-time % (documented by the reference, not coded there)."""
    g = _agg(fct_delivery, ["driver_id"], "count(delivery_id) AS trips", *_delivery_measures())
    return g.selectExpr("*", f"{pct_sql('on_time_count', 'trips')} AS on_time_pct")
