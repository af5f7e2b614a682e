"""Fact tables: orders, order lines, deliveries, daily inventory, daily operations.

Money is derived exactly (integer units, functions.numeric) and exposed as double, matching the
reference's column types. Keys stay as they arrive (64-bit ids are not
narrowed to int: at large scale they do not fit). Each projection is one
``selectExpr`` so a fact costs one JVM call to declare.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import date_key_sql, year_month_sql
from ..sources.files import gathered
from ..functions.numeric import UNIT, cents_of_units_sql, cents_sql, half_up_sql, pct_sql, round_units_sql, units_sql


def flag_sql(x: str, value: str) -> str:
    """True when x equals value; NULL counts as False."""
    return f"coalesce({x} = '{value}', false)"


ORDER_COLUMNS = [
    "order_id", "CAST(restaurant_id AS INT) AS restaurant_id", "customer_id",
    "to_date(order_date) AS order_date", "order_time", "order_type", "payment_method", "order_status",
    "delivery_postcode", "CAST(delivery_distance_miles AS DOUBLE) AS delivery_distance_miles",
    "CAST(delivery_time_mins AS INT) AS delivery_time_mins", "CAST(total_amount AS DOUBLE) AS total_amount",
    "CAST(customer_rating AS INT) AS customer_rating",
]


def order_line_summary(order_details: DataFrame, menu_items: DataFrame | None = None,
                       menu_keys: Sequence[str] = ("item_id",)) -> DataFrame:
    """Per order: number of lines and total quantity, pre-aggregated before any join.

    With ``menu_items`` the same single pass over the lines also sums the
    order's margin and cost in cents (``order_margin_c``, ``order_cost_c``),
    so marts that need both read the lines once instead of twice.
    """
    if menu_items is None:
        return order_details.groupBy("order_id").agg(
            F.expr("count(order_detail_id) AS line_item_count"), F.expr("sum(quantity) AS total_quantity"))
    menu = menu_items.selectExpr(*menu_keys, "CAST(cost_to_make AS DOUBLE) AS cost_to_make")
    lines = order_details.join(menu, list(menu_keys), "left")
    price, cost = units_sql("item_price_at_time"), units_sql("cost_to_make")
    # each line's amounts are rounded to cents before they are summed
    return lines.groupBy("order_id").agg(
        F.expr("count(order_detail_id) AS line_item_count"), F.expr("sum(quantity) AS total_quantity"),
        F.expr(f"sum({cents_of_units_sql(f'({price} - {cost}) * quantity')}) AS order_margin_c"),
        F.expr(f"sum({cents_of_units_sql(f'{cost} * quantity')}) AS order_cost_c"))


def order_margins(fct_order_items: DataFrame) -> DataFrame:
    """Per order: margin and cost in cents, from the lines' rounded amounts."""
    return fct_order_items.groupBy("order_id").agg(
        F.expr(f"sum({cents_sql('line_margin')}) AS order_margin_c"),
        F.expr(f"sum({cents_sql('line_cost')}) AS order_cost_c"))


def unique_orders(orders: DataFrame) -> bool:
    """Whether no order id repeats (NULL ids meet no lines)."""
    return orders.where("order_id IS NOT NULL").groupBy("order_id").count().where("count > 1").isEmpty()


def fct_orders(orders: DataFrame, order_details: DataFrame, line_summary: DataFrame | None = None, by_month: bool = False) -> DataFrame:
    """One row per order with line counts, calendar columns and status flags.

    ``line_summary`` (from ``order_line_summary``) may be passed in; if it
    carries margin/cost cents they are kept as extra columns. ``by_month`` gathers
    the rows by month (to be written so) before the calendar and flag columns are added.
    """
    summary = line_summary if line_summary is not None else order_line_summary(order_details)
    extra = [c for c in ("order_margin_c", "order_cost_c") if c in summary.columns]
    base = with_order_time(orders).selectExpr(*ORDER_COLUMNS)
    df = base.join(summary, "order_id", "left")
    if by_month:
        df = gathered(df, year_month_sql("order_date"))
    return _order_columns(df, extra)


def _order_columns(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return df.selectExpr(
        *[c.split(" AS ")[-1] for c in ORDER_COLUMNS],
        "CAST(coalesce(line_item_count, 0) AS INT) AS line_item_count",
        "CAST(coalesce(total_quantity, 0) AS INT) AS total_quantity",
        f"{date_key_sql('order_date')} AS date_key",
        "year(order_date) AS year", "month(order_date) AS month",
        f"{year_month_sql('order_date')} AS year_month",
        "dayofweek(order_date) AS day_of_week", "hour(order_time) AS hour_of_day",
        f"{flag_sql('order_status', 'Completed')} AS is_completed",
        f"{flag_sql('order_status', 'Cancelled')} AS is_cancelled",
        f"{flag_sql('order_status', 'Refunded')} AS is_refunded",
        f"{flag_sql('order_type', 'Delivery')} AS is_delivery",
        f"{flag_sql('order_type', 'Eat-in')} AS is_eat_in",
        *extra,
    )


_MONTH_PARTS = 4  # tasks that a month's orders may be dealt over


def fct_orders_dealt(orders: DataFrame, order_details: DataFrame) -> DataFrame:
    """``fct_orders`` whose rows of a month lie together, each order moved once.

    Orders are dealt by their month and a hash of their id. The lines' counts meet ids and months alone, and
    follow the order to where it is dealt.
    """
    part = f"coalesce(year(order_date) * 12 + month(order_date), 0) * {_MONTH_PARTS} + pmod(xxhash64(order_id), {_MONTH_PARTS})"
    base = with_order_time(orders).selectExpr(*ORDER_COLUMNS).selectExpr("*", f"{part} AS _month_part")
    ids = base.where("order_id IS NOT NULL").select("order_id", "_month_part").repartition("order_id").dropDuplicates()
    counts = ids.join(order_line_summary(order_details), "order_id")
    both = base.withColumn("_order", F.lit(True)).unionByName(counts, allowMissingColumns=True).repartition("_month_part")
    mine = Window.partitionBy("order_id", "_month_part")
    df = both.withColumns({c: F.max(c).over(mine) for c in ("line_item_count", "total_quantity")}).where("_order")
    return _order_columns(df)


def fct_order_items(order_details: DataFrame, orders: DataFrame, menu_items: DataFrame,
                    menu_keys: Sequence[str] = ("item_id",), buckets: int | None = None) -> DataFrame:
    """One row per order line with revenue, cost and margin.

    ``menu_keys`` is the menu join key; the reference joins on item_id alone,
    which fans lines out if an item id repeats across restaurants (pass
    ``("item_id", "restaurant_id")`` to join on the declared key).
    The dimension sides are not hinted: AQE broadcasts them at run time when
    their measured size is under the threshold and shuffles otherwise. ``buckets``: the
    lines are dealt into as many partitions by their item for that join, to be saved so.
    """
    # what is moved has its repeating columns together at the end, where the shuffle's compression finds them as one
    details = order_details.selectExpr(
        "order_id", "order_detail_id", "item_id", "CAST(item_price_at_time AS DOUBLE) AS item_price_at_time",
        "CAST(quantity AS INT) AS quantity", "special_instructions")
    head = orders.selectExpr(
        "order_id", "customer_id", "to_date(order_date) AS order_date",
        "CAST(restaurant_id AS INT) AS restaurant_id", "order_type", "order_status")
    menu_cols = ["item_id", "CAST(restaurant_id AS INT) AS restaurant_id"] if "restaurant_id" in menu_keys \
        else ["item_id"]
    menu = menu_items.selectExpr(*menu_cols, "CAST(cost_to_make AS DOUBLE) AS cost_to_make",
                                 "category", "sub_category")
    lines = details.join(head, "order_id", "left").select(
        "item_id", "order_id", "order_detail_id", "customer_id", "item_price_at_time", "order_date", "quantity",
        "restaurant_id", "order_type", "order_status", "special_instructions")
    if buckets:
        lines = lines.repartition(buckets, "item_id")
    df = lines.join(menu, list(menu_keys), "left")
    price, cost = units_sql("item_price_at_time"), units_sql("cost_to_make")
    columns = ["order_id", "order_detail_id", "quantity", "item_price_at_time", "special_instructions", "restaurant_id", "customer_id",
               "order_date", "order_type", "order_status", "cost_to_make", "category", "sub_category"]
    return df.selectExpr(
        *menu_keys, *[c for c in columns if c not in menu_keys],
        f"{round_units_sql(f'{price} * quantity')} AS line_revenue",
        f"{round_units_sql(f'{cost} * quantity')} AS line_cost",
        f"{round_units_sql(f'({price} - {cost}) * quantity')} AS line_margin",
        f"{date_key_sql('order_date')} AS date_key",
    )


def with_timestamps(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` given as text parsed to timestamps (unreadable text: NULL); others stay as they are."""
    text = {c: F.expr(f"try_to_timestamp({c})") for c in columns if dict(df.dtypes)[c] == "string"}
    return df.withColumns(text) if text else df


def with_order_time(df: DataFrame) -> DataFrame:
    """``order_time`` given as text parsed; a time of day alone is put on the order's date."""
    if dict(df.dtypes)["order_time"] != "string":
        return df
    alone = "concat_ws(' ', date_format(to_date(order_date), 'yyyy-MM-dd'), trim(order_time))"
    return df.withColumn("order_time", F.expr(
        f"try_to_timestamp(CASE WHEN trim(order_time) RLIKE '^[0-9]{{1,2}}:' THEN {alone} ELSE order_time END)"))


def _seconds_sql(x: str) -> str:
    """Whole seconds since the epoch; a fraction of a second counts for the second it is in."""
    return f"unix_seconds(CAST({x} AS TIMESTAMP))"


def fct_delivery(delivery_performance: DataFrame) -> DataFrame:
    return with_timestamps(delivery_performance, "dispatch_time", "delivery_time").selectExpr(
        "delivery_id", "order_id", "CAST(restaurant_id AS INT) AS restaurant_id", "driver_id",
        "dispatch_time", "delivery_time", "CAST(distance_miles AS DOUBLE) AS distance_miles",
        "traffic_condition", "weather_condition", "delivery_status",
        f"{half_up_sql(f"{_seconds_sql('delivery_time')} - {_seconds_sql('dispatch_time')}", '60', 2)} AS delivery_minutes",
        "to_date(dispatch_time) AS delivery_date",
        f"{date_key_sql('dispatch_time')} AS date_key",
        f"{flag_sql('delivery_status', 'On_Time')} AS is_on_time",
        f"{flag_sql('delivery_status', 'Delayed')} AS is_delayed",
        f"{flag_sql('delivery_status', 'Cancelled')} AS is_cancelled",
    )


def fct_inventory_daily(inventory: DataFrame) -> DataFrame:
    base = inventory.selectExpr(
        "inventory_id", "restaurant_id", "to_date(date) AS date", "item_id",
        "CAST(opening_stock AS INT) AS opening_stock", "CAST(received_stock AS INT) AS received_stock",
        "CAST(used_stock AS INT) AS used_stock", "CAST(coalesce(waste_stock, 0) AS INT) AS waste_stock",
        "CAST(closing_stock AS INT) AS closing_stock", "CAST(stock_value AS DOUBLE) AS stock_value",
        "CAST(coalesce(waste_value, 0.0) AS DOUBLE) AS waste_value")
    return base.selectExpr(
        "*", f"{date_key_sql('date')} AS date_key", f"{year_month_sql('date')} AS year_month",
        f"{pct_sql('waste_stock', 'used_stock + waste_stock')} AS waste_pct")


OPS_COSTS = ("electricity_cost", "water_cost", "gas_cost", "maintenance_cost", "other_bills_cost")
OPS_COUNTS = ("total_customers_eat_in", "total_customers_delivery", "total_orders",
              "delivery_orders_count", "eat_in_orders_count", "average_wait_time_mins", "staff_on_shift")


def fct_daily_ops(daily_operations: DataFrame) -> DataFrame:
    base = daily_operations.selectExpr(
        "operation_id", "CAST(restaurant_id AS INT) AS restaurant_id", "to_date(date) AS date",
        *[f"CAST({c} AS INT) AS {c}" for c in OPS_COUNTS],
        *[f"CAST({c} AS DOUBLE) AS {c}" for c in OPS_COSTS],
        "CAST(daily_revenue AS DOUBLE) AS daily_revenue")
    total_cost = " + ".join(units_sql(c) for c in OPS_COSTS)
    customers = "total_customers_eat_in + total_customers_delivery"
    return base.selectExpr(
        "*", f"{date_key_sql('date')} AS date_key", f"{year_month_sql('date')} AS year_month",
        f"{customers} AS total_customers",
        f"{round_units_sql(total_cost)} AS total_operating_cost",
        f"(CASE WHEN {customers} > 0 THEN {half_up_sql(units_sql('daily_revenue'), f'({customers}) * {UNIT}', 2)} "
        f"ELSE 0.0D END) AS revenue_per_customer",
    )
