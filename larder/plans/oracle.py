"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Written against the raw test-table views, re-stating the adapters as CTEs.
Rounding is HALF_UP on exact integers: ``hu(n, d, k)`` is the SQL form of
round(n / d, k) for integer-valued n and d.
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-31'"


# ------------------------------------------------------------- SQL snippets

def money(x: str) -> str:
    """Exact money with the decimals that capping can leave."""
    return f"CAST({x} AS DECIMAL(18,4))"


def cents(x: str) -> str:
    """Whole cents of an amount already rounded to cents."""
    return f"CAST(round_even(CAST({x} AS DOUBLE) * 100, 0) AS HUGEINT)"


def units(x: str) -> str:
    return f"CAST(round_even(CAST({x} AS DOUBLE) * 10000, 0) AS HUGEINT)"


def sum2(x: str) -> str:
    """round(sum(money x), 2), exact."""
    return f"round(sum({money(x)}), 2)"


def hu(n: str, d: str, k: int) -> str:
    n = f"CAST({n} AS HUGEINT)"
    d = f"CAST({d} AS HUGEINT)"
    s = 10 ** k
    return (
        f"(CASE WHEN {d} IS NULL OR {d} = 0 THEN NULL ELSE "
        f"CAST((CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * "
        f"((2 * abs({n}) * {s} + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {float(s)} END)"
    )


def avg_money(x: str, k: int = 2) -> str:
    return hu(f"sum({units(x)})", f"count({x}) * 10000", k)


def avg_int(x: str, k: int) -> str:
    return hu(f"sum({x})", f"count({x})", k)


def sum_money(x: str) -> str:
    return f"CAST({sum2(x)} AS DOUBLE)"


def pct(num_units: str, den_units: str, guard: str) -> str:
    """round(num/den*100, 2) guarded by ``guard > 0``; *_units are exact integers
    at the same scale."""
    return f"(CASE WHEN {guard} > 0 THEN {hu(f'({num_units}) * 100', den_units, 2)} ELSE 0.0 END)"


def initcap1(x: str) -> str:
    """initcap of a single word, spaces before it kept."""
    pad = f"length({x}) - length(ltrim({x}))"
    return f"(repeat(' ', {pad}) || upper(substr(ltrim({x}), 1, 1)) || lower(substr(ltrim({x}), 2)))"


def months_between_e8(a: str, b: str) -> str:
    """Spark months_between(a, b) for dates, as an integer count of 1e-8 months."""
    whole = f"((year({a}) - year({b})) * 12 + (month({a}) - month({b})))"
    return (
        f"CAST(round((CASE WHEN day({a}) = day({b}) OR ({a} = last_day({a}) AND {b} = last_day({b})) "
        f"THEN CAST({whole} AS DOUBLE) "
        f"ELSE {whole} + (day({a}) - day({b})) * 86400 / 2678400.0 END) * 1e8) AS BIGINT)"
    )


def date_key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def ym(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


# ------------------------------------------------------------------ adapters

ADAPTERS = {
    "restaurants_s": """
SELECT n_nationkey AS restaurant_id, n_name AS restaurant_name,
       n_name || ' High Street' AS address,
       'W' || CAST(n_regionkey AS VARCHAR) || ' ' || CAST(n_nationkey AS VARCHAR) AS postcode,
       r_name AS area,
       DATE '1990-01-31' + CAST(37 * n_nationkey AS INTEGER) AS opening_date,
       CASE WHEN n_nationkey % 11 = 10 THEN NULL ELSE 40 + 3 * n_nationkey END AS seating_capacity,
       n_nationkey % 5 + 1 AS delivery_radius_miles,
       '020' || lpad(CAST(n_nationkey AS VARCHAR), 8, '0') AS phone_number
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers_s": """
SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name || '@X.COM' END AS email,
       '07' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
       'e' || CAST(c_nationkey AS VARCHAR) || ' 1aa' AS postcode,
       DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS join_date,
       c_mktsegment AS customer_segment, c_mktsegment AS preferred_category,
       CASE WHEN c_custkey % 2 = 0 THEN 'delivery' ELSE 'collection' END AS preferred_order_type,
       c_acctbal AS avg_order_value, c_acctbal > 0 AS is_active
FROM customer""",
    "employees_s": """
SELECT s_suppkey AS employee_id, s_nationkey AS restaurant_id,
       split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
       CASE s_suppkey % 3 WHEN 0 THEN 'kitchen_staff' WHEN 1 THEN 'delivery_driver' ELSE 'manager' END AS position,
       DATE '1995-01-31' + CAST(17 * (s_suppkey % 140) AS INTEGER) AS hire_date,
       CASE WHEN s_suppkey % 4 = 0 THEN DATE '1995-01-31' + CAST(17 * (s_suppkey % 140) + 400 AS INTEGER) END AS leave_date,
       CASE WHEN s_suppkey % 4 = 0 THEN 'Left' ELSE 'Active' END AS employment_status,
       CAST(10 + s_suppkey % 15 AS DOUBLE) AS salary_per_hour,
       CAST(20 + s_suppkey % 21 AS INTEGER) AS hours_per_week,
       CASE WHEN s_suppkey % 4 = 0 THEN 'Relocation' END AS reason_for_leaving,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(1 + s_suppkey % 5 AS DOUBLE) END AS performance_rating
FROM supplier""",
    "menu_s": """
SELECT p_partkey AS item_id, CAST(p_partkey % 10 AS INTEGER) AS restaurant_id,
       p_name AS item_name, p_type AS category,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS sub_category,
       p_retailprice AS price,
       CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)), 2) AS DOUBLE) AS cost_to_make,
       p_size AS preparation_time_mins, p_size % 2 = 0 AS is_vegetarian,
       p_size % 3 = 0 AS is_vegan, p_size % 5 = 0 AS is_gluten_free, p_size * 10 AS calories
FROM part""",
    "orders_s": """
SELECT o_orderkey AS order_id, CAST(o_orderkey % 10 AS INTEGER) AS restaurant_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS customer_id,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'cust ' || CAST(o_custkey AS VARCHAR) END AS customer_name,
       CAST(o_orderdate AS DATE) AS order_date,
       o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_time,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Delivery' ELSE 'Eat-in' END AS order_type,
       o_orderpriority AS payment_method,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Cancelled' WHEN 'P' THEN 'Refunded' END AS order_status,
       'SW' || CAST(o_custkey % 20 AS VARCHAR) AS delivery_postcode,
       CAST(o_orderkey % 80 AS DOUBLE) / 10.0 AS delivery_distance_miles,
       CAST(10 + o_orderkey % 50 AS INTEGER) AS delivery_time_mins,
       o_totalprice AS total_amount,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 5 AS INTEGER) END AS customer_rating
FROM orders""",
    "details_s": """
SELECT 10 * l_orderkey + l_linenumber AS order_detail_id, l_orderkey AS order_id,
       l_partkey AS item_id, CAST(l_quantity AS INTEGER) AS quantity,
       l_extendedprice AS item_price_at_time, CASE l_partkey % 3 WHEN 1 THEN 'no onions' WHEN 2 THEN 'extra sauce' END AS special_instructions
FROM lineitem""",
    "delivery_s": """
SELECT 10 * l_orderkey + l_linenumber AS delivery_id, l_orderkey AS order_id,
       CAST(l_orderkey % 10 AS INTEGER) AS restaurant_id, l_suppkey AS driver_id,
       l_shipdate AS dispatch_time,
       l_shipdate + to_minutes(CAST(10 + (7 * l_orderkey + l_partkey) % 50 AS INTEGER)) AS delivery_time,
       l_quantity / 10.0 AS distance_miles,
       l_returnflag AS traffic_condition, l_linestatus AS weather_condition,
       CASE WHEN 10 + (7 * l_orderkey + l_partkey) % 50 <= 30 THEN 'On_Time'
            WHEN 10 + (7 * l_orderkey + l_partkey) % 50 <= 50 THEN 'Delayed'
            ELSE 'Cancelled' END AS delivery_status
FROM lineitem""",
    "inventory_s": """
SELECT min(l_orderkey) AS inventory_id, l_suppkey AS restaurant_id,
       CAST(l_shipdate AS DATE) AS date, l_partkey AS item_id, CAST(100 + l_partkey % 37 AS INTEGER) AS opening_stock,
       CAST(coalesce(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END), 0)
          + coalesce(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) END), 0) AS BIGINT) AS received_stock,
       CAST(coalesce(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END), 0) AS BIGINT) AS used_stock,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) END) AS BIGINT) AS waste_stock,
       CAST(100 + l_partkey % 37 + l_suppkey % 5 AS INTEGER) AS closing_stock,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS stock_value,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS waste_value
FROM lineitem GROUP BY l_suppkey, l_partkey, CAST(l_shipdate AS DATE)""",
    "daily_s": """
SELECT min(l_orderkey) AS operation_id, CAST(l_suppkey % 10 AS INTEGER) AS restaurant_id,
       CAST(l_shipdate AS DATE) AS date,
       count(*) FILTER (WHERE l_linestatus = 'F') AS total_customers_eat_in,
       count(*) FILTER (WHERE l_linestatus = 'O') AS total_customers_delivery,
       count(*) AS total_orders,
       count(*) FILTER (WHERE l_linestatus = 'O') AS delivery_orders_count,
       count(*) FILTER (WHERE l_linestatus = 'F') AS eat_in_orders_count,
       5 + count(*) % 20 AS average_wait_time_mins,
       1 + count(*) % 9 AS staff_on_shift,
       CAST(count(*) * CAST(1.10 AS DECIMAL(4,2)) AS DOUBLE) AS electricity_cost,
       CAST(count(*) * CAST(0.35 AS DECIMAL(4,2)) AS DOUBLE) AS water_cost,
       CAST(count(*) * CAST(0.80 AS DECIMAL(4,2)) AS DOUBLE) AS gas_cost,
       CAST(count(*) * CAST(2.00 AS DECIMAL(4,2)) AS DOUBLE) AS maintenance_cost,
       CAST(count(*) * CAST(0.15 AS DECIMAL(4,2)) AS DOUBLE) AS other_bills_cost,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS daily_revenue
FROM lineitem GROUP BY CAST(l_suppkey % 10 AS INTEGER), CAST(l_shipdate AS DATE)""",
    "reviews_s": """
SELECT d.doc_id AS review_id, d.doc_id % (SELECT greatest(count(*), 1) FROM customer) + 1 AS customer_id, d.text AS review_text,
       d.lang AS category, CAST(l.quality AS DOUBLE) AS rating,
       CAST(d.n_chars AS DOUBLE) AS sentiment_score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
}


def with_(*names: str, extra: dict[str, str] | None = None) -> str:
    """WITH clause holding the named adapter / helper CTEs, in order."""
    parts = []
    for n in names:
        body = (extra or {}).get(n) or ADAPTERS.get(n) or GOLD_CTES[n]
        parts.append(f"{n} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"


# -------------------------------------------------------- gold CTE bodies

def lifetime_value(r: str = "", c: str = "") -> str:
    """round(coalesce(mean amount, avg_order_value) * coalesce(orders, 0), 2); the mean skips NULL amounts."""
    mean = hu(f"{r}total_spent_dec * 10000 * {r}orders_cnt", f"{r}amount_cnt * 10000", 2)
    return f"coalesce({mean}, CAST(round({money(f'{c}avg_order_value')} * coalesce({r}orders_cnt, 0), 2) AS DOUBLE))"


GOLD_CTES = {
    "fct_orders": f"""
SELECT o.order_id, o.restaurant_id, o.customer_id, o.order_date, o.order_time, o.order_type,
       o.payment_method, o.order_status, o.delivery_postcode, o.delivery_distance_miles,
       o.delivery_time_mins, o.total_amount, o.customer_rating,
       CAST(coalesce(s.line_item_count, 0) AS INTEGER) AS line_item_count,
       CAST(coalesce(s.total_quantity, 0) AS INTEGER) AS total_quantity,
       {date_key('o.order_date')} AS date_key,
       CAST(year(o.order_date) AS INTEGER) AS year,
       CAST(month(o.order_date) AS INTEGER) AS month,
       {ym('o.order_date')} AS year_month,
       CAST(dayofweek(o.order_date) + 1 AS INTEGER) AS day_of_week,
       CAST(hour(o.order_time) AS INTEGER) AS hour_of_day,
       coalesce(o.order_status = 'Completed', false) AS is_completed,
       coalesce(o.order_status = 'Cancelled', false) AS is_cancelled,
       coalesce(o.order_status = 'Refunded', false) AS is_refunded,
       coalesce(o.order_type = 'Delivery', false) AS is_delivery,
       coalesce(o.order_type = 'Eat-in', false) AS is_eat_in
FROM orders_s o LEFT JOIN (
    SELECT order_id, count(order_detail_id) AS line_item_count, sum(quantity) AS total_quantity
    FROM details_s GROUP BY order_id) s ON o.order_id = s.order_id""",
    "fct_order_items": f"""
SELECT d.order_detail_id, d.order_id, d.item_id, d.quantity, d.item_price_at_time,
       d.special_instructions, o.restaurant_id, o.customer_id, o.order_date, o.order_type,
       o.order_status, m.cost_to_make, m.category, m.sub_category,
       CAST(round({money('d.item_price_at_time')} * d.quantity, 2) AS DOUBLE) AS line_revenue,
       CAST(round({money('m.cost_to_make')} * d.quantity, 2) AS DOUBLE) AS line_cost,
       CAST(round(({money('d.item_price_at_time')} - {money('m.cost_to_make')}) * d.quantity, 2) AS DOUBLE) AS line_margin,
       {date_key('o.order_date')} AS date_key
FROM details_s d LEFT JOIN orders_s o ON d.order_id = o.order_id
LEFT JOIN menu_s m ON d.item_id = m.item_id""",
    "fct_delivery": f"""
SELECT delivery_id, order_id, restaurant_id, driver_id, dispatch_time, delivery_time,
       distance_miles, traffic_condition, weather_condition, delivery_status,
       {hu("date_diff('second', dispatch_time, delivery_time)", '60', 2)} AS delivery_minutes,
       CAST(dispatch_time AS DATE) AS delivery_date,
       {date_key('dispatch_time')} AS date_key,
       coalesce(delivery_status = 'On_Time', false) AS is_on_time,
       coalesce(delivery_status = 'Delayed', false) AS is_delayed,
       coalesce(delivery_status = 'Cancelled', false) AS is_cancelled
FROM delivery_s""",
    "fct_inventory_daily": f"""
SELECT inventory_id, restaurant_id, date, item_id,
       CAST(opening_stock AS INTEGER) AS opening_stock,
       CAST(received_stock AS INTEGER) AS received_stock,
       CAST(used_stock AS INTEGER) AS used_stock,
       CAST(coalesce(waste_stock, 0) AS INTEGER) AS waste_stock,
       CAST(closing_stock AS INTEGER) AS closing_stock,
       stock_value, coalesce(waste_value, 0.0) AS waste_value,
       {date_key('date')} AS date_key, {ym('date')} AS year_month,
       {pct('coalesce(waste_stock, 0)', 'used_stock + coalesce(waste_stock, 0)', 'used_stock + coalesce(waste_stock, 0)')} AS waste_pct
FROM inventory_s""",
    "fct_daily_ops": f"""
SELECT operation_id, restaurant_id, date,
       CAST(total_customers_eat_in AS INTEGER) AS total_customers_eat_in,
       CAST(total_customers_delivery AS INTEGER) AS total_customers_delivery,
       CAST(total_orders AS INTEGER) AS total_orders,
       CAST(delivery_orders_count AS INTEGER) AS delivery_orders_count,
       CAST(eat_in_orders_count AS INTEGER) AS eat_in_orders_count,
       CAST(average_wait_time_mins AS INTEGER) AS average_wait_time_mins,
       CAST(staff_on_shift AS INTEGER) AS staff_on_shift,
       electricity_cost, water_cost, gas_cost, maintenance_cost, other_bills_cost, daily_revenue,
       {date_key('date')} AS date_key, {ym('date')} AS year_month,
       CAST(total_customers_eat_in + total_customers_delivery AS INTEGER) AS total_customers,
       CAST(round({money('electricity_cost')} + {money('water_cost')} + {money('gas_cost')}
            + {money('maintenance_cost')} + {money('other_bills_cost')}, 2) AS DOUBLE) AS total_operating_cost,
       CASE WHEN total_customers_eat_in + total_customers_delivery > 0
            THEN {hu(units('daily_revenue'), '(total_customers_eat_in + total_customers_delivery) * 10000', 2)}
            ELSE 0.0 END AS revenue_per_customer
FROM daily_s""",
    "customer_base": f"""
SELECT c.customer_id, c.join_date, c.avg_order_value, s.orders_cnt, s.total_spent_dec,
       s.amount_cnt, s.first_order_date, s.last_order_date,
       CAST(date_diff('day', coalesce(s.last_order_date, c.join_date), {AS_OF}) AS INTEGER) AS recency_days
FROM customers_s c LEFT JOIN (
    SELECT customer_id, count(order_id) AS orders_cnt,
           sum({money('total_amount')}) AS total_spent_dec, count(total_amount) AS amount_cnt,
           max(order_date) AS last_order_date, min(order_date) AS first_order_date
    FROM orders_s WHERE order_status = 'Completed' GROUP BY customer_id) s
ON c.customer_id = s.customer_id""",
    "rfm": """
SELECT *,
  CASE WHEN orders_cnt IS NULL THEN 1 ELSE CAST(ntile(5) OVER (ORDER BY recency_days ASC, customer_id ASC) AS INTEGER) END AS r_score,
  CASE WHEN orders_cnt IS NULL THEN 1 ELSE CAST(ntile(5) OVER (ORDER BY orders_cnt DESC NULLS LAST, customer_id ASC) AS INTEGER) END AS f_score,
  CASE WHEN total_spent_dec IS NULL THEN 1 ELSE CAST(ntile(5) OVER (ORDER BY total_spent_dec DESC NULLS LAST, customer_id ASC) AS INTEGER) END AS m_score
FROM customer_base""",
    "rfm_high": """
SELECT *,
  CASE WHEN orders_cnt IS NULL THEN 1 ELSE CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id ASC) AS INTEGER) END AS r_score,
  CASE WHEN orders_cnt IS NULL THEN 1 ELSE CAST(ntile(5) OVER (ORDER BY orders_cnt ASC NULLS FIRST, customer_id ASC) AS INTEGER) END AS f_score,
  CASE WHEN total_spent_dec IS NULL THEN 1 ELSE CAST(ntile(5) OVER (ORDER BY total_spent_dec ASC NULLS FIRST, customer_id ASC) AS INTEGER) END AS m_score
FROM customer_base""",
    "dim_customer": f"""
SELECT c.customer_id AS customer_key, c.customer_id, c.first_name, c.last_name,
       concat_ws(' ', c.first_name, c.last_name) AS full_name, lower(c.email) AS email, c.phone,
       upper(c.postcode) AS postcode, c.join_date,
       {initcap1('c.customer_segment')} AS customer_segment,
       {initcap1('c.preferred_category')} AS preferred_category,
       {initcap1('c.preferred_order_type')} AS preferred_order_type,
       c.avg_order_value, c.is_active,
       r.first_order_date, r.last_order_date, r.recency_days, r.r_score, r.f_score, r.m_score,
       CASE WHEN r.r_score >= 4 AND r.f_score >= 4 AND r.m_score >= 4 THEN 'Champion'
            WHEN r.r_score >= 3 AND r.f_score >= 4 THEN 'Loyal'
            WHEN r.r_score >= 4 AND r.f_score <= 2 THEN 'New / Promising'
            WHEN r.r_score <= 2 AND r.f_score >= 4 THEN 'At Risk'
            WHEN r.r_score <= 2 AND r.f_score <= 2 THEN 'Lost'
            ELSE 'Need Attention' END AS rfm_segment,
       CAST(coalesce(r.orders_cnt, 0) AS INTEGER) AS total_orders,
       coalesce(CAST(round(r.total_spent_dec, 2) AS DOUBLE), 0.0) AS total_spent,
       coalesce({hu('r.total_spent_dec * 10000', 'r.amount_cnt * 10000', 2)}, 0.0) AS avg_order_value_actual,
       {lifetime_value('r.', 'c.')} AS customer_lifetime_value,
       CAST(r.r_score AS VARCHAR) || CAST(r.f_score AS VARCHAR) || CAST(r.m_score AS VARCHAR) AS rfm_score
FROM customers_s c JOIN rfm r ON c.customer_id = r.customer_id""",
    "dim_menu_item": f"""
SELECT item_id AS item_key, item_id, restaurant_id, item_name, category, sub_category,
       price, cost_to_make, CAST(preparation_time_mins AS INTEGER) AS preparation_time_mins,
       is_vegetarian, is_vegan, is_gluten_free, CAST(calories AS INTEGER) AS calories,
       CAST(round({money('price')} - {money('cost_to_make')}, 2) AS DOUBLE) AS gross_margin_gbp,
       {pct(f"{units('price')} - {units('cost_to_make')}", units('price'), 'price')} AS gross_margin_pct,
       concat_ws(',', CASE WHEN is_vegetarian THEN 'Vegetarian' END,
                      CASE WHEN is_vegan THEN 'Vegan' END,
                      CASE WHEN is_gluten_free THEN 'Gluten-Free' END) AS dietary_flags
FROM menu_s""",
    "dim_employee": f"""
SELECT employee_id AS employee_key, employee_id, CAST(restaurant_id AS INTEGER) AS restaurant_id,
       first_name, last_name, concat_ws(' ', first_name, last_name) AS full_name,
       replace({initcap1('position')}, '_', ' ') AS position,
       hire_date, leave_date, salary_per_hour, hours_per_week, employment_status,
       reason_for_leaving, performance_rating,
       {hu(months_between_e8(f'coalesce(leave_date, {AS_OF})', 'hire_date'), str(10 ** 8), 1)} AS tenure_months,
       coalesce(employment_status = 'Active', false) AS is_active,
       CAST(round({money('salary_per_hour')} * hours_per_week, 2) AS DOUBLE) AS weekly_cost_gbp
FROM employees_s""",
    "item_perf": f"""
SELECT restaurant_id, item_id, category, sub_category,
       CAST(sum(quantity) AS BIGINT) AS units_sold, count(order_detail_id) AS times_ordered,
       {sum_money('line_revenue')} AS revenue,
       {sum_money('line_margin')} AS margin,
       {avg_money('item_price_at_time')} AS avg_price,
       {pct(f"sum({cents('line_margin')})", f"sum({cents('line_revenue')})", f"sum({money('line_revenue')})")} AS margin_pct
FROM fct_order_items GROUP BY restaurant_id, item_id, category, sub_category""",
}

ORDER_CTES = ("orders_s", "details_s", "menu_s", "fct_orders", "fct_order_items")
CUSTOMER_CTES = ("customers_s", "orders_s", "customer_base")


def _delivery_measures() -> str:
    return f"""{avg_money('delivery_minutes')} AS avg_delivery_mins,
       {avg_money('distance_miles')} AS avg_distance_miles,
       CAST(sum(CASE WHEN is_on_time THEN 1 ELSE 0 END) AS BIGINT) AS on_time_count,
       CAST(sum(CASE WHEN is_delayed THEN 1 ELSE 0 END) AS BIGINT) AS delayed_count,
       CAST(sum(CASE WHEN is_cancelled THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_count"""


ORACLE: dict[str, str] = {}

ORACLE["dim_date"] = with_("orders_s") + """
SELECT d AS date, """ + date_key("d") + """ AS date_key,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, strftime(d, '%b') AS month_short,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, strftime(d, '%a') AS day_short,
       dayofweek(d) IN (0, 6) AS is_weekend,
       (month(d) = 12 AND day(d) IN (25, 26, 31)) OR (month(d) = 1 AND day(d) = 1)
         OR (month(d) = 4 AND day(d) IN (1, 7, 8, 25)) OR (month(d) = 5 AND day(d) IN (1, 6, 8, 26, 27)) AS is_holiday,
       """ + ym("d") + """ AS year_month,
       CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter
FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders_s)"""

ORACLE["dim_restaurant"] = with_("restaurants_s") + f"""
SELECT restaurant_id AS restaurant_key, restaurant_id, restaurant_name, address, postcode,
       upper(area) AS area, opening_date, CAST(seating_capacity AS INTEGER) AS seating_capacity,
       CAST(delivery_radius_miles AS INTEGER) AS delivery_radius_miles, phone_number,
       {hu(months_between_e8(AS_OF, 'opening_date'), str(12 * 10 ** 8), 1)} AS years_in_operation,
       CASE WHEN seating_capacity < 60 THEN 'Small' WHEN seating_capacity < 80 THEN 'Medium' ELSE 'Large' END AS size_band
FROM restaurants_s"""

ORACLE["customer_order_summary"] = with_("orders_s") + f"""
SELECT customer_id, count(order_id) AS orders_cnt,
       {sum_money('total_amount')} AS total_spent,
       {avg_money('total_amount')} AS avg_spent,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date
FROM orders_s WHERE order_status = 'Completed' GROUP BY customer_id"""

ORACLE["customer_recency"] = with_(*CUSTOMER_CTES) + """
SELECT customer_id, join_date, last_order_date, recency_days FROM customer_base"""

ORACLE["rfm_scores"] = with_(*CUSTOMER_CTES, "rfm") + """
SELECT customer_id, recency_days, r_score, f_score, m_score FROM rfm"""

ORACLE["rfm_scores_high_is_best"] = with_(*CUSTOMER_CTES, "rfm_high") + """
SELECT customer_id, recency_days, r_score, f_score, m_score FROM rfm_high"""

ORACLE["rfm_segments"] = with_(*CUSTOMER_CTES, "rfm") + """
SELECT customer_id,
       CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champion'
            WHEN r_score >= 3 AND f_score >= 4 THEN 'Loyal'
            WHEN r_score >= 4 AND f_score <= 2 THEN 'New / Promising'
            WHEN r_score <= 2 AND f_score >= 4 THEN 'At Risk'
            WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost'
            ELSE 'Need Attention' END AS rfm_segment
FROM rfm"""

ORACLE["customer_ltv"] = with_(*CUSTOMER_CTES) + f"""
SELECT customer_id, CAST(coalesce(orders_cnt, 0) AS INTEGER) AS total_orders,
       coalesce(CAST(round(total_spent_dec, 2) AS DOUBLE), 0.0) AS total_spent,
       coalesce({hu('total_spent_dec * 10000', 'amount_cnt * 10000', 2)}, 0.0) AS avg_order_value_actual,
       {lifetime_value()} AS customer_lifetime_value
FROM customer_base"""

ORACLE["dim_customer"] = with_(*CUSTOMER_CTES, "rfm", "dim_customer") + "SELECT * FROM dim_customer"

ORACLE["dim_menu_item"] = with_("menu_s", "dim_menu_item") + "SELECT * FROM dim_menu_item"

ORACLE["dim_employee"] = with_("employees_s", "dim_employee") + "SELECT * FROM dim_employee"

ORACLE["fct_orders"] = with_("orders_s", "details_s", "fct_orders") + "SELECT * FROM fct_orders"

ORACLE["fct_order_items"] = with_(*ORDER_CTES) + "SELECT * FROM fct_order_items"

ORACLE["fct_delivery"] = with_("delivery_s", "fct_delivery") + "SELECT * FROM fct_delivery"

ORACLE["fct_inventory_daily"] = with_("inventory_s", "fct_inventory_daily") + "SELECT * FROM fct_inventory_daily"

ORACLE["fct_daily_ops"] = with_("daily_s", "fct_daily_ops") + "SELECT * FROM fct_daily_ops"

ORACLE["agg_revenue_monthly"] = with_(*ORDER_CTES) + f"""
SELECT o.year, o.month, o.year_month, count(o.order_id) AS total_orders,
       count(DISTINCT o.customer_id) AS unique_customers,
       {sum_money('o.total_amount')} AS revenue,
       {avg_money('o.total_amount')} AS aov,
       CAST(sum(i.order_margin) AS DOUBLE) AS gross_margin,
       CAST(sum(i.order_cost) AS DOUBLE) AS total_cogs,
       CAST(sum(o.total_quantity) AS BIGINT) AS items_sold,
       {pct('sum(i.order_margin) * 100', f"{sum2('o.total_amount')} * 100", sum2('o.total_amount'))} AS gross_margin_pct
FROM fct_orders o LEFT JOIN (
    SELECT order_id, sum({money('line_margin')}) AS order_margin, sum({money('line_cost')}) AS order_cost
    FROM fct_order_items GROUP BY order_id) i ON o.order_id = i.order_id
WHERE o.is_completed
GROUP BY o.year, o.month, o.year_month
ORDER BY o.year, o.month"""

ORACLE["agg_revenue_by_category"] = with_(*ORDER_CTES) + f"""
SELECT category, sub_category,
       {sum_money('line_revenue')} AS revenue,
       {sum_money('line_cost')} AS cost,
       {sum_money('line_margin')} AS margin,
       CAST(sum(quantity) AS BIGINT) AS units_sold, count(order_detail_id) AS line_items,
       {pct(f"sum({cents('line_margin')})", f"sum({cents('line_revenue')})", f"sum({money('line_revenue')})")} AS margin_pct
FROM fct_order_items GROUP BY category, sub_category"""

_RESTAURANT_MARGIN = f"""
SELECT restaurant_id, sum(order_margin) AS gm FROM (
    SELECT restaurant_id, order_id, sum({money('line_margin')}) AS order_margin
    FROM fct_order_items GROUP BY restaurant_id, order_id) GROUP BY restaurant_id"""

ORACLE["two_level_margin"] = with_(*ORDER_CTES) + f"""
SELECT restaurant_id, CAST(gm AS DOUBLE) AS gross_margin FROM ({_RESTAURANT_MARGIN})"""

ORACLE["agg_restaurant_performance"] = with_(*ORDER_CTES) + f"""
SELECT k.restaurant_id, k.total_orders, CAST(k.rev AS DOUBLE) AS revenue, k.aov, k.unique_customers,
       k.delivery_orders, k.eat_in_orders, k.avg_rating, CAST(m.gm AS DOUBLE) AS gross_margin,
       {pct('k.delivery_orders', 'k.total_orders', 'k.total_orders')} AS delivery_share_pct,
       {pct('m.gm * 100', 'k.rev * 100', 'k.rev')} AS gross_margin_pct
FROM (
    SELECT restaurant_id, count(order_id) AS total_orders, {sum2('total_amount')} AS rev,
           {avg_money('total_amount')} AS aov, count(DISTINCT customer_id) AS unique_customers,
           CAST(sum(CASE WHEN is_delivery THEN 1 ELSE 0 END) AS BIGINT) AS delivery_orders,
           CAST(sum(CASE WHEN is_eat_in THEN 1 ELSE 0 END) AS BIGINT) AS eat_in_orders,
           {avg_int('CASE WHEN is_completed THEN customer_rating END', 2)} AS avg_rating
    FROM fct_orders GROUP BY restaurant_id) k
LEFT JOIN ({_RESTAURANT_MARGIN}) m ON k.restaurant_id = m.restaurant_id"""

ORACLE["agg_hourly_demand"] = with_("orders_s", "details_s", "fct_orders") + f"""
SELECT day_of_week, hour_of_day, count(order_id) AS orders,
       {sum_money('total_amount')} AS revenue, {avg_money('total_amount')} AS aov
FROM fct_orders WHERE is_completed GROUP BY day_of_week, hour_of_day"""

ORACLE["hourly_activity_events"] = f"""
SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour_of_day,
       count(*) AS events, {hu(f"sum({units('value')})", '10000', 2)} AS total_value,
       {avg_money('value')} AS avg_value
FROM events GROUP BY 1, 2"""

ORACLE["agg_customer_cohorts"] = with_("customers_s", "orders_s", "details_s", "fct_orders") + f"""
SELECT cohort_month, order_month, active_customers,
       CAST((CAST(substr(order_month, 1, 4) AS INTEGER) - CAST(substr(cohort_month, 1, 4) AS INTEGER)) * 12
          + (CAST(substr(order_month, 6, 2) AS INTEGER) - CAST(substr(cohort_month, 6, 2) AS INTEGER)) AS INTEGER) AS months_since_join
FROM (
    SELECT {ym('c.join_date')} AS cohort_month, {ym('o.order_date')} AS order_month,
           count(DISTINCT c.customer_id) AS active_customers
    FROM customers_s c JOIN fct_orders o ON c.customer_id = o.customer_id
    WHERE o.is_completed GROUP BY 1, 2)"""

ORACLE["agg_customer_lifetime"] = with_(*CUSTOMER_CTES, "rfm", "dim_customer") + f"""
SELECT customer_segment, rfm_segment, count(customer_id) AS customers,
       {avg_int('total_orders', 2)} AS avg_orders,
       {avg_money('total_spent')} AS avg_spend,
       {avg_money('customer_lifetime_value')} AS avg_clv,
       {sum_money('customer_lifetime_value')} AS total_clv,
       {avg_int('recency_days', 1)} AS avg_recency_days
FROM dim_customer GROUP BY customer_segment, rfm_segment"""

ORACLE["agg_item_performance"] = with_(*ORDER_CTES, "item_perf") + "SELECT * FROM item_perf"

ORACLE["agg_menu_engineering"] = with_(*ORDER_CTES, "item_perf", "dim_menu_item") + """,
perf AS (
    SELECT p.*, d.item_name, d.price, d.cost_to_make, d.gross_margin_gbp, d.gross_margin_pct
    FROM item_perf p LEFT JOIN dim_menu_item d
    ON p.item_id = d.item_id AND p.restaurant_id = d.restaurant_id),
med AS (
    SELECT restaurant_id, quantile_disc(CAST(units_sold AS DOUBLE), 0.5) AS med_units,
           quantile_disc(margin_pct, 0.5) AS med_margin_pct
    FROM perf GROUP BY restaurant_id),
lab AS (
    SELECT p.*, m.med_units, m.med_margin_pct,
           CASE WHEN p.units_sold >= m.med_units THEN 'High' ELSE 'Low' END AS popularity,
           CASE WHEN p.margin_pct >= m.med_margin_pct THEN 'High' ELSE 'Low' END AS profitability
    FROM perf p LEFT JOIN med m ON p.restaurant_id = m.restaurant_id)
SELECT *, CASE WHEN popularity = 'High' AND profitability = 'High' THEN 'Star'
               WHEN popularity = 'Low' AND profitability = 'High' THEN 'Puzzle'
               WHEN popularity = 'High' AND profitability = 'Low' THEN 'Plowhorse'
               ELSE 'Dog' END AS classification
FROM lab"""

ORACLE["agg_ops_costs"] = with_("daily_s", "fct_daily_ops") + f"""
SELECT restaurant_id, year_month,
       {sum_money('electricity_cost')} AS electricity,
       {sum_money('water_cost')} AS water,
       {sum_money('gas_cost')} AS gas,
       {sum_money('maintenance_cost')} AS maintenance,
       {sum_money('other_bills_cost')} AS other,
       {sum_money('total_operating_cost')} AS total_cost,
       {sum_money('daily_revenue')} AS revenue,
       {avg_int('average_wait_time_mins', 1)} AS avg_wait_time_mins,
       {avg_int('staff_on_shift', 1)} AS avg_staff_on_shift,
       {pct(f"sum({cents('total_operating_cost')})", f"{sum2('daily_revenue')} * 100", sum2('daily_revenue'))} AS cost_to_revenue_pct
FROM fct_daily_ops GROUP BY restaurant_id, year_month"""

ORACLE["agg_staffing_efficiency"] = with_("employees_s", "dim_employee") + f"""
SELECT restaurant_id, position, count(employee_id) AS headcount,
       CAST(sum(CASE WHEN is_active THEN 1 ELSE 0 END) AS BIGINT) AS active_headcount,
       CAST(sum(CASE WHEN is_active = false THEN 1 ELSE 0 END) AS BIGINT) AS left_headcount,
       {avg_money('salary_per_hour')} AS avg_hourly_rate,
       {avg_int('hours_per_week', 1)} AS avg_hours_per_week,
       {avg_money('performance_rating')} AS avg_rating,
       {hu('sum(CAST(round_even(tenure_months * 10, 0) AS BIGINT))', 'count(tenure_months) * 10', 1)} AS avg_tenure_months,
       {sum_money('weekly_cost_gbp')} AS weekly_payroll,
       {pct('sum(CASE WHEN is_active = false THEN 1 ELSE 0 END)', 'count(employee_id)', 'count(employee_id)')} AS turnover_pct
FROM dim_employee GROUP BY restaurant_id, position"""

ORACLE["agg_delivery_by_condition"] = with_("delivery_s", "fct_delivery") + f"""
SELECT traffic_condition, weather_condition, count(delivery_id) AS deliveries,
       {_delivery_measures()},
       {pct('sum(CASE WHEN is_on_time THEN 1 ELSE 0 END)', 'count(delivery_id)', 'count(delivery_id)')} AS on_time_pct
FROM fct_delivery GROUP BY traffic_condition, weather_condition"""

ORACLE["agg_driver_performance"] = with_("delivery_s", "fct_delivery") + f"""
SELECT driver_id, count(delivery_id) AS trips,
       {_delivery_measures()},
       {pct('sum(CASE WHEN is_on_time THEN 1 ELSE 0 END)', 'count(delivery_id)', 'count(delivery_id)')} AS on_time_pct
FROM fct_delivery GROUP BY driver_id"""


# -------------------------------------------------------------------- silver

def dirty_sql(base: str, key: str, strings, numerics, raw_customer: bool = False) -> str:
    rep = []
    for i, c in enumerate([*strings, *numerics]):
        k = f"({key} + {3 * i})"  # each column's defects fall on other rows
        if c in strings:
            rep.append(f"CASE WHEN {k} % 23 = 0 THEN NULL WHEN {k} % 5 = 0 THEN '  ' || {c} || ' ' "
                       f"WHEN {k} % 7 = 0 THEN lower({c}) ELSE {c} END AS {c}")
        else:
            rep.append(f"CASE WHEN {k} % 23 = 0 THEN NULL WHEN {k} % 19 = 0 THEN -{c} ELSE {c} END AS {c}")
    if raw_customer:
        rep.append(f"CASE WHEN {key} % 97 = 0 THEN NULL WHEN {key} % 101 = 0 "
                   f"THEN CAST(customer_id AS DOUBLE) + 0.5 ELSE CAST(customer_id AS DOUBLE) END AS customer_id")
    replace = f" REPLACE ({', '.join(rep)})" if rep else ""
    return (f"SELECT *{replace}, CASE WHEN {key} % 29 = 0 THEN 'k:' || CAST({key} AS VARCHAR) END "
            f"AS _rescued_data FROM {base}")


# (adapter CTE, key, dirty strings, dirty numerics) of each raw table
RAW = {
    "restaurants": ("restaurants_s", "restaurant_id",
                    ["restaurant_name", "address", "postcode", "area", "phone_number"], ["seating_capacity"]),
    "customers": ("customers_s", "customer_id",
                  ["first_name", "last_name", "email", "phone", "postcode", "customer_segment",
                   "preferred_category", "preferred_order_type"], ["avg_order_value"]),
    "employees": ("employees_s", "employee_id",
                  ["first_name", "last_name", "position", "reason_for_leaving", "employment_status"],
                  ["salary_per_hour", "performance_rating"]),
    "menu_items": ("menu_s", "item_id", ["item_name", "category", "sub_category"],
                   ["preparation_time_mins", "cost_to_make", "price"]),
    "orders": ("orders_s", "order_id",
               ["customer_name", "delivery_postcode", "order_type", "payment_method", "order_status"],
               ["total_amount", "delivery_time_mins", "delivery_distance_miles"]),
    "order_details": ("details_s", "order_detail_id", ["special_instructions"], ["item_price_at_time"]),
    "customer_reviews": ("reviews_s", "review_id", ["review_text", "category"], ["rating", "sentiment_score"]),
    "daily_operations": ("daily_dup", "operation_id", [],
                         ["total_customers_eat_in", "total_customers_delivery", "total_orders",
                          "delivery_orders_count", "eat_in_orders_count", "daily_revenue", "staff_on_shift"]),
    "delivery_performance": ("delivery_s", "delivery_id",
                             ["traffic_condition", "weather_condition", "delivery_status"], ["distance_miles"]),
    "inventory": ("inventory_s", "inventory_id", [], ["stock_value", "waste_value", "closing_stock",
                                                      "opening_stock"]),
}

GOLD_CTES["daily_dup"] = """
SELECT * FROM daily_s UNION ALL
SELECT * REPLACE (daily_revenue + 1.0 AS daily_revenue) FROM daily_s WHERE operation_id % 10 = 0"""


def raw_ctes(table: str) -> list[tuple[str, str]]:
    """Adapter CTE(s) plus ``raw_<table>`` holding the dirty raw form."""
    base, key, strings, numerics = RAW[table]
    ctes = [(base, ADAPTERS.get(base) or GOLD_CTES[base])]
    if base == "daily_dup":
        ctes.insert(0, ("daily_s", ADAPTERS["daily_s"]))
    ctes.append((f"raw_{table}", dirty_sql(base, key, strings, numerics,
                                           raw_customer=table in ("orders", "customer_reviews"))))
    return ctes


def _with(ctes: list[tuple[str, str]]) -> str:
    seen, parts = set(), []
    for n, b in ctes:
        if n not in seen:
            seen.add(n)
            parts.append(f"{n} AS ({b})")
    return "WITH " + ",\n".join(parts) + "\n"


def cap_sql(src: str, columns, factor: str = "1.5", prefix: str = "") -> tuple[list[tuple[str, str]], str]:
    """CTEs computing exact-quartile bounds over ``src`` and the clamp select."""
    qs = ", ".join(
        f"quantile_disc(CAST({c} AS DOUBLE), 0.25) AS q1_{c}, quantile_disc(CAST({c} AS DOUBLE), 0.75) AS q3_{c}"
        for c in columns)
    bs = ", ".join(
        f"q1_{c} - CAST({factor} AS DOUBLE) * (q3_{c} - q1_{c}) AS lo_{c}, "
        f"q3_{c} + CAST({factor} AS DOUBLE) * (q3_{c} - q1_{c}) AS hi_{c}"
        for c in columns)
    ctes = [(f"{prefix}qt", f"SELECT {qs} FROM {src}"), (f"{prefix}bnd", f"SELECT {bs} FROM {prefix}qt")]
    rep = ", ".join(
        f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE CAST({c} AS DOUBLE) END AS {c}"
        for c in columns)
    return ctes, f"SELECT {src}.* REPLACE ({rep}) FROM {src}, {prefix}bnd"


def clean_ctes(table: str, trims=(), fills: dict | None = None, caps=(), cast_customer: bool = False,
               dedup: list[str] | None = None, order: list[str] | None = None) -> list[tuple[str, str]]:
    """raw CTEs followed by the cleaning chain, ending in ``clean_<table>``."""
    p = f"{table}_"
    ctes = raw_ctes(table)
    rep = [f"trim({c}) AS {c}" for c in trims]
    if cast_customer:
        rep.append("CAST(trunc(customer_id) AS BIGINT) AS customer_id")
    sel = ("SELECT * EXCLUDE (_rescued_data)" + (f" REPLACE ({', '.join(rep)})" if rep else "")
           + f" FROM raw_{table}")
    ctes.append((f"{p}t1", sel))
    if fills:
        ctes.append((f"{p}t2", "SELECT * REPLACE (" + ", ".join(
            f"coalesce({c}, {v}) AS {c}" for c, v in fills.items()) + f") FROM {p}t1"))
    else:
        ctes.append((f"{p}t2", f"SELECT * FROM {p}t1"))
    if dedup:
        ob = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
        ctes.append((f"{p}t3", f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
                               f"(PARTITION BY {', '.join(dedup)} ORDER BY {ob}) AS _rn FROM {p}t2) WHERE _rn = 1"))
    else:
        ctes.append((f"{p}t3", f"SELECT * FROM {p}t2"))
    if not caps:
        ctes.append((f"clean_{table}", f"SELECT * FROM {p}t3"))
        return ctes
    more, final = cap_sql(f"{p}t3", caps, prefix=p)
    return ctes + more + [(f"clean_{table}", final)]


DAILY_ORDER = ["operation_id", "total_customers_eat_in", "total_customers_delivery", "total_orders",
               "delivery_orders_count", "eat_in_orders_count", "average_wait_time_mins", "staff_on_shift",
               "electricity_cost", "water_cost", "gas_cost", "maintenance_cost", "other_bills_cost",
               "daily_revenue"]

CLEAN_SPEC = {
    "restaurants": dict(trims=["restaurant_name", "address", "postcode", "area", "phone_number"]),
    "customers": dict(trims=["first_name", "last_name", "email", "phone", "postcode"],
                      fills={"email": "'Unknown'", "phone": "'Unknown'"}, caps=["avg_order_value"]),
    "employees": dict(trims=["first_name", "last_name", "position", "reason_for_leaving"],
                      fills={"performance_rating": "0.0::DOUBLE", "reason_for_leaving": "'N/A'"},
                      caps=["salary_per_hour", "performance_rating"]),
    "menu_items": dict(trims=["item_name", "category", "sub_category"], fills={"sub_category": "'N/A'"},
                       caps=["preparation_time_mins", "cost_to_make"]),
    "orders": dict(trims=["customer_name", "delivery_postcode", "order_type", "payment_method", "order_status"],
                   fills={"customer_rating": "0", "customer_name": "'N/A'"},
                   caps=["total_amount", "delivery_time_mins", "delivery_distance_miles"], cast_customer=True),
    "order_details": dict(trims=["special_instructions"], caps=["item_price_at_time"]),
    "customer_reviews": dict(trims=["review_text", "category"],
                             fills={"review_text": "'No review provided'", "rating": "0.0::DOUBLE",
                                    "sentiment_score": "0.0::DOUBLE"},
                             caps=["sentiment_score"], cast_customer=True),
    "daily_operations": dict(dedup=["restaurant_id", "date"], order=DAILY_ORDER,
                             caps=["total_customers_eat_in", "total_customers_delivery", "total_orders",
                                   "delivery_orders_count", "eat_in_orders_count"]),
    "delivery_performance": dict(trims=["traffic_condition", "weather_condition", "delivery_status"],
                                 caps=["distance_miles"]),
    "inventory": dict(fills={"waste_stock": "0", "waste_value": "0.0::DOUBLE"},
                      caps=["stock_value", "waste_value", "closing_stock"]),
}

CLEAN_NAMES = {
    "restaurants": "clean_restaurants", "customers": "clean_customers", "employees": "clean_employees",
    "menu_items": "clean_menu_items", "orders": "clean_orders", "order_details": "clean_order_details",
    "customer_reviews": "clean_reviews", "daily_operations": "clean_daily_ops",
    "delivery_performance": "clean_delivery", "inventory": "clean_inventory",
}

for _t, _q in CLEAN_NAMES.items():
    ORACLE[_q] = _with(clean_ctes(_t, **CLEAN_SPEC[_t])) + f"SELECT * FROM clean_{_t}"

_cap1 = cap_sql("events", ["value"])
ORACLE["cap_outliers_iqr"] = _with(_cap1[0]) + _cap1[1]
_cap2 = cap_sql("events", ["value", "user_id"])
ORACLE["cap_outliers_multi"] = _with(_cap2[0]) + _cap2[1]

ORACLE["dedup_by_key"] = """
SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus, l_shipdate) AS _rn
    FROM lineitem) WHERE _rn = 1"""
