"""SQL oracles (DuckDB) for the audit and reconciliation queries."""

from __future__ import annotations

import re

from .oracle import ADAPTERS, CLEAN_SPEC, ORACLE, _with, clean_ctes, hu, raw_ctes

# raw ("bronze") table schemas: (column, type) in table order
RAW_SCHEMA = {
    "restaurants": [("restaurant_id", "int"), ("restaurant_name", "string"), ("address", "string"),
                    ("postcode", "string"), ("area", "string"), ("opening_date", "date"),
                    ("seating_capacity", "int"), ("delivery_radius_miles", "int"), ("phone_number", "string"),
                    ("_rescued_data", "string")],
    "customers": [("customer_id", "bigint"), ("first_name", "string"), ("last_name", "string"),
                  ("email", "string"), ("phone", "string"), ("postcode", "string"), ("join_date", "date"),
                  ("customer_segment", "string"), ("preferred_category", "string"),
                  ("preferred_order_type", "string"), ("avg_order_value", "double"), ("is_active", "boolean"),
                  ("_rescued_data", "string")],
    "employees": [("employee_id", "bigint"), ("restaurant_id", "int"), ("first_name", "string"),
                  ("last_name", "string"), ("position", "string"), ("hire_date", "date"), ("leave_date", "date"),
                  ("employment_status", "string"), ("salary_per_hour", "double"), ("hours_per_week", "int"),
                  ("reason_for_leaving", "string"), ("performance_rating", "double"), ("_rescued_data", "string")],
    "menu_items": [("item_id", "bigint"), ("restaurant_id", "int"), ("item_name", "string"),
                   ("category", "string"), ("sub_category", "string"), ("price", "double"),
                   ("cost_to_make", "double"), ("preparation_time_mins", "int"), ("is_vegetarian", "boolean"),
                   ("is_vegan", "boolean"), ("is_gluten_free", "boolean"), ("calories", "int"),
                   ("_rescued_data", "string")],
    "orders": [("order_id", "bigint"), ("restaurant_id", "int"), ("customer_id", "double"),
               ("customer_name", "string"), ("order_date", "date"), ("order_time", "timestamp_ntz"),
               ("order_type", "string"), ("payment_method", "string"), ("order_status", "string"),
               ("delivery_postcode", "string"), ("delivery_distance_miles", "double"),
               ("delivery_time_mins", "int"), ("total_amount", "double"), ("customer_rating", "int"),
               ("_rescued_data", "string")],
    "order_details": [("order_detail_id", "bigint"), ("order_id", "bigint"), ("item_id", "bigint"),
                      ("quantity", "int"), ("item_price_at_time", "double"), ("special_instructions", "string"),
                      ("_rescued_data", "string")],
    "customer_reviews": [("review_id", "bigint"), ("customer_id", "double"), ("review_text", "string"),
                         ("category", "string"), ("rating", "double"), ("sentiment_score", "double"),
                         ("_rescued_data", "string")],
    "daily_operations": [("operation_id", "bigint"), ("restaurant_id", "int"), ("date", "date"),
                         ("total_customers_eat_in", "bigint"), ("total_customers_delivery", "bigint"),
                         ("total_orders", "bigint"), ("delivery_orders_count", "bigint"),
                         ("eat_in_orders_count", "bigint"), ("average_wait_time_mins", "bigint"),
                         ("staff_on_shift", "bigint"), ("electricity_cost", "double"), ("water_cost", "double"),
                         ("gas_cost", "double"), ("maintenance_cost", "double"), ("other_bills_cost", "double"),
                         ("daily_revenue", "double"), ("_rescued_data", "string")],
    "delivery_performance": [("delivery_id", "bigint"), ("order_id", "bigint"), ("restaurant_id", "int"),
                             ("driver_id", "bigint"), ("dispatch_time", "timestamp_ntz"),
                             ("delivery_time", "timestamp_ntz"), ("distance_miles", "double"),
                             ("traffic_condition", "string"), ("weather_condition", "string"),
                             ("delivery_status", "string"), ("_rescued_data", "string")],
    "inventory": [("inventory_id", "bigint"), ("restaurant_id", "bigint"), ("date", "date"),
                  ("item_id", "bigint"), ("opening_stock", "int"), ("received_stock", "bigint"),
                  ("used_stock", "bigint"), ("waste_stock", "bigint"), ("closing_stock", "int"),
                  ("stock_value", "double"), ("waste_value", "double"), ("_rescued_data", "string")],
}
TABLE_ORDER = list(RAW_SCHEMA)
RECONCILED = TABLE_ORDER
NUMERIC = {"int", "bigint", "double"}
PKS = {
    "restaurants": ["restaurant_id"], "customers": ["customer_id"], "employees": ["employee_id"],
    "menu_items": ["item_id", "restaurant_id"], "orders": ["order_id"], "order_details": ["order_detail_id"],
    "customer_reviews": ["review_id"], "daily_operations": ["operation_id"],
    "delivery_performance": ["delivery_id"], "inventory": ["inventory_id"],
}
CATEGORICAL = {
    "customers": ["customer_segment", "preferred_category", "preferred_order_type"],
    "orders": ["order_type", "payment_method", "order_status"],
    "employees": ["position", "employment_status"],
    "menu_items": ["category", "sub_category"],
    "delivery_performance": ["traffic_condition", "weather_condition", "delivery_status"],
    "customer_reviews": ["category"],
}
NEGATIVE = {
    "orders": ["total_amount", "delivery_distance_miles", "delivery_time_mins"],
    "menu_items": ["price", "cost_to_make"],
    "daily_operations": ["daily_revenue", "total_customers_eat_in", "total_customers_delivery", "staff_on_shift"],
    "inventory": ["opening_stock", "closing_stock", "stock_value"],
    "customer_reviews": ["rating", "sentiment_score"],
    "employees": ["salary_per_hour", "performance_rating"],
}
# cleaned-table types that differ from the raw ones
CLEAN_TYPE_CHANGES = {
    "customers": {"avg_order_value": "double"},
    "orders": {"customer_id": "bigint", "delivery_time_mins": "double", "total_amount": "double",
               "delivery_distance_miles": "double"},
    "customer_reviews": {"customer_id": "bigint", "sentiment_score": "double"},
    "daily_operations": {c: "double" for c in ["total_customers_eat_in", "total_customers_delivery",
                                               "total_orders", "delivery_orders_count", "eat_in_orders_count"]},
    "menu_items": {"preparation_time_mins": "double"},
    "inventory": {"closing_stock": "double"},
}
DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def q(c: str) -> str:
    return f'"{c}"'


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


def spark_round(x: str, k: int) -> str:
    """Spark's round() on a double: HALF_UP on its shortest decimal form (0.07499999999999996 gives 0.07)."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {k}) AS DOUBLE)"


def all_raw() -> list[tuple[str, str]]:
    out = []
    for t in TABLE_ORDER:
        out += raw_ctes(t)
    return out


def cols_of(t: str, with_rescue: bool = True):
    return [(c, ty) for c, ty in RAW_SCHEMA[t] if with_rescue or c != "_rescued_data"]


def clean_type(t: str, c: str, raw_type: str) -> str:
    return CLEAN_TYPE_CHANGES.get(t, {}).get(c, raw_type)


# ------------------------------------------------------------------ overview

ORACLE["audit_overview"] = _with(all_raw()) + union([
    f"SELECT '{t}' AS {q('table')}, count(*) AS rows, CAST({len(RAW_SCHEMA[t])} AS INTEGER) AS cols FROM raw_{t}"
    for t in TABLE_ORDER])


def _null_parts(t: str, src: str, cols) -> list[str]:
    parts = []
    for c, ty in cols:
        test = f"{q(c)} IS NULL" + (f" OR isnan({q(c)})" if ty == "double" else "")
        parts.append(
            f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, null_count, "
            f"(CASE WHEN total > 0 THEN {hu('null_count * 100', 'total', 2)} ELSE 0.0 END) AS null_pct "
            f"FROM (SELECT count(*) FILTER (WHERE {test}) AS null_count, count(*) AS total FROM {src}) "
            f"WHERE null_count > 0")
    return parts


ORACLE["audit_nulls"] = _with(all_raw()) + union(
    [p for t in TABLE_ORDER for p in _null_parts(t, f"raw_{t}", cols_of(t))])


# ------------------------------------------------------------------ duplicates

def _dup_part(t: str, src: str | None = None, pk: list[str] | None = None) -> str:
    src, pk = src or f"raw_{t}", pk or PKS[t]
    pk_sql = ", ".join(q(c) for c in pk)
    return (
        f"SELECT '{t}' AS {q('table')}, a.n AS total_rows, a.n - b.n AS dup_rows, "
        f"(CASE WHEN a.n > 0 THEN {hu('(a.n - b.n) * 100', 'a.n', 2)} ELSE 0.0 END) AS dup_pct, "
        f"'{', '.join(pk)}' AS primary_key, a.n - c.n AS pk_dups "
        f"FROM (SELECT count(*) AS n FROM {src}) a, (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM {src})) b, "
        f"(SELECT count(*) AS n FROM (SELECT DISTINCT {pk_sql} FROM {src})) c")


ORACLE["audit_duplicates"] = _with(all_raw()) + union([_dup_part(t) for t in TABLE_ORDER])

ORACLE["audit_duplicate_rows"] = f"""
SELECT a.n AS total_rows, b.n AS distinct_rows, a.n - b.n AS dup_rows,
       (CASE WHEN a.n > 0 THEN {hu('(a.n - b.n) * 100', 'a.n', 2)} ELSE 0.0 END) AS dup_pct
FROM (SELECT count(*) AS n FROM lineitem) a, (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM lineitem)) b"""

ORACLE["audit_pk_violations"] = """
SELECT a.n AS pk_total, b.n AS pk_distinct, a.n - b.n AS pk_dups
FROM (SELECT count(*) AS n FROM lineitem) a,
     (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) b"""


# -------------------------------------------------------------------- outliers

def _outlier_part(t: str, cols: list[str], src: str | None = None) -> str:
    src = src or t
    stacked = union([f"SELECT '{c}' AS {q('column')}, CAST({q(c)} AS DOUBLE) AS value FROM {src}" for c in cols])
    return f"""
WITH s AS ({stacked}),
d AS (SELECT {q('column')}, count(*) AS nd FROM (SELECT DISTINCT {q('column')}, value FROM s) GROUP BY 1),
qq AS (SELECT {q('column')}, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM s GROUP BY 1),
b AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM qq),
c AS (SELECT s.{q('column')}, count(*) FILTER (WHERE s.value < b.lo OR s.value > b.hi) AS oc
      FROM s JOIN b ON s.{q('column')} = b.{q('column')} GROUP BY 1),
n AS (SELECT count(*) AS total FROM {src})
SELECT '{t}' AS {q('table')}, b.{q('column')}, {spark_round('b.q1', 2)} AS q1, {spark_round('b.q3', 2)} AS q3,
       {spark_round('b.lo', 2)} AS lower_bound, {spark_round('b.hi', 2)} AS upper_bound,
       c.oc AS outlier_count,
       (CASE WHEN n.total > 0 THEN {hu('c.oc * 100', 'n.total', 2)} ELSE 0.0 END) AS outlier_pct
FROM b JOIN c ON b.{q('column')} = c.{q('column')} JOIN d ON b.{q('column')} = d.{q('column')}, n
WHERE d.nd >= 5 AND d.nd <= n.total * 0.9::DOUBLE AND c.oc > 0"""


def _numeric(t: str) -> list[str]:
    return [c for c, ty in RAW_SCHEMA[t] if ty in NUMERIC]


ORACLE["audit_outliers"] = _with(all_raw()) + union([
    f"SELECT * FROM ({_outlier_part('events', ['event_id', 'user_id', 'value'])})",
    f"SELECT * FROM ({_outlier_part('documents', ['doc_id', 'n_chars'])})",
    *[f"SELECT * FROM ({_outlier_part(t, _numeric(t), f'raw_{t}')})" for t in TABLE_ORDER],
])


# -------------------------------------------------------------- standardising

ORACLE["audit_value_counts"] = _with(all_raw()) + union([
    f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, CAST({q(c)} AS VARCHAR) AS value, count(*) AS count "
    f"FROM raw_{t} GROUP BY 3"
    for t, cs in CATEGORICAL.items() for c in cs])


def _ws_parts(t: str, src: str, cols) -> list[str]:
    return [
        f"SELECT * FROM (SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, 'Whitespace' AS issue, "
        f"count(*) FILTER (WHERE {q(c)} IS NOT NULL AND {q(c)} <> trim({q(c)})) AS ws_count FROM {src}) "
        f"WHERE ws_count > 0"
        for c, ty in cols if ty == "string"]


ORACLE["audit_whitespace"] = _with(all_raw()) + union(
    [p for t in TABLE_ORDER for p in _ws_parts(t, f"raw_{t}", cols_of(t))])

_clean_all = []
for _t in RECONCILED:
    _clean_all += clean_ctes(_t, **CLEAN_SPEC[_t])

SILVER_PKS = PKS | {"daily_operations": ["restaurant_id", "date"]}

ORACLE["audit_overview_silver"] = _with(_clean_all) + union([
    f"SELECT '{t}' AS {q('table')}, count(*) AS rows, CAST({len(RAW_SCHEMA[t]) - 1} AS INTEGER) AS cols FROM clean_{t}"
    for t in TABLE_ORDER])
ORACLE["audit_nulls_silver"] = _with(_clean_all) + union(
    [p for t in TABLE_ORDER for p in _null_parts(t, f"clean_{t}", [(c, clean_type(t, c, ty)) for c, ty in cols_of(t, False)])])
ORACLE["audit_duplicates_silver"] = _with(_clean_all) + union([_dup_part(t, f"clean_{t}", SILVER_PKS[t]) for t in TABLE_ORDER])
ORACLE["audit_outliers_silver"] = _with(_clean_all) + union(
    [f"SELECT * FROM ({_outlier_part(t, _numeric(t), f'clean_{t}')})" for t in TABLE_ORDER])
ORACLE["audit_value_counts_silver"] = _with(_clean_all) + union([
    f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, CAST({q(c)} AS VARCHAR) AS value, count(*) AS count "
    f"FROM clean_{t} GROUP BY 3"
    for t, cs in CATEGORICAL.items() for c in cs])
ORACLE["audit_negatives_silver"] = _with(_clean_all) + union([
    f"SELECT * FROM (SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, "
    f"count(*) FILTER (WHERE {q(c)} < 0) AS negative_count FROM clean_{t}) WHERE negative_count > 0"
    for t, cs in NEGATIVE.items() for c in cs])

ORACLE["audit_whitespace_silver"] = _with(_clean_all) + union(
    [p for t in RECONCILED for p in _ws_parts(t, f"clean_{t}", cols_of(t, with_rescue=False))])

ORACLE["audit_casing"] = _with(all_raw()) + union([
    f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, a.n AS distinct_values, b.n AS distinct_lower, "
    f"a.n > b.n AS inconsistent "
    f"FROM (SELECT count(*) AS n FROM (SELECT DISTINCT {q(c)} FROM raw_{t})) a, "
    f"(SELECT count(*) AS n FROM (SELECT DISTINCT lower({q(c)}) FROM raw_{t})) b"
    for t, cs in CATEGORICAL.items() for c in cs])

_INT_RE = r"^\s*[+-]?[0-9]+\s*$"
_TYPE_CHECKS = [
    ("orders", "raw_orders", "customer_id", "double", "int",
     "customer_id IS NOT NULL AND customer_id <> floor(customer_id)"),
    ("customer_reviews", "raw_customer_reviews", "customer_id", "double", "int",
     "customer_id IS NOT NULL AND customer_id <> floor(customer_id)"),
    ("events", "events", "props", "string", "int", f"props IS NOT NULL AND NOT regexp_matches(props, '{_INT_RE}')"),
    ("events", "events", "value", "double", "double", "false"),
    ("part", "part", "p_size", "int", "int", "false"),
    ("part", "part", "p_brand", "string", "int", f"p_brand IS NOT NULL AND NOT regexp_matches(p_brand, '{_INT_RE}')"),
]
ORACLE["audit_types"] = _with(raw_ctes("orders") + raw_ctes("customer_reviews")) + union([
    f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, '{a}' AS actual_type, '{e}' AS expected_type, "
    f"count(*) FILTER (WHERE {cond}) AS nonconforming_rows FROM {src}"
    for t, src, c, a, e, cond in _TYPE_CHECKS])

ORACLE["audit_negatives"] = _with(all_raw()) + union([
    f"SELECT * FROM (SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, "
    f"count(*) FILTER (WHERE {q(c)} < 0) AS negative_count FROM raw_{t}) WHERE negative_count > 0"
    for t, cs in NEGATIVE.items() for c in cs])


# -------------------------------------------------------------- reconciliation

ORACLE["reconcile_rows"] = _with(_clean_all) + union([
    f"SELECT '{t}' AS {q('table')}, a.n AS left_rows, b.n AS right_rows, b.n - a.n AS row_diff, "
    f"CAST({len(RAW_SCHEMA[t])} AS INTEGER) AS left_cols, CAST({len(RAW_SCHEMA[t]) - 1} AS INTEGER) AS right_cols, "
    f"'none' AS extra_cols, '_rescued_data' AS missing_cols "
    f"FROM (SELECT count(*) AS n FROM raw_{t}) a, (SELECT count(*) AS n FROM clean_{t}) b"
    for t in RECONCILED])


def _type_parts():
    parts = []
    for t in RECONCILED:
        for c, lt in cols_of(t, with_rescue=False):
            rt = clean_type(t, c, lt)
            if rt == lt:
                continue
            back = f"CAST(TRY_CAST({q(c)} AS {DUCK_TYPE[rt]}) AS {DUCK_TYPE[lt]})"
            parts.append(
                f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, '{lt}' AS left_type, '{rt}' AS right_type, "
                f"count(*) FILTER (WHERE {q(c)} IS NOT NULL AND ({back} IS NULL OR {back} <> {q(c)})) "
                f"AS nonconforming_rows FROM raw_{t}")
    return parts


ORACLE["reconcile_types"] = _with(_clean_all) + union(_type_parts())


def _profile_parts():
    parts = []
    for t in RECONCILED:
        for c, lt in cols_of(t, with_rescue=False):
            rt = clean_type(t, c, lt)
            num = lt in NUMERIC and rt in NUMERIC

            def side(src):
                lo = f"min(CAST({q(c)} AS DOUBLE))" if num else "CAST(NULL AS DOUBLE)"
                hi = f"max(CAST({q(c)} AS DOUBLE))" if num else "CAST(NULL AS DOUBLE)"
                return f"(SELECT count(*) FILTER (WHERE {q(c)} IS NULL) AS n, {lo} AS lo, {hi} AS hi FROM {src})"
            parts.append(
                f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, l.n AS left_nulls, r.n AS right_nulls, "
                f"l.lo AS left_min, r.lo AS right_min, l.hi AS left_max, r.hi AS right_max "
                f"FROM {side('raw_' + t)} l, {side('clean_' + t)} r "
                f"WHERE l.n <> r.n OR l.lo IS DISTINCT FROM r.lo OR l.hi IS DISTINCT FROM r.hi")
    return parts


ORACLE["reconcile_profile"] = _with(_clean_all) + union(_profile_parts())


def _distinct_parts():
    parts = []
    for t in RECONCILED:
        for c, lt in cols_of(t, with_rescue=False):
            rt = clean_type(t, c, lt)
            lv = f"{q(c)} + 0.0" if lt == "double" else q(c)
            rv = f"{q(c)} + 0.0" if rt == "double" else q(c)
            parts.append(
                f"SELECT * FROM (SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, "
                f"(SELECT count(*) FROM (SELECT DISTINCT {lv} FROM raw_{t})) AS left_distinct, "
                f"(SELECT count(*) FROM (SELECT DISTINCT {rv} FROM clean_{t})) AS right_distinct) "
                f"WHERE left_distinct <> right_distinct")
    return parts


ORACLE["reconcile_distinct"] = _with(_clean_all) + union(_distinct_parts())

ORACLE["layer_row_delta"] = _with(_clean_all) + union([
    f"SELECT '{t}' AS {q('table')}, a.n AS bronze_rows, b.n AS silver_rows, a.n - b.n AS rows_removed, "
    f"(CASE WHEN a.n > 0 THEN {hu('(a.n - b.n) * 100', 'a.n', 2)} ELSE 0.0 END) AS removed_pct "
    f"FROM (SELECT count(*) AS n FROM raw_{t}) a, (SELECT count(*) AS n FROM clean_{t}) b"
    for t in RECONCILED])


# ------------------------------------------------------------------- profiles

def _profile_numeric(t: str, cols: list[str]) -> list[str]:
    return [
        f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, count({c}) AS count, "
        f"{spark_round(f'avg(CAST({c} AS DOUBLE))', 6)} AS mean, "
        f"{spark_round(f'stddev_samp(CAST({c} AS DOUBLE))', 6)} AS stddev, "
        f"min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max FROM {t}"
        for c in cols]


ORACLE["profile_numeric"] = union(
    _profile_numeric("part", ["p_partkey", "p_size", "p_retailprice"])
    + _profile_numeric("orders", ["o_orderkey", "o_custkey", "o_totalprice"]))

ORACLE["sample_rows"] = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 3"


# ------------------------------------------------------- sources and sinks

from .oracle import ORDER_CTES, with_  # noqa: E402

ORACLE["csv_scan"] = "SELECT * FROM orders"
ORACLE["csv_scan_files"] = "SELECT * FROM orders"
ORACLE["ingest_stream"] = "SELECT * FROM events"
ORACLE["ingest_rescue_total"] = """
SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderkey % 29 = 0 OR o_orderkey % 31 = 0) AS rescued_rows,
       count(*) FILTER (WHERE o_orderkey % 29 = 0) AS null_totals
FROM orders"""
ORACLE["ingest_rescue"] = "SELECT rows, rescued_rows FROM (" + ORACLE["ingest_rescue_total"] + ")"
ORACLE["ingest_rescue_fields"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 29 <> 0 THEN o_totalprice END AS o_totalprice, o_orderstatus,
       o_orderkey % 31 = 0 AS no_date,
       '{' || concat_ws(',', CASE WHEN o_orderkey % 29 = 0 THEN '"o_totalprice":"n/a"' END,
                        CASE WHEN o_orderkey % 31 = 0 THEN '"o_orderdate":"soon"' END) || '}' AS _rescued_data
FROM orders WHERE o_orderkey % 29 = 0 OR o_orderkey % 31 = 0"""
# keys that fit 32 bits are inferred as int
ORACLE["csv_scan_inferred"] = """SELECT * REPLACE (CAST(o_orderkey AS INTEGER) AS o_orderkey,
    CAST(o_custkey AS INTEGER) AS o_custkey) FROM orders"""
for _t in TABLE_ORDER:
    ORACLE[f"ingest_{_t}"] = _with(raw_ctes(_t)) + f"SELECT * EXCLUDE (_rescued_data) FROM raw_{_t}"
# inferred: whole numbers are bigint, fractions double; a column without a value is text
INFERRED = {"int": "BIGINT", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
for _t in TABLE_ORDER:
    _key = PKS[_t][0]
    _typed = ", ".join(f"CAST({c} AS {INFERRED[lt]}) AS {c}" for c, lt in cols_of(_t, with_rescue=False) if lt in INFERRED)
    ORACLE[f"ingest_inferred_{_t}"] = _with(raw_ctes(_t)) + (
        f"SELECT * EXCLUDE (_rescued_data) REPLACE ({_typed}), CASE WHEN {_key} % 2 = 1 THEN 'till' END AS landed_by FROM raw_{_t}")
ORACLE["ingest_by_name"] = _with(raw_ctes("orders")) + """SELECT order_id, total_amount, order_status,
    CASE WHEN order_id % 2 = 1 THEN '{"landed_by":"till"}' END AS _rescued_data FROM raw_orders"""
ORACLE["materialize_roundtrip"] = ORACLE["agg_revenue_by_category"]
ORACLE["materialize_partitioned"] = ORACLE["fct_orders"]
ORACLE["usage_monthly_trend"] = (
    "SELECT year_month, revenue, aov, gross_margin_pct FROM (" + ORACLE["agg_revenue_monthly"] + ") "
    "ORDER BY year_month")
ORACLE["usage_top_items"] = with_(*ORDER_CTES, "item_perf") + """
SELECT restaurant_id, item_id, units_sold, revenue, margin_pct FROM item_perf
ORDER BY restaurant_id, revenue DESC"""

_GOLD = ["dim_date", "dim_restaurant", "dim_customer", "dim_menu_item", "dim_employee",
         "fct_orders", "fct_order_items", "fct_delivery", "fct_inventory_daily", "fct_daily_ops",
         "agg_revenue_monthly", "agg_revenue_by_category", "agg_restaurant_performance", "agg_hourly_demand",
         "agg_customer_cohorts", "agg_customer_lifetime", "agg_item_performance", "agg_menu_engineering",
         "agg_ops_costs", "agg_staffing_efficiency", "agg_delivery_by_condition", "agg_driver_performance"]
ORACLE["gold_refresh"] = union(
    [f"SELECT '{t}' AS {q('table')}, count(*) AS rows FROM ({ORACLE[t]})" for t in _GOLD])
ORACLE["gold_refresh_monthly"] = ORACLE["agg_revenue_monthly"]
ORACLE["ingest_clean_orders"] = ORACLE["clean_orders"]
ORACLE["csv_scan_file"] = "SELECT * FROM orders"
ORACLE["restaurant_performance_joined"] = ORACLE["agg_restaurant_performance"]
ORACLE["file_groups_written"] = """
SELECT 'nation' AS dataset, count(*) AS rows FROM nation UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders"""


# ------------------------------------------------- gold over the cleaned tables

SILVER_OF = {"restaurants_s": "restaurants", "customers_s": "customers", "employees_s": "employees",
             "menu_s": "menu_items", "orders_s": "orders", "details_s": "order_details",
             "delivery_s": "delivery_performance", "inventory_s": "inventory", "daily_s": "daily_operations"}
# capped counts are doubles; gold takes their whole part
WHOLE = {"menu_s": ["preparation_time_mins"], "orders_s": ["delivery_time_mins"], "inventory_s": ["closing_stock"],
         "daily_s": ["total_customers_eat_in", "total_customers_delivery", "total_orders", "delivery_orders_count",
                     "eat_in_orders_count"]}


def over_silver(sql: str) -> str:
    """A gold oracle whose source CTEs are the cleaned raw tables instead of the clean adapters."""
    for name, table in SILVER_OF.items():
        plain = f"{name} AS ({ADAPTERS[name]})"
        if plain not in sql:
            continue
        chain = []
        for cte, body in clean_ctes(table, **CLEAN_SPEC[table]):
            body = re.sub(rf"\b{name}\b", f"base_{name}", body)
            chain.append(f"{f'base_{name}' if cte == name else cte} AS ({body})")
        whole = ", ".join(f"CAST(trunc({c}) AS INTEGER) AS {c}" for c in WHOLE.get(name, []))
        chain.append(f"{name} AS (SELECT *{f' REPLACE ({whole})' if whole else ''} FROM clean_{table})")
        sql = sql.replace(plain, ",\n".join(chain))
    return sql


for _t in _GOLD:
    ORACLE[f"gold_{_t}"] = over_silver(ORACLE[_t])
