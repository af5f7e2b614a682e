"""SQL oracles (DuckDB) for the queries over tables by name, versions, touched months, sketches and write-time audits."""

from __future__ import annotations

from .oracle import ADAPTERS, ORACLE, _with
from .oracle_quality import PKS, _clean_all, clean_type, cols_of, q, union

ORACLE["catalog_tables"] = union([f"SELECT '{t}' AS {q('table')}, count(*) AS rows FROM {src}" for t, src in {
    "restaurants": "nation", "customers": "customer", "employees": "supplier", "menu_items": "part", "orders": "orders",
    "order_details": "lineitem", "delivery_performance": "lineitem", "customer_reviews": "documents",
    "inventory": "(SELECT DISTINCT l_suppkey, l_partkey, CAST(l_shipdate AS DATE) FROM lineitem)",
    "daily_operations": "(SELECT DISTINCT l_suppkey % 10, CAST(l_shipdate AS DATE) FROM lineitem)"}.items()])
for _name, _same in {
        "catalog_fct_orders": "fct_orders", "catalog_fct_order_items": "fct_order_items", "catalog_revenue_monthly": "agg_revenue_monthly",
        "published_gold": "agg_item_performance", "refresh_touched_orders": "fct_orders", "refresh_touched_monthly": "agg_revenue_monthly",
        "observed_overview": "audit_overview_silver", "observed_nulls": "audit_nulls_silver", "observed_negatives": "audit_negatives_silver"}.items():
    ORACLE[_name] = ORACLE[_same]

ORACLE["silver_refresh"] = f"SELECT {q('table')}, rows FROM ({ORACLE['audit_overview_silver']})"

ORACLE["order_items_hot_item"] = f"""
WITH details_s AS ({ADAPTERS['details_s']}), menu_s AS ({ADAPTERS['menu_s']})
SELECT d.* REPLACE (CASE WHEN order_id % 3 = 0 THEN 1 ELSE d.item_id END AS item_id), category, sub_category, cost_to_make
FROM details_s d LEFT JOIN menu_s m ON m.item_id = CASE WHEN order_id % 3 = 0 THEN 1 ELSE d.item_id END"""


# ------------------------------------------------------------- located differences

# tables whose declared key tells their rows apart
_LOCATED = ("restaurants", "customers", "employees", "menu_items", "orders")
# keys of the other tables; rows that repeat one are compared together
_REPEATED = {"order_details": ["order_detail_id", "item_id"], "customer_reviews": ["review_id"], "daily_operations": ["restaurant_id", "date"],
             "delivery_performance": ["delivery_id", "driver_id"], "inventory": ["restaurant_id", "item_id", "date"]}


def _joined(t: str) -> str:
    on = " AND ".join(f"l.{k} IS NOT DISTINCT FROM r.{k}" for k in PKS[t])
    return f"raw_{t} l FULL JOIN clean_{t} r ON {on}"


def _plain(t: str, c: str, lt: str) -> tuple[str, str]:
    zero = " + 0.0" if "double" in (lt, clean_type(t, c, lt)) else ""
    return f"l.{q(c)}{zero}", f"r.{q(c)}{zero}"


def _located_parts(t: str) -> list[str]:
    cells = []
    for c, lt in cols_of(t, with_rescue=False):
        if c not in PKS[t]:
            a, b = _plain(t, c, lt)
            cells.append(f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, 'changed' AS kind, count(*) AS cells "
                         f"FROM {_joined(t)} WHERE {a} IS DISTINCT FROM {b} HAVING count(*) > 0")
    return cells


def _listed(t: str) -> list[tuple[str, str]]:
    """Per key of the raw and of the cleaned table: its rows, and every column's values in order."""
    keys = ", ".join(_REPEATED[t])
    out = []
    for side in ("raw", "clean"):
        lists = []
        for c, lt in cols_of(t, with_rescue=False):
            if c not in _REPEATED[t]:
                x = f"CAST({q(c)} AS DOUBLE) + 0.0" if "double" in (lt, clean_type(t, c, lt)) else q(c)
                lists.append(f"list({x} ORDER BY {x}) AS {q(c)}")
        out.append((f"{side}_{t}_listed", f"SELECT {keys}, true AS here, count(*) AS n, {', '.join(lists)} FROM {side}_{t} GROUP BY {keys}"))
    return out


def _repeated_parts(t: str) -> list[str]:
    on = " AND ".join(f"l.{k} IS NOT DISTINCT FROM r.{k}" for k in _REPEATED[t])
    source = f"FROM raw_{t}_listed l FULL JOIN clean_{t}_listed r ON {on} WHERE"
    part = lambda column, kind, test: (
        f"SELECT '{t}' AS {q('table')}, {column} AS {q('column')}, '{kind}' AS kind, count(*) AS cells {source} {test} HAVING count(*) > 0")
    none, both = "CAST(NULL AS VARCHAR)", "l.here AND r.here AND"
    return [part(none, "left_only", "r.here IS NULL"), part(none, "right_only", "l.here IS NULL"), part(none, "rows", f"{both} l.n <> r.n"),
            *[part(f"'{c}'", "changed", f"{both} l.{q(c)} IS DISTINCT FROM r.{q(c)}") for c, _ in cols_of(t, with_rescue=False) if c not in _REPEATED[t]]]


ORACLE["located_differences"] = _with([*_clean_all, *[cte for t in _REPEATED for cte in _listed(t)]]) + union(
    [p for t in _LOCATED for p in _located_parts(t)] + [p for t in _REPEATED for p in _repeated_parts(t)])


def _changed(t: str, columns: list[str]) -> str:
    keys = ", ".join(f"l.{k}" for k in PKS[t])
    return union([f"SELECT {keys}, '{c}' AS {q('column')}, 'changed' AS kind, CAST(l.{c} AS DOUBLE) AS left_value, "
                  f"CAST(r.{c} AS DOUBLE) AS right_value FROM {_joined(t)} WHERE l.{c} + 0.0 IS DISTINCT FROM r.{c} + 0.0" for c in columns])


ORACLE["changed_menu_prices"] = _with(_clean_all) + _changed("menu_items", ["price", "cost_to_make"])


# ------------------------------------------------------------- sketches and bitmaps

ORACLE["casing_sketched"] = f"SELECT {q('table')}, {q('column')}, inconsistent FROM ({ORACLE['audit_casing']})"
_FREQUENT = {"orders": ["o_custkey", "o_orderpriority", "o_orderstatus"], "lineitem": ["l_partkey", "l_quantity", "l_returnflag"],
             "events": ["user_id", "event_type"], "documents": ["source", "lang"]}
ORACLE["frequent_values"] = union([
    f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM {t} "
    f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) >= 0.01 * (SELECT count({c}) FROM {t})"
    for t, cs in _FREQUENT.items() for c in cs])
_MEASURES = {"orders": ["total_amount", "delivery_distance_miles", "delivery_time_mins", "customer_rating"],
             "inventory": ["opening_stock", "closing_stock", "stock_value", "waste_value"]}
ORACLE["outliers_sketched_error"] = _with(_clean_all) + union([
    f"SELECT '{t}' AS {q('table')}, '{c}' AS {q('column')}, count(*) AS rows, true AS quartiles_within, true AS outliers_within FROM raw_{t}"
    for t, cs in _MEASURES.items() for c in cs])
_LEVELS = {"month": "year_month", "restaurant": "CAST(restaurant_id AS VARCHAR)", "day": "CAST(order_date AS VARCHAR)",
           "hour": "concat_ws('-', day_of_week, hour_of_day)", "all": "'all'"}
ORACLE["distinct_customers_rolled_up"] = f"WITH fct AS (SELECT * FROM ({ORACLE['fct_orders']}) WHERE is_completed AND customer_id IS NOT NULL)\n" + union([
    f"SELECT '{level}' AS level, {value} AS value, count(DISTINCT customer_id) AS customers FROM fct GROUP BY {value}" for level, value in _LEVELS.items()])

