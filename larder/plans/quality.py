"""Data-quality audit and reconciliation queries over the raw and cleaned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as Q
from ..sources import adapters as A
from ..sources.tables import Tables
from .registry import QUERIES, query, written_layer

# Fixed values that must equal the reference's: the categorical and
# non-negative columns its notebooks check, per raw table.
CATEGORICAL_CHECKS = {
    "customers": ["customer_segment", "preferred_category", "preferred_order_type"],
    "orders": ["order_type", "payment_method", "order_status"],
    "employees": ["position", "employment_status"],
    "menu_items": ["category", "sub_category"],
    "delivery_performance": ["traffic_condition", "weather_condition", "delivery_status"],
    "customer_reviews": ["category"],
}
NEGATIVE_CHECKS = {
    "orders": ["total_amount", "delivery_distance_miles", "delivery_time_mins"],
    "menu_items": ["price", "cost_to_make"],
    "daily_operations": ["daily_revenue", "total_customers_eat_in", "total_customers_delivery", "staff_on_shift"],
    "inventory": ["opening_stock", "closing_stock", "stock_value"],
    "customer_reviews": ["rating", "sentiment_score"],
    "employees": ["salary_per_hour", "performance_rating"],
}
# expected types for the type-conformance audit
TYPE_EXPECTATIONS = {
    "orders": {"customer_id": "int"},
    "customer_reviews": {"customer_id": "int"},
    "events": {"props": "int", "value": "double"},
    "part": {"p_size": "int", "p_brand": "int"},
}
# keys of the cleaned tables, where they differ from the raw ones
SILVER_KEYS = A.PRIMARY_KEYS | {"daily_operations": ["restaurant_id", "date"]}


def raw_tables(t: Tables) -> dict:
    return {name: A.raw(t, name) for name in A.SOURCES}


def silver_tables(t: Tables) -> dict:
    """The ten written silver tables."""
    return written_layer(t, "silver")


def layer_pairs(t: Tables) -> dict:
    """Raw (bronze) and written silver form of each table; raw tables that are aggregates are read as they were written."""
    clean = silver_tables(t)
    raw = raw_tables(t) | written_layer(t, "raw")
    return {name: (raw[name], clean[name]) for name in A.SOURCES}


@query("audit_overview")
def q_audit_overview(spark, sf_dir):
    return Q.audit_overview(raw_tables(Tables(spark, sf_dir)))


@query("audit_nulls")
def q_audit_nulls(spark, sf_dir):
    return Q.audit_nulls(raw_tables(Tables(spark, sf_dir)))


@query("audit_duplicates")
def q_audit_duplicates(spark, sf_dir):
    return Q.audit_duplicates(raw_tables(Tables(spark, sf_dir)), A.PRIMARY_KEYS)


@query("audit_duplicate_rows")
def q_audit_duplicate_rows(spark, sf_dir):
    return Q.duplicate_rows(Tables(spark, sf_dir).lineitem)


@query("audit_pk_violations")
def q_audit_pk_violations(spark, sf_dir):
    return Q.pk_violations(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@query("audit_outliers")
def q_audit_outliers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return Q.audit_outliers({"events": t.events, "documents": t.documents} | raw_tables(t))


@query("audit_value_counts")
def q_audit_value_counts(spark, sf_dir):
    return Q.audit_value_counts(raw_tables(Tables(spark, sf_dir)), CATEGORICAL_CHECKS)


@query("audit_whitespace")
def q_audit_whitespace(spark, sf_dir):
    return Q.audit_whitespace(raw_tables(Tables(spark, sf_dir)))


@query("audit_whitespace_silver")
def q_audit_whitespace_silver(spark, sf_dir):
    return Q.audit_whitespace(silver_tables(Tables(spark, sf_dir)))


@query("audit_overview_silver")
def q_audit_overview_silver(spark, sf_dir):
    return Q.audit_overview(silver_tables(Tables(spark, sf_dir)))


@query("audit_nulls_silver")
def q_audit_nulls_silver(spark, sf_dir):
    return Q.audit_nulls(silver_tables(Tables(spark, sf_dir)))


@query("audit_duplicates_silver")
def q_audit_duplicates_silver(spark, sf_dir):
    return Q.audit_duplicates(silver_tables(Tables(spark, sf_dir)), SILVER_KEYS)


@query("audit_outliers_silver")
def q_audit_outliers_silver(spark, sf_dir):
    return Q.audit_outliers(silver_tables(Tables(spark, sf_dir)))


@query("audit_value_counts_silver")
def q_audit_value_counts_silver(spark, sf_dir):
    return Q.audit_value_counts(silver_tables(Tables(spark, sf_dir)), CATEGORICAL_CHECKS)


@query("audit_negatives_silver")
def q_audit_negatives_silver(spark, sf_dir):
    return Q.audit_negatives(silver_tables(Tables(spark, sf_dir)), NEGATIVE_CHECKS)


@query("audit_casing")
def q_audit_casing(spark, sf_dir):
    return Q.audit_casing(raw_tables(Tables(spark, sf_dir)), CATEGORICAL_CHECKS)


@query("audit_types")
def q_audit_types(spark, sf_dir):
    t = Tables(spark, sf_dir)
    tables = {"orders": A.raw(t, "orders"), "customer_reviews": A.raw(t, "customer_reviews"),
              "events": t.events, "part": t.part}
    return Q.audit_types(tables, TYPE_EXPECTATIONS)


@query("audit_negatives")
def q_audit_negatives(spark, sf_dir):
    return Q.audit_negatives(raw_tables(Tables(spark, sf_dir)), NEGATIVE_CHECKS)


@query("reconcile_rows")
def q_reconcile_rows(spark, sf_dir):
    return Q.reconcile_rows(layer_pairs(Tables(spark, sf_dir)))


@query("reconcile_types")
def q_reconcile_types(spark, sf_dir):
    return Q.reconcile_types(layer_pairs(Tables(spark, sf_dir)))


@query("reconcile_profile")
def q_reconcile_profile(spark, sf_dir):
    return Q.reconcile_profile(layer_pairs(Tables(spark, sf_dir)))


@query("reconcile_distinct")
def q_reconcile_distinct(spark, sf_dir):
    return Q.reconcile_distinct(layer_pairs(Tables(spark, sf_dir)))


@query("layer_row_delta")
def q_layer_row_delta(spark, sf_dir):
    return Q.layer_row_delta(layer_pairs(Tables(spark, sf_dir)))


@query("profile_numeric")
def q_profile_numeric(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return Q.profile_numeric(t.part, "part").unionByName(Q.profile_numeric(t.orders, "orders"))


@query("sample_rows")
def q_sample_rows(spark, sf_dir):
    return Q.sample_rows(Tables(spark, sf_dir).orders, [F.col("o_orderkey")], 3)


__all__ = ["QUERIES"]
