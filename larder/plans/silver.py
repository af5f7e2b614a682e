"""Silver cleaning of the ten raw tables (trim, fill, cap, de-duplicate).

The column lists and fill values are fixed values that must equal the reference's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import RESCUE_COL, cap_outliers, dedup_by_key, fill_nulls, trim_columns
from ..session import stored
from ..sources.files import materialize, scratch_path


def _drop_rescue(df: DataFrame) -> DataFrame:
    return df.drop(RESCUE_COL)


def clean_restaurants(raw: DataFrame) -> DataFrame:
    return trim_columns(_drop_rescue(raw),
                        ["restaurant_name", "address", "postcode", "area", "phone_number"])


def clean_customers(raw: DataFrame, exact: bool = True) -> DataFrame:
    df = trim_columns(_drop_rescue(raw), ["first_name", "last_name", "email", "phone", "postcode"])
    df = fill_nulls(df, {"email": "Unknown", "phone": "Unknown"})
    return cap_outliers(df, ["avg_order_value"], exact=exact)


def clean_employees(raw: DataFrame, exact: bool = True) -> DataFrame:
    df = trim_columns(_drop_rescue(raw), ["first_name", "last_name", "position", "reason_for_leaving"])
    df = fill_nulls(df, {"performance_rating": 0.0, "reason_for_leaving": "N/A"})
    return cap_outliers(df, ["salary_per_hour", "performance_rating"], exact=exact)


def clean_menu_items(raw: DataFrame, exact: bool = True) -> DataFrame:
    df = trim_columns(_drop_rescue(raw), ["item_name", "category", "sub_category"])
    df = fill_nulls(df, {"sub_category": "N/A"})
    return cap_outliers(df, ["preparation_time_mins", "cost_to_make"], exact=exact)


def clean_orders(raw: DataFrame, exact: bool = True) -> DataFrame:
    # raw CSV inference reads customer_id as double; ids stay 64-bit
    df = _drop_rescue(raw).withColumn("customer_id", F.col("customer_id").cast("long"))
    df = trim_columns(df, ["customer_name", "delivery_postcode", "order_type", "payment_method",
                           "order_status"])
    df = fill_nulls(df, {"customer_rating": 0.0, "customer_name": "N/A"})
    return cap_outliers(df, ["total_amount", "delivery_time_mins", "delivery_distance_miles"], exact=exact)


def clean_order_details(raw: DataFrame, exact: bool = True) -> DataFrame:
    df = trim_columns(_drop_rescue(raw), ["special_instructions"])
    return cap_outliers(df, ["item_price_at_time"], exact=exact)


def clean_reviews(raw: DataFrame, exact: bool = True) -> DataFrame:
    df = _drop_rescue(raw).withColumn("customer_id", F.col("customer_id").cast("long"))
    df = trim_columns(df, ["review_text", "category"])
    df = fill_nulls(df, {"review_text": "No review provided", "rating": 0.0, "sentiment_score": 0.0})
    return cap_outliers(df, ["sentiment_score"], exact=exact)


DAILY_COUNTS = ["total_customers_eat_in", "total_customers_delivery", "total_orders",
                "delivery_orders_count", "eat_in_orders_count"]


def clean_daily_ops(raw: DataFrame, exact: bool = True) -> DataFrame:
    # stored: the quartiles read the survivors again
    df = stored(dedup_by_key(_drop_rescue(raw), ["restaurant_id", "date"]))
    return cap_outliers(df, DAILY_COUNTS, exact=exact)


def clean_delivery(raw: DataFrame, exact: bool = True) -> DataFrame:
    df = trim_columns(_drop_rescue(raw), ["traffic_condition", "weather_condition", "delivery_status"])
    return cap_outliers(df, ["distance_miles"], exact=exact)


def clean_inventory(raw: DataFrame, exact: bool = True, written: bool = False) -> DataFrame:
    df = fill_nulls(_drop_rescue(raw), {"waste_stock": 0.0, "waste_value": 0.0})
    if not written:
        # the largest table, and derived by an aggregate: written, as the quartiles read it again
        df = materialize(df, scratch_path(df.sparkSession, "inventory"))
    return cap_outliers(df, ["stock_value", "waste_value", "closing_stock"], exact=exact)


CLEANERS = {
    "restaurants": clean_restaurants,
    "customers": clean_customers,
    "employees": clean_employees,
    "menu_items": clean_menu_items,
    "orders": clean_orders,
    "order_details": clean_order_details,
    "customer_reviews": clean_reviews,
    "daily_operations": clean_daily_ops,
    "delivery_performance": clean_delivery,
    "inventory": clean_inventory,
}
