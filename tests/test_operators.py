"""Operator semantics on tiny hand-built rows (cases the test tables cannot show)."""

import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from larder.functions.numeric import half_up_sql, pct_sql, round_units_sql, units_sql
from larder.operators import audit as Q
from larder.operators.clean import cap_outliers, dedup_by_key, fill_nulls, trim_columns
from larder.operators import rank
from larder.operators.rank import exact_quantiles, ntile_columns, quantile_table
from larder.plans import dims, facts


def rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ------------------------------------------------------------------ numeric

@pytest.mark.parametrize("n,d,k,expected", [
    (1, 8, 2, 0.13), (-1, 8, 2, -0.13), (26749, 10000, 2, 2.67), (2675, 1000, 2, 2.68),
    (-2675, 1000, 2, -2.68), (0, 7, 2, 0.0), (5, 0, 2, None), (2, 3, 1, 0.7), (10**20, 3, 0, 1e20 / 3),
])
def test_half_up_ratio(spark, n, d, k, expected):
    got = spark.sql(f"SELECT {half_up_sql(str(n), str(d), k)} AS r").first().r
    assert got == expected


def test_guarded_pct_zero_denominator(spark):
    df = spark.createDataFrame([(0, 0), (1, 4), (3, 0)], "a long, b long")
    got = [r.p for r in df.selectExpr(f"{pct_sql('a', 'b')} AS p").collect()]
    assert got == [0.0, 25.0, 0.0]


def test_months_between_rounding(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 3, 31), dt.date(2024, 2, 29)), (dt.date(2024, 3, 15), dt.date(2024, 2, 29)),
         (dt.date(2024, 3, 30), dt.date(2024, 2, 29))], "a date, b date")
    from larder.functions.calendar import months_between_e8_sql
    e8 = months_between_e8_sql("a", "b")
    got = [r.m for r in df.selectExpr(f"{half_up_sql(e8, str(10**8), 1)} AS m").collect()]
    assert got == [1.0, 0.5, 1.0]


# ---------------------------------------------------------------- calendar

def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2023, 1, 1),), (dt.date(2024, 5, 1),),
                                (dt.date(2024, 12, 25),)], "date date")
    got = {r.date: r for r in dims.calendar_columns(df).collect()}
    assert got[dt.date(2024, 1, 7)].day_of_week == 1 and got[dt.date(2024, 1, 7)].is_weekend
    assert got[dt.date(2023, 1, 1)].week_of_year == 52
    assert got[dt.date(2024, 5, 1)].year_quarter == "2024-Q2" and got[dt.date(2024, 5, 1)].is_holiday
    assert got[dt.date(2024, 12, 25)].is_holiday and got[dt.date(2024, 12, 25)].date_key == 20241225


def test_dim_date_fixed_range(spark):
    d = dims.dim_date(spark)
    assert d.count() == 1461


def test_employee_position_initcap(spark):
    emp = spark.createDataFrame(
        [(1, 1, "A", "B", "kitchen_staff", dt.date(2000, 1, 31), None, "Active", 10.0, 30, None, None)],
        "employee_id long, restaurant_id int, first_name string, last_name string, position string, "
        "hire_date date, leave_date date, employment_status string, salary_per_hour double, "
        "hours_per_week int, reason_for_leaving string, performance_rating double")
    r = dims.dim_employee(emp, "2001-01-31").first()
    assert r.position == "Kitchen staff" and r.tenure_months == 12.0 and r.is_active
    assert r.weekly_cost_gbp == 300.0


# ------------------------------------------------------------------ cleaning

def test_cap_outliers_bounds_types_and_nulls(spark):
    data = [(i, i, None) for i in range(1, 10)] + [(10, 100, None), (11, None, None)]
    df = spark.createDataFrame(data, "k int, x int, _tmp string")
    out = cap_outliers(df, ["x"])
    assert dict(out.dtypes)["x"] == "double"
    assert "_tmp" not in out.columns
    got = dict(rows(out, ["k"]))
    # exact quartiles of 1..9,100: q1 = 3, q3 = 8 -> upper = 8 + 1.5 * 5 = 15.5
    assert got[10] == 15.5 and got[11] is None and got[1] == 1.0


def test_cap_outliers_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, x double")
    assert [r.x for r in cap_outliers(df, ["x"]).collect()] == [None, None]


def test_cap_outliers_no_columns_returns_input(spark):
    df = spark.createDataFrame([(1, "a")], "k int, _keep string")
    assert cap_outliers(df, []).columns == ["k", "_keep"]


def test_trim_and_fill(spark):
    df = spark.createDataFrame([("  a ", None, None)], "s string, e string, r int")
    out = fill_nulls(trim_columns(df, ["s", "e"]), {"e": "Unknown", "r": 0.0}).first()
    assert (out.s, out.e, out.r) == ("a", "Unknown", 0)


def test_dedup_by_key_deterministic_survivor(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5, 10.0), (1, dt.date(2024, 1, 1), 3, 99.0),
                                (2, dt.date(2024, 1, 1), 7, 1.0)], "rid int, d date, op int, rev double")
    got = rows(dedup_by_key(df, ["rid", "d"]), ["rid"])
    assert got == [(1, dt.date(2024, 1, 1), 3, 99.0), (2, dt.date(2024, 1, 1), 7, 1.0)]


def test_dedup_hot_key(spark):
    # one key holding most rows is reduced by partial aggregation, survivor is the minimum
    df = spark.range(0, 20000).selectExpr("CASE WHEN id % 10 < 8 THEN 0 ELSE id END AS k", "id AS v")
    out = dedup_by_key(df, ["k"])
    assert out.count() == 4001
    assert out.where("k = 0").first().v == 0


# ------------------------------------------------------------------- ranking

@pytest.mark.parametrize("n", [1, 3, 4, 5, 6, 1003, 25000])
def test_ntile_matches_window_ntile(spark, n):
    # few values (edges inside ties), distinct values, one value only
    df = spark.range(0, n).selectExpr("id", "-(id % 7) AS few", "(id * 7919) % 25013 AS many", "5L AS one")
    got = ntile_columns(df, 5, {"a": "few", "b": "many", "c": "one"}, "id")
    want = df.withColumns({c: F.ntile(5).over(Window.orderBy(m, "id")) for c, m in (("a", "few"), ("b", "many"), ("c", "one"))})
    assert rows(got, ["id"]) == rows(want, ["id"])


def test_order_statistics_have_no_sort_of_the_rows(spark):
    df = spark.range(0, 5000).selectExpr("id", "id % 3 AS g")
    plan = ntile_columns(df, 5, {"t": "g"}, "id")._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("probs", [[0.25, 0.75], [0.5], [0.001, 0.999]])
def test_exact_quantiles_of_many_rows(spark, probs):
    df = spark.range(0, 60000).selectExpr(
        "(id * 7919) % 60013 + 0.25D AS x", "CASE WHEN id % 10 < 6 THEN 0.0D ELSE CAST(id AS DOUBLE) END AS y")
    got = {(r.column, r.p): r.value for r in exact_quantiles(df, ["x", "y"], probs).collect()}
    for c in ("x", "y"):
        ordered = sorted(r[0] for r in df.select(c).collect())
        for p in probs:
            assert got[c, p] == ordered[max(1, math.ceil(p * len(ordered))) - 1]


def test_approximate_quantiles_keep_their_rank_error(spark):
    df = spark.range(0, 60000).selectExpr("CAST((id * 7919) % 60013 AS DOUBLE) AS x")
    r = quantile_table(df, ["x"], [0.25, 0.75], ["q1", "q3"], exact=False, accuracy=200).first()
    ordered = sorted(v.x for v in df.collect())
    for q, p in ((r.q1, 0.25), (r.q3, 0.75)):
        assert abs(ordered.index(q) - p * len(ordered)) <= len(ordered) / 200


def test_a_rank_outside_its_bracket_raises(spark):
    values = spark.range(1, 11).selectExpr("'v' AS k", "CAST(id AS DOUBLE) AS value")
    targets = spark.createDataFrame([("v", 0, 2, 5.0, 8.0)], "k string, id int, rank long, lo double, hi double")
    with pytest.raises(Exception, match="outside its bracket"):
        rank.ranked_values(values, ["k"], targets, True).collect()


# --------------------------------------------------------------------- money

@pytest.mark.parametrize("qty, price, total", [(10, 10.005, 100.05), (10, 2.675, 26.75), (1, 2.675, 2.68), (1, -2.675, -2.68), (3, 0.0, 0.0)])
def test_line_amounts_keep_tenths_of_a_cent(spark, qty, price, total):
    got = spark.sql(f"SELECT {round_units_sql(units_sql(f'{price}D') + f' * {qty}')} AS v").first().v
    assert got == total


def test_line_revenue_of_capped_prices(spark):
    details = spark.createDataFrame([(1, 1, 1, 10, 10.005, None)], "order_detail_id long, order_id long, item_id long, "
                                    "quantity int, item_price_at_time double, special_instructions string")
    orders = spark.createDataFrame([(1, 1, 1, dt.date(2024, 1, 1), "Delivery", "Completed")],
                                   "order_id long, restaurant_id int, customer_id long, order_date date, order_type string, order_status string")
    menu = spark.createDataFrame([(1, 1, 2.675, "a", "b")], "item_id long, restaurant_id int, cost_to_make double, category string, sub_category string")
    r = facts.fct_order_items(details, orders, menu).first()
    assert (r.line_revenue, r.line_cost, r.line_margin) == (100.05, 26.75, 73.3)


@pytest.mark.parametrize("amounts, usual, clv", [([10.0, None, 20.0], 7.0, 45.0), ([None], 50.0, 50.0), ([None], None, None), ([], 50.0, 0.0), ([], None, None)])
def test_customer_lifetime_value(spark, amounts, usual, clv):
    customers = spark.createDataFrame([(1, dt.date(2020, 1, 1), usual)], "customer_id long, join_date date, avg_order_value double")
    orders = spark.createDataFrame([(i, 1, "Completed", a, dt.date(2021, 1, 1)) for i, a in enumerate(amounts)],
                                   "order_id long, customer_id long, order_status string, total_amount double, order_date date")
    base = dims.customer_recency(customers, dims.customer_order_summary(orders), "2022-01-01")
    assert dims.customer_ltv_columns(base).first().customer_lifetime_value == clv


def test_times_given_as_text(spark):
    deliveries = spark.createDataFrame([(1, 1, 1, 1, "2024-01-01 00:00:00.9", "2024-01-01 00:01:00.1", 1.0, "a", "b", "On_Time"),
                                        (2, 1, 1, 1, "soon", None, 1.0, "a", "b", None)],
                                       "delivery_id long, order_id long, restaurant_id int, driver_id long, dispatch_time string, "
                                       "delivery_time string, distance_miles double, traffic_condition string, weather_condition string, delivery_status string")
    a, b = facts.fct_delivery(deliveries).orderBy("delivery_id").collect()
    assert a.delivery_minutes == 1.0 and a.delivery_date == dt.date(2024, 1, 1)
    assert b.delivery_minutes is None and b.dispatch_time is None
    orders = spark.createDataFrame([(1, dt.date(2024, 5, 2), "18:30:00"), (2, dt.date(2024, 5, 2), "2024-05-02 09:15:00"), (3, dt.date(2024, 5, 2), "late")],
                                   "order_id long, order_date date, order_time string")
    assert [r.order_time for r in facts.with_order_time(orders).orderBy("order_id").collect()] == [
        dt.datetime(2024, 5, 2, 18, 30), dt.datetime(2024, 5, 2, 9, 15), None]


def test_exact_quantiles_match_percentile_disc(spark):
    df = spark.createDataFrame([(g, float(v)) for g in range(3) for v in range(g * 7 + 5)], "g int, x double")
    got = {(r.g, r.p): r.value for r in exact_quantiles(df, ["x"], [0.25, 0.5, 0.75], ["g"]).collect()}
    want = df.groupBy("g").agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)").alias(str(p))
                                 for p in (0.25, 0.5, 0.75)])
    for r in want.collect():
        for p in (0.25, 0.5, 0.75):
            assert got[(r.g, p)] == r[str(p)]


def test_rfm_scores_customers_without_orders_score_one(spark):
    cust = spark.createDataFrame([(i, i % 4 * 10, None if i in (3, 7) else i % 3 + 1,
                                   None if i in (3, 7) else i * 100) for i in range(10)],
                                 "customer_id long, recency_days int, orders_cnt long, spent_u long")
    out = {r.customer_id: r for r in dims.rfm_scores(cust).collect()}
    assert (out[3].r_score, out[3].f_score, out[3].m_score) == (1, 1, 1)
    assert out[9].m_score == 1   # biggest spender is tile 1 in the reference's direction
    high = {r.customer_id: r for r in dims.rfm_scores(cust, direction="high_is_best").collect()}
    assert high[9].m_score == 5 and high[3].m_score == 1


# --------------------------------------------------------------------- facts

def test_menu_join_key_fan_out(spark):
    details = spark.createDataFrame([(1, 10, 100, 2, 5.0, None)],
                                    "order_detail_id long, order_id long, item_id long, quantity int, "
                                    "item_price_at_time double, special_instructions string")
    orders = spark.createDataFrame([(10, 1, 7, dt.date(2024, 1, 1), "Delivery", "Completed")],
                                   "order_id long, restaurant_id int, customer_id long, order_date date, "
                                   "order_type string, order_status string")
    menu = spark.createDataFrame([(100, 1, 1.0, "c", "s"), (100, 2, 2.0, "c", "s")],
                                 "item_id long, restaurant_id int, cost_to_make double, category string, "
                                 "sub_category string")
    assert facts.fct_order_items(details, orders, menu).count() == 2            # as the reference
    keyed = facts.fct_order_items(details, orders, menu, ("item_id", "restaurant_id"))
    assert keyed.count() == 1 and keyed.first().line_margin == 8.0


# -------------------------------------------------------------------- audits

def test_audit_nulls_counts_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (2, 1.0, "x")], "k int, d double, s string")
    got = {r.column: (r.null_count, r.null_pct) for r in Q.table_nulls(df, "t").collect()}
    assert got == {"d": (1, 50.0), "s": (1, 50.0)}


def test_audit_outliers_skip_rule_and_all_null(spark):
    df = spark.createDataFrame([(i, float(i % 6), None, float(i % 20 if i < 95 else 1000)) for i in range(100)],
                               "id long, few double, empty double, x double")
    got = {r.column: r for r in Q.table_outliers(df, "t").collect()}
    assert "id" not in got and "empty" not in got   # id-like and all-NULL columns are skipped
    assert got["x"].outlier_count == 5


def test_reconcile_rows_and_delta(spark):
    left = spark.createDataFrame([(1, "a", "r"), (1, "a", "r"), (2, "b", None)], "k int, v string, _r string")
    right = left.dropDuplicates().drop("_r")
    r = Q.reconcile_rows({"t": (left, right)}).first()
    assert (r.left_rows, r.right_rows, r.row_diff, r.missing_cols, r.extra_cols) == (3, 2, -1, "_r", "none")
    d = Q.layer_row_delta({"t": (left, right)}).first()
    assert (d.rows_removed, d.removed_pct) == (1, 33.33)


# ----------------------------------------------------------------- streaming

def test_stream_ingest_is_incremental(spark, tmp_path):
    from larder.streaming.ingest import ingest_stream
    src, out, ck = tmp_path / "src", str(tmp_path / "t"), str(tmp_path / "ck")
    src.mkdir()
    schema = "id long, amt double, s string"
    (src / "a.csv").write_text("id,amt,s\n1,1.5,x\n2,2.5,y\n")
    (src / "b.csv").write_text("id,amt,s\n3,3.5,z\n")
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    assert ingest_stream(spark, str(src), st, out, ck).count() == 3
    (src / "c.csv").write_text("id,amt,s\n4,4.5,w\n")
    assert ingest_stream(spark, str(src), st, out, ck).count() == 4
    assert ingest_stream(spark, str(src), st, out, ck).count() == 4   # nothing new


def test_stream_ingest_rescues_bad_cells(spark, tmp_path):
    from larder.streaming.ingest import ingest_stream
    from pyspark.sql.types import _parse_datatype_string
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.csv").write_text("id,amt,s\n1,1.5,x\n2,bad,y\n")
    t = ingest_stream(spark, str(src), _parse_datatype_string("id int, amt double, s string"),
                      str(tmp_path / "t"), str(tmp_path / "ck"), rescue=True, with_file_name=True)
    bad = t.where("id = 2").first()
    assert bad.amt is None and bad._rescued_data == '{"amt":"bad"}' and bad.source_file == "a.csv"
    assert t.where("id = 1").first()._rescued_data is None


def test_file_groups_reference_rules(spark, tmp_path):
    from larder.sources.files import file_groups, file_inventory
    for name in ["customers.csv", "orders_2024_01.csv", "orders_2024_02.csv", "order_details_1.csv",
                 "customer_reviews_1.csv", "notes.txt"]:
        (tmp_path / name).write_text("x\n1\n")
    got = {r.dataset: r.files for r in file_groups(file_inventory(spark, str(tmp_path))).collect()}
    assert got == {"customers": 1, "orders": 2, "order_details": 1, "customer_reviews": 1}


# --------------------------------------------------------------- plan checks

def test_no_python_udfs_in_registered_plans(spark, sf_dir):
    import __spark_entry__ as E
    for name in ["agg_revenue_monthly", "dim_customer", "clean_orders", "audit_nulls", "agg_menu_engineering"]:
        plan = E.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "EvalPython" not in plan, name


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    import __spark_entry__ as E
    df = E.queries()["agg_driver_performance"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint" in plan
    for unused in ("l_tax", "l_discount", "l_extendedprice"):   # pruned from the scan
        assert unused not in plan


@pytest.mark.parametrize("name", ["cap_outliers_iqr", "cap_outliers_multi", "clean_orders", "clean_inventory"])
def test_capping_joins_nothing_crosswise(spark, sf_dir, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, sf_dir)
    df.count()
    plan = df._jdf.queryExecution().toString()
    main = plan.split("== Physical Plan ==")[1].split("Subquery")[0]
    assert "NestedLoopJoin" not in main and "Cartesian" not in main
