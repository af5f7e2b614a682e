"""What is moved and written by the layers, audits and refreshes: plans and files that keep it down."""

import glob
import threading

from pyspark.sql import functions as F

from larder.operators import audit, locate, observe
from larder.plans import facts, layers, marts, refresh
from larder.plans.silver import clean_inventory
from larder.sources import adapters as A
from larder.sources import files as io
from larder.sources import warehouse
from larder.sources.tables import Tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# ----------------------------------------------------------------- layers

def test_inventory_is_moved_once_for_its_months(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    fact = facts.fct_inventory_daily(A.inventory(t))
    assert plan_of(fact).count("Exchange") == 1 and "hashpartitioning(_month" in plan_of(fact)
    written = io.materialize(fact, str(tmp_path / "fact"), ["year_month"], gather=False)
    gathered = io.materialize(facts.fct_inventory_daily(io.gathered(A.inventory(t), "date_format(date, 'yyyy-MM')")), str(tmp_path / "other"), ["year_month"], gather=False)
    assert same(written.select(sorted(written.columns)), gathered.select(sorted(gathered.columns)))
    # a month is in few files, whichever way it was brought together
    for folder in ("fact", "other"):
        assert max(len(glob.glob(f"{m}/*.parquet")) for m in glob.glob(str(tmp_path / folder / "year_month=*"))) <= 8


def test_cleaned_inventory_is_aggregated_once(spark, sf_dir):
    assert "lineitem" not in plan_of(clean_inventory(A.raw(Tables(spark, sf_dir), "inventory")))


def test_facts_by_month_move_before_they_are_derived(spark, sf_dir):
    t = Tables(spark, sf_dir)
    plain, by_month = (facts.fct_orders(A.orders(t), A.order_details(t), by_month=how) for how in (False, True))
    assert plain.columns == by_month.columns and same(plain, by_month)
    assert "REBALANCE" in plan_of(by_month).split("is_completed")[1]


def test_dealt_orders_move_once(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    orders, details = A.orders(t), A.order_details(t)
    # ids that repeat (in one month and over two), are missing, or have no lines or no date
    odd = orders.limit(60).withColumn("order_date", F.expr("CASE WHEN order_id % 3 = 0 THEN order_date WHEN order_id % 3 = 1 THEN add_months(order_date, 5) END"))
    orders = orders.union(odd).union(orders.limit(5).withColumn("order_id", F.expr("CAST(NULL AS BIGINT)"))).union(
        orders.limit(5).withColumn("order_id", F.expr("order_id + 10000000")))
    details = details.union(details.limit(3).withColumn("order_id", F.expr("CAST(NULL AS BIGINT)")))
    plain, dealt = facts.fct_orders(orders, details), facts.fct_orders_dealt(orders, details)
    assert plain.dtypes == dealt.dtypes and same(plain, dealt)
    # orders with their columns cross one exchange, by month
    moved = [x for x in plan_of(facts.fct_orders_dealt(A.orders(t), A.order_details(t))).splitlines() if "Exchange hashpartitioning" in x]
    assert len(moved) == 3 and sum("hashpartitioning(_month_part" in x for x in moved) == 1
    written = io.materialize(dealt, str(tmp_path / "dealt"), ["year_month"], gather=False)
    assert same(written.select(plain.columns), plain)
    assert max(len(glob.glob(f"{m}/*.parquet")) for m in glob.glob(str(tmp_path / "dealt" / "year_month=*"))) <= 4


def test_marts_of_items_are_built_where_the_lines_lie(spark, sf_dir, tmp_path, monkeypatch):
    t = Tables(spark, sf_dir)
    silver = {name: A.source(t, name) for name in A.SOURCES}
    plans, plain = {}, {name: getattr(marts, name) for name in ("agg_item_performance", "agg_menu_engineering", "agg_revenue_monthly")}

    def seen(name):
        def run(*args, **how):
            df = plain[name](*args, **how)
            plans[name] = plan_of(df)
            return df
        return run

    for name in plain:
        monkeypatch.setattr(marts, name, seen(name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        gold = refresh.refresh_gold(silver, str(tmp_path / "even"), "2001-12-31", by_month=A.BY_MONTH)
        assert "Exchange" not in plans["agg_item_performance"] and "order_id" not in "".join(
            x for x in plans["agg_revenue_monthly"].splitlines() if "Exchange" in x)
        monkeypatch.setattr(refresh, "deals_evenly", lambda *_: False)                 # a hot item: no buckets
        monkeypatch.setattr(facts, "unique_orders", lambda *_: False)                  # orders that share an id
        other = refresh.refresh_gold(silver, str(tmp_path / "hot"), "2001-12-31", by_month=A.BY_MONTH)
        assert "Exchange" in plans["agg_item_performance"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [x.name for x in spark.catalog.listTables() if x.name.endswith(("fct_order_items", "agg_item_performance"))]
    for name in ("fct_orders", "fct_order_items", "agg_item_performance", "agg_menu_engineering", "agg_revenue_monthly", "agg_restaurant_performance"):
        columns = gold[name].columns
        assert gold[name].count() > 0 and sorted(columns) == sorted(other[name].columns) and same(gold[name], other[name].select(columns)), name


def test_a_hot_item_is_not_put_into_one_bucket(spark):
    even = spark.range(4000).selectExpr("id % 997 AS k")
    hot = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id % 997 END AS k")
    empty = spark.range(4000).selectExpr("CASE WHEN id % 3 > 0 THEN id % 997 END AS k")
    assert [warehouse.deals_evenly(df, "k", 32, few=100) for df in (even, hot, empty, even.limit(0))] == [True, False, False, True]
    assert warehouse.deals_evenly(hot, "k", 32)                                        # few rows: a bucket can't be large


def test_orders_that_share_an_id_have_their_margins_by_order(spark):
    orders = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (None, 5), (None, 5)], "order_id long, x int")
    assert not facts.unique_orders(orders) and facts.unique_orders(orders.where("coalesce(order_id, 2) = 2"))


def test_medians_leave_the_rows_where_they_are(spark):
    df = spark.range(1000).selectExpr("id % 5 AS g", "id AS x", "CAST(id % 7 AS DOUBLE) AS y")
    out = marts.quadrant_by_group_median(df, "g", "x", "y")
    assert "Exchange hashpartitioning" not in plan_of(out) and "BroadcastHashJoin" in plan_of(out)
    assert out.where("g = 0").select("med_x").distinct().first()[0] == 495


def test_tables_are_written_by_zstd(spark, tmp_path):
    io.materialize(spark.range(10), str(tmp_path / "t"))
    assert glob.glob(str(tmp_path / "t" / "*.zstd.parquet"))


# ----------------------------------------------------------------- audits

def test_distinct_counts_take_values_as_they_are(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1L, 1, 0.0D, 'a', DATE'2020-01-01', TIMESTAMP'2020-01-01 00:00:00', true, 1.50BD),
        (-9223372036854775808L, 42, -0.0D, '', DATE'1969-12-31', TIMESTAMP'2020-01-01 00:00:00.000001', false, 1.51BD),
        (42L, NULL, double('NaN'), NULL, NULL, NULL, NULL, NULL),
        (NULL, 42, NULL, 'A', DATE'2020-01-01', NULL, true, 1.50BD),
        (NULL, 42, double('NaN'), 'a', DATE'2020-01-01', NULL, true, 1.5BD) AS (l, i, d, s, day, at, b, m)""")
    got = {r.column: r.distinct for r in audit.distinct_counts(df, df.columns).collect()}
    # NULL counts once, both zeros and all NaN are one value
    assert got == {"l": 4, "i": 3, "d": 3, "s": 4, "day": 3, "at": 3, "b": 3, "m": 3}
    plan = plan_of(audit.distinct_counts(df, ["l", "i", "d", "day", "at", "b"]))
    assert "as string)" not in plan


def test_values_are_counted_where_columns_differ_alone(spark):
    left = spark.range(600).selectExpr("id AS k", "concat('untouched ', id) AS same", "TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(0, CAST(id % 40 AS INT)) AS at",
                                       "id % 9 AS n", "CAST(id % 8 AS INT) AS i", "CASE WHEN id % 3 > 0 THEN 'x' END AS s", "id % 5 AS swapped", "id * -0.0D AS z")
    right = left.repartition(3).selectExpr("k", "same", "at", "n + 0.5D AS n", "CAST(i AS DOUBLE) AS i", "coalesce(s, 'y') AS s", "4 - swapped AS swapped", "0.0D AS z")
    right = right.union(spark.sql("SELECT 600L, 'untouched 0', TIMESTAMP_NTZ'2020-01-01 00:00:00', -1.0D, 0.0D, 'z', 0L, NULL"))
    # one row more: every column is counted
    got = {tuple(r) for r in audit.reconcile_distinct({"t": (left, right)}).collect()}
    assert got == {("t", "k", 600, 601), ("t", "n", 9, 10), ("t", "s", 2, 3), ("t", "z", 1, 2)}
    same = right.where("k < 600")
    plan = plan_of(audit.reconcile_distinct({"t": (left, same)}))
    assert "untouched" not in plan and "make_dt_interval" not in plan
    assert {tuple(r) for r in audit.reconcile_distinct({"t": (left, same), "u": (left, left)}).collect()} == set()
    prints = audit.bag_prints(left, left.columns), audit.bag_prints(same, left.columns)
    assert [c for c in left.columns if prints[0][c] != prints[1][c]] == ["n", "i", "s"]
    assert audit.reconcile_distinct({"t": (left.limit(0), left.limit(0))}).count() == 0
    times = left.selectExpr("at")
    assert "as string)" not in plan_of(audit.distinct_counts(times, ["at"]))


def test_located_rows_move_once(spark, sf_dir):
    orders = A.raw(Tables(spark, sf_dir), "orders").drop("_rescued_data")
    found = locate.differences(orders, orders.withColumn("order_type", F.lower("order_type")), ["order_id"])
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning(order_id") == 1 and "FullOuter" not in plan.split("BroadcastExchange")[0]
    assert {r.column for r in found.select("column").distinct().collect()} == {"order_type"}


def test_observed_tables_are_written_side_by_side(spark, tmp_path, monkeypatch):
    both, plain = threading.Barrier(2), observe.write_observed

    def meet(*args):
        both.wait(timeout=60)
        return plain(*args)

    monkeypatch.setattr(observe, "write_observed", meet)
    tables = {"a": spark.range(3), "b": spark.range(5)}
    written, metrics = observe.write_all_observed(tables, str(tmp_path), {})
    assert list(written) == ["a", "b"]
    assert {r.table: r.rows for r in observe.overview(metrics).collect()} == {"a": 3, "b": 5}


# --------------------------------------------------------- touched months

def test_lines_of_both_batches_meet_their_orders_once(spark, sf_dir, monkeypatch):
    parts, plain = [], io.write_csv

    def seen(df, path, **how):
        parts.append((path.rsplit("/", 1)[-1], plan_of(df), df.count(), how["compression"]))
        return plain(df, path, **how)

    monkeypatch.setattr(layers.io, "write_csv", seen)
    _, _, take = layers._two_batches(spark, sf_dir)
    for batch in (0, 1):
        take(batch)
    t = Tables(spark, sf_dir)
    lines = [p for p in parts if p[0] == "order_details"]
    assert len(lines) == 2 and all("Join" not in plan and how == "gzip" for _, plan, _, how in lines)
    late = t.orders.withColumnRenamed("o_orderdate", "order_date").where(layers.late_order("o_orderkey"))
    n = t.lineitem.join(late, t.lineitem.l_orderkey == late.o_orderkey, "left_semi").count()
    assert [p[2] for p in lines] == [t.lineitem.count() - n, n] and n > 0
