"""Tables by name, published versions, touched months, sketches, hot keys, write-time audits, located differences."""

import os
import random

import pytest
from pyspark.sql import functions as F

from larder.operators import locate, observe, sketch, skew
from larder.plans import facts, layers, marts, refresh
from larder.plans.quality import layer_pairs
from larder.sources import adapters as A
from larder.sources import warehouse as W
from larder.sources.tables import Tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --------------------------------------------------------------- tables by name

def test_bucketed_tables_join_without_a_shuffle(spark, sf_dir, no_broadcast):
    t = Tables(spark, sf_dir)
    tables = W.CatalogTables(spark)
    tables.save_all({"orders": A.orders(t), "order_details": A.order_details(t)}, layers.BY_ORDER, buckets=6)
    fct = facts.fct_orders(tables["orders"], tables["order_details"])
    assert "Exchange" not in plan_of(fct)                                       # orders and line summary
    items = facts.fct_order_items(tables["order_details"], tables["orders"], A.menu_items(t))
    assert "hashpartitioning(order_id" not in plan_of(items)                    # lines and orders
    tables.save("fct_orders", fct, bucket_by=["order_id"], buckets=6)
    tables.save("fct_order_items", items, bucket_by=["order_id"], buckets=6)
    with_margin = tables["fct_orders"].join(facts.order_margins(tables["fct_order_items"]), "order_id", "left")
    assert "Exchange" not in plan_of(with_margin)                               # orders and margins
    assert marts.agg_revenue_monthly(tables["fct_orders"], tables["fct_order_items"]).count() > 0
    assert tables.names() == ["fct_order_items", "fct_orders", "order_details", "orders"]
    tables.drop()
    assert tables.names() == []


# ------------------------------------------------------------- published versions

def test_a_failed_build_leaves_the_published_version(spark, tmp_path):
    root = str(tmp_path / "gold")
    assert W.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        W.read_published(spark, root, "t")
    first = W.publish(spark, root, lambda path: spark.range(3).write.parquet(f"{path}/t"))
    reader = W.read_published(spark, root, "t")

    def fails(path):
        spark.range(9).write.parquet(f"{path}/t")
        assert W.current_version(spark, root) == first       # nothing shows before the build is done
        raise ValueError("lost")

    with pytest.raises(ValueError):
        W.publish(spark, root, fails)
    assert W.read_published(spark, root, "t").count() == 3
    assert len(os.listdir(f"{root}/versions")) == 1
    W.publish(spark, root, lambda path: spark.range(5).write.parquet(f"{path}/t"))
    assert W.read_published(spark, root, "t").count() == 5
    assert reader.count() == 3                               # a reader that began with the old version still has it
    W.publish(spark, root, lambda path: spark.range(6).write.parquet(f"{path}/t"))
    assert W.read_published(spark, root, "t").count() == 6
    assert len(os.listdir(f"{root}/versions")) == 2 and first.split("/")[-1] not in os.listdir(f"{root}/versions")


def test_published_gold_reads_one_version(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    silver = {name: A.source(t, name) for name in A.SOURCES}
    root = str(tmp_path / "gold")
    tables = refresh.publish_gold(silver, root, "2001-12-31")
    assert set(tables) == set(refresh.GOLD_TABLES)
    folder = W.current_version(spark, root)
    assert all(f.startswith(f"file:{folder}/") or f.startswith(f"file://{folder}/") for f in tables["fct_orders"].inputFiles())


# ------------------------------------------------------------------ touched months

def stamps(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_only_touched_months_are_rewritten(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    orders, details, menu = A.orders(t), A.order_details(t), A.menu_items(t)
    late = "order_date >= DATE'1995-03-01' AND order_date < DATE'1995-05-01' AND order_id % 2 = 0"
    new = orders.where(late)
    old = orders.where(f"NOT ({late})")
    moved = details.join(old.where("year(order_date) = 1996 AND month(order_date) = 7").select("order_id").limit(1), "order_id", "left_semi")
    target = str(tmp_path / "gold")
    refresh.refresh_months(old, details, menu, refresh.touched_months(old, details, old), target)
    before = stamps(target)
    months = refresh.touched_months(new, moved, orders)
    assert sorted(r.year_month for r in months.collect()) == ["1995-03", "1995-04", "1996-07"]
    out = refresh.refresh_months(orders, details, menu, months, target)
    after = stamps(target)
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed and all(any(f"year_month={m}" in p for m in ("1995-03", "1995-04", "1996-07")) for p in changed)
    full = facts.fct_orders(orders, details, facts.order_line_summary(details, menu))
    cols = full.columns
    assert out["fct_orders"].select(cols).exceptAll(full).count() == 0 and full.exceptAll(out["fct_orders"].select(cols)).count() == 0
    mart = marts.agg_revenue_monthly(full)
    assert out["agg_revenue_monthly"].select(mart.columns).exceptAll(mart).count() == 0 and mart.count() == out["agg_revenue_monthly"].count()


# ------------------------------------------------------------------------ sketches

def test_quartiles_of_merged_sketches_keep_their_rank_error(spark, tmp_path):
    n = 120_000
    df = spark.range(n).selectExpr("id % 7 AS part", "pow(rand(3), 3) * 1000 AS x", "CAST(CASE WHEN id % 10 < 4 THEN 5 ELSE id % 1000 END AS INT) AS y",
                                   "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 500 = 1 THEN 1e6 + id ELSE id % 100 + 0.5D END AS z")
    table = str(tmp_path / "t")
    df.write.partitionBy("part").parquet(table)
    df = spark.read.parquet(table)
    stored = sketch.update_sketches(df, ["x", "y", "z"], "part", str(tmp_path / "s"))
    assert stored.count() == 21
    got = {r.column: r for r in sketch.outliers_from_sketches(stored, min_distinct=0, max_distinct_share=2).collect()}
    for c in "xyz":
        r, values = got[c], df.where(F.col(c).isNotNull())
        rows = values.count()
        for p, v in ((0.25, r.q1), (0.75, r.q3)):
            below, upto = values.where(F.col(c) < v).count(), values.where(F.col(c) <= v).count()
            assert below - p * rows <= sketch.KLL_RANK_ERROR * rows and p * rows - upto <= sketch.KLL_RANK_ERROR * rows
        out = values.where((F.col(c) < r.lower_bound) | (F.col(c) > r.upper_bound)).count()
        assert abs(out - r.outlier_estimate) <= r.outlier_error
        exact = values.select(c).distinct().count() + (values.count() < n)
        assert abs(r.distinct_estimate - exact) <= sketch.HLL_ERROR * exact + 1


def test_a_second_audit_reads_new_parts_alone(spark, tmp_path):
    table, store = str(tmp_path / "t"), str(tmp_path / "s")
    rows = spark.range(1000).selectExpr("CAST(id % 4 AS STRING) AS part", "CAST(id AS DOUBLE) AS x")
    rows.where("part < '3'").write.partitionBy("part").parquet(table)
    schema = "x double, part string"
    assert sketch.update_sketches(spark.read.schema(schema).parquet(table), ["x"], "part", store).count() == 3
    for part in "012":                                       # what was audited can't be read any more
        for f in os.listdir(f"{table}/part={part}"):
            os.chmod(f"{table}/part={part}/{f}", 0o644)
            with open(f"{table}/part={part}/{f}", "wb") as out:
                out.write(b"gone")
    rows.where("part = '3'").write.mode("append").partitionBy("part").parquet(table)
    stored = sketch.update_sketches(spark.read.schema(schema).parquet(table), ["x"], "part", store)
    assert {r.part: r.rows for r in stored.collect()} == {"0": 250, "1": 250, "2": 250, "3": 250}
    assert sketch.update_sketches(spark.read.schema(schema).parquet(table), ["x"], "part", store).count() == 4
    total = sketch.merged_sketches(stored).first()
    assert (total.rows, total.nulls) == (1000, 0)


def test_distinct_estimates_keep_their_error(spark):
    df = spark.range(100_000).selectExpr("CAST(id AS STRING) AS a", "id % 50 AS b", "CASE WHEN id % 3 > 0 THEN id DIV 10 END AS c", "CAST(NULL AS INT) AS d")
    got = {r.column: r.distinct_estimate for r in sketch.distinct_estimates(df, ["a", "b", "c", "d"]).collect()}
    for c, exact in {"a": 100_000, "b": 50, "c": 10_001, "d": 1}.items():
        assert abs(got[c] - exact) <= sketch.HLL_ERROR * exact
    # only sketches are shuffled
    assert "hashpartitioning" not in plan_of(sketch.distinct_estimates(df, ["a", "b"]))


def test_reconciled_sketches_see_values_of_one_side(spark):
    left = spark.range(5000).selectExpr("id AS same", "id AS less", "CASE WHEN id > 0 THEN id END AS nulled", "id AS moved")
    right = spark.range(5000).selectExpr("id AS same", "id DIV 2 AS less", "id AS nulled", "id + 100 AS moved")
    got = {r.column: r.differ for r in sketch.reconcile_estimates(left, right, left.columns).collect()}
    assert got == {"same": False, "less": True, "nulled": True, "moved": True}
    none = sketch.reconcile_estimates(left.limit(0), left.limit(0), ["same"]).first()
    assert (none.left_estimate, none.union_estimate, none.differ) == (0, 0, False)


def test_casing_by_sketches(spark):
    df = spark.createDataFrame([("a", "x", None), ("A", "x", None), ("b", "y", None)], "p string, q string, r string")
    got = {r.column: (r.distinct_estimate, r.lower_estimate, r.inconsistent) for r in sketch.casing_estimates(df, ["p", "q", "r"]).collect()}
    assert got == {"p": (3, 2, True), "q": (2, 2, False), "r": (1, 1, False)}


def test_frequent_values_of_a_wide_column(spark):
    rng = random.Random(5)
    values = ["hot"] * 9000 + ["warm"] * 500 + [f"v{rng.randrange(10**9)}" for _ in range(30_000)] + [None] * 200
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "x string").repartition(7)
    got = {r.value: r for r in sketch.frequent_values(df, ["x"], share=0.01, tracked=1024).collect()}
    assert {"hot", "warm"} <= set(got)
    for value, exact in {"hot": 9000, "warm": 500}.items():
        assert exact <= got[value]["count"] <= exact + got[value].count_error
    few = spark.createDataFrame([(v,) for v in "aabbbcccc"], "x string")
    assert {(r.value, r["count"], r.count_error) for r in sketch.frequent_values(few, ["x"]).collect()} == {("a", 2, 0), ("b", 3, 0), ("c", 4, 0)}
    with pytest.raises(ValueError):
        sketch.frequent_values(few, ["x"], share=0.001, tracked=1024)


def test_bitmaps_count_distinct_ids(spark):
    df = spark.range(20_000).selectExpr("id % 5 AS day", "id % 2 AS shop", "CASE WHEN id % 17 = 0 THEN NULL ELSE (id * 7919) % 90000 END AS who")
    daily = sketch.id_bitmaps(df, ["day", "shop"], "who")
    for keys in (["day", "shop"], ["shop"], []):
        rolled = sketch.roll_up_bitmaps(daily, {k: k for k in keys})
        got = {tuple(r[k] for k in keys): r.n for r in sketch.count_bitmaps(rolled, keys, "n").collect()}
        exact = df.groupBy(*keys).agg(F.countDistinct("who").alias("n"))
        assert got == {tuple(r[k] for k in keys): r.n for r in exact.collect()}
    assert sketch.count_bitmaps(sketch.id_bitmaps(df.limit(0), ["day"], "who"), ["day"], "n").count() == 0


# ------------------------------------------------------------------------ hot keys

def test_a_hot_key_alone_is_split(spark, no_broadcast):
    big = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 1000 = 7 THEN NULL ELSE id % 997 + 2 END AS item")
    small = spark.range(1, 900).selectExpr("id AS item", "id * 10 AS price").union(spark.createDataFrame([(1, 11), (None, 5)], "item long, price long"))
    assert [(r.item, r.parts) for r in skew.hot_keys(big, "item", 16).collect()] == [(1, 6)]
    for how in ("left", "inner"):
        got = skew.salted_join(big, small, "item", ["id"], 16, how)
        plain = big.join(small, "item", how)
        assert got.columns == plain.columns
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        skew.salted_join(big, small, "item", ["id"], how="full")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        largest = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        assert largest(skew.salted_join(big, small, "item", ["id"], 16)) < 0.7 * largest(big.join(small, "item", "left"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert skew.salted_join(big.limit(0), small, "item", ["id"]).count() == 0


# ----------------------------------------------------------------- audits at write time

ROWS = [(1, -2.0, "a"), (2, None, None), (3, float("nan"), "b")]


def test_metrics_of_the_write_equal_a_scan(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id long, x double, s string")
    written, metrics = observe.write_observed(df, "t", str(tmp_path / "t"), ["x", "absent"])
    assert written.count() == 3
    expected = {("t", None, "rows", 3), ("t", "id", "nulls", 0), ("t", "x", "nulls", 2), ("t", "s", "nulls", 1), ("t", "x", "negatives", 1)}
    assert {tuple(r) for r in metrics.collect()} == expected
    assert [tuple(r) for r in observe.negatives(metrics).collect()] == [("t", "x", 1)]
    assert {(r.column, r.null_count, r.null_pct) for r in observe.nulls(metrics).collect()} == {("x", 2, 66.67), ("s", 1, 33.33)}
    assert tuple(observe.overview(metrics).first()) == ("t", 3, 3)
    _, empty = observe.write_observed(df.limit(0), "e", str(tmp_path / "e"))
    assert {r.value for r in empty.collect()} == {0}


def test_metrics_counted_twice_are_taken_from_the_table(spark, tmp_path, monkeypatch):
    class Twice(observe.Observation):
        @property
        def get(self):
            return {k: v * 2 for k, v in super().get.items()}

    monkeypatch.setattr(observe, "Observation", Twice)
    _, metrics = observe.write_observed(spark.createDataFrame(ROWS, "id long, x double, s string"), "t", str(tmp_path / "t"))
    assert {(r.column, r.value) for r in metrics.collect()} == {(None, 3), ("id", 0), ("x", 2), ("s", 1)}


# ------------------------------------------------------------------ located differences

def test_planted_differences_are_found(spark):
    left = spark.range(3000).selectExpr("id", "id % 7 AS a", "CAST(id AS DOUBLE) AS b", "concat('v', id) AS c", "CASE WHEN id % 5 > 0 THEN id END AS d")
    right = left.selectExpr("CASE WHEN id = 5 THEN 9999 ELSE id END AS id", "CASE WHEN id IN (17, 18) THEN -1 ELSE a END AS a", "CAST(b AS FLOAT) AS b",
                            "CASE WHEN id = 18 THEN NULL ELSE c END AS c", "CASE WHEN id = 10 THEN 0 ELSE d END AS d")
    got = {tuple(r) for r in locate.differences(left, right, ["id"]).collect()}
    assert got == {(5, None, "left_only", None, None), (9999, None, "right_only", None, None), (17, "a", "changed", "3", "-1"),
                   (18, "a", "changed", "4", "-1"), (18, "c", "changed", "v18", None), (10, "d", "changed", None, "0")}
    buckets = locate.differing_buckets(left, right, ["id"], ["a", "b", "c", "d"])
    assert 0 < buckets.count() <= 6


def test_equal_tables_differ_nowhere(spark):
    left = spark.range(500).selectExpr("id % 100 AS k", "CAST(id AS STRING) AS v", "-0.0D AS z")
    right = left.selectExpr("k", "v", "0.0D AS z").repartition(5)
    assert locate.differences(left, right, ["k"]).count() == 0
    assert locate.differing_buckets(left, right, ["k"], ["v", "z"]).count() == 0
    assert locate.differences(left.limit(0), right.limit(0), ["k"]).count() == 0


def test_repeated_and_null_keys(spark):
    schema = "k long, j string, v int"
    left = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (None, "a", 3), (2, None, 4)], schema)
    right = spark.createDataFrame([(1, "a", 2), (1, "a", 1), (None, "a", 5), (2, None, 4), (2, None, 4)], schema)
    got = {tuple(r) for r in locate.differences(left, right, ["k", "j"]).collect()}
    assert got == {(None, "a", "v", "changed", "3", "5"), (2, None, "v", "changed", "4", "4"), (2, None, None, "rows", "1", "2")}


def test_differences_of_every_table_are_located(spark, sf_dir):
    found = layers.q_located_differences(spark, sf_dir).collect()
    assert {r.table for r in found} == set(A.SOURCES)
    # a cell that cleaning changed counts once, also where the declared key repeats
    raw, clean = layer_pairs(Tables(spark, sf_dir))["inventory"]
    keys = ["restaurant_id", "item_id", "date"]
    assert raw.select(*keys).distinct().count() == raw.count() > raw.select("inventory_id").distinct().count()
    filled = raw.where("waste_stock IS NULL").count()
    assert [r.cells for r in found if (r.table, r.column) == ("inventory", "waste_stock")] == [filled]


def test_counts_are_those_of_the_differences(spark):
    left = spark.range(4000).selectExpr("id % 3000 AS k", "CASE WHEN id % 9 > 0 THEN concat('v', id) END AS s", "id % 7 AS same", "CAST(id % 50 AS INT) AS n", "id * 0.5D AS d")
    right = left.where("k <> 11").selectExpr("CASE WHEN k = 5 THEN 9999 ELSE k END AS k", "CASE WHEN k % 10 = 1 THEN concat(s, ' ') WHEN k % 10 = 2 THEN NULL ELSE s END AS s",
                                             "same", "CAST(CASE WHEN k % 100 = 3 THEN NULL ELSE n END AS DOUBLE) AS n", "d").union(
        spark.createDataFrame([(17, "more", 1, 2.0, 3.0)], "k long, s string, same long, n double, d double"))
    counted = locate.differences(left, right, ["k"]).groupBy("column", "kind").count()
    got = {tuple(r) for r in locate.difference_counts(left, right, ["k"]).collect()}
    assert got == {tuple(r) for r in counted.collect()} and {k for _, k, _ in got} == {"changed", "left_only", "right_only", "rows"}
    assert locate.difference_counts(left, left, ["k"]).count() == 0


def test_columns_that_differ_nowhere_do_not_move(spark):
    left = spark.range(500).selectExpr("id AS k", "concat('untouched ', id) AS same", "id % 3 AS v")
    right = left.withColumn("v", F.expr("CASE WHEN k % 2 = 0 THEN v END"))
    for df in (locate.differences(left, right, ["k"]), locate.difference_counts(left, right, ["k"])):
        assert "untouched" not in plan_of(df)
