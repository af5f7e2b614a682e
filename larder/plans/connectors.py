"""Queries exercising sources, sinks, streaming ingest and SQL over marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import adapters as A
from ..sources import files as io
from ..sources.tables import TABLES, Tables
from ..streaming.ingest import ingest_stream, rescued_by_file
from . import marts
from .registry import fct_order_items_of, fct_orders_of, query

# rules that group the test folder's files into datasets (one file per table)
TEST_FILE_RULES = tuple((t, "exact", f"{t}.parquet") for t in TABLES)


@query("csv_scan")
def q_csv_scan(spark, sf_dir):
    """orders -> CSV files (one per task) -> read back as a folder with declared types."""
    orders = Tables(spark, sf_dir).orders
    path = io.write_csv(orders, io.scratch_path(spark, "csv"))
    return io.csv_scan(spark, path, schema=orders.schema)


@query("csv_scan_files")
def q_csv_scan_files(spark, sf_dir):
    """The same files read as an explicit, sorted list of paths (one table).

    The list of paths is the feature; it grows with the number of files, not of rows.
    """
    orders = Tables(spark, sf_dir).orders
    path = io.write_csv(orders, io.scratch_path(spark, "csv"))
    files = spark.read.option("header", True).schema(orders.schema).csv(path).inputFiles()
    return io.csv_scan(spark, list(files), schema=orders.schema)


@query("csv_scan_inferred")
def q_csv_scan_inferred(spark, sf_dir):
    """Types inferred from the text, as the reference's batch reads do."""
    orders = Tables(spark, sf_dir).orders
    path = io.write_csv(orders, io.scratch_path(spark, "csv"))
    return io.csv_scan(spark, path)


@query("file_inventory")
def q_file_inventory(spark, sf_dir):
    return io.file_inventory(spark, sf_dir).select("name", "path", "size")


@query("file_groups")
def q_file_groups(spark, sf_dir):
    """Files and bytes per dataset: a table is one file or a folder of part files."""
    return io.file_groups(io.file_inventory(spark, sf_dir), TEST_FILE_RULES, by="entry")


@query("file_groups_written")
def q_file_groups_written(spark, sf_dir):
    """Three tables written as folders of files: rows counted per dataset that the files are grouped into."""
    t = Tables(spark, sf_dir)
    root = io.scratch_path(spark, "landing")
    for name in ("nation", "customer", "orders"):
        t[name].repartition(3).write.parquet(f"{root}/{name}.parquet")
    files = io.classify_files(io.file_inventory(spark, root, glob="*.parquet"), TEST_FILE_RULES, by="entry")
    rows = spark.read.format("parquet").option("recursiveFileLookup", True).schema("x int").load(root).select(
        F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    plain = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    return files.join(rows, plain(files.path) == plain(rows.path)).groupBy("dataset").agg(F.sum("rows").alias("rows"))


@query("csv_scan_file")
def q_csv_scan_file(spark, sf_dir):
    """One CSV file."""
    orders = Tables(spark, sf_dir).orders
    path = io.write_csv(orders.coalesce(1), io.scratch_path(spark, "csv"))
    file, = spark.read.text(path).inputFiles()
    return io.csv_scan(spark, file, schema=orders.schema)


@query("ingest_stream")
def q_ingest_stream(spark, sf_dir):
    """events.parquet picked up by a file stream and appended to a parquet table."""
    events = Tables(spark, sf_dir).events
    base = io.scratch_path(spark, "stream")
    # the table's own path, whether it is one file or a folder of part files
    return ingest_stream(spark, f"{sf_dir}/events.parquet", events.schema, f"{base}/table", f"{base}/_checkpoint",
                         fmt="parquet")


def _raw_orders_csv(spark, sf_dir) -> tuple[str, object]:
    """orders written as raw CSV text with an unparsable total on every 29th key and date on every 31st."""
    orders = Tables(spark, sf_dir).orders
    text = orders.withColumns({
        "o_totalprice": F.when(F.col("o_orderkey") % 29 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")),
        "o_orderdate": F.when(F.col("o_orderkey") % 31 == 0, F.lit("soon")).otherwise(F.col("o_orderdate").cast("string"))})
    path = io.write_csv(text, io.scratch_path(spark, "rawcsv"))
    return path, orders.schema


def _rescued_orders(spark, sf_dir, **options):
    path, schema = _raw_orders_csv(spark, sf_dir)
    base = io.scratch_path(spark, "stream")
    return ingest_stream(spark, path, schema, f"{base}/table", f"{base}/_checkpoint",
                         fmt="csv", glob="*.csv", rescue=True, **options)


@query("ingest_rescue")
def q_ingest_rescue(spark, sf_dir):
    """Rows and rescued rows over the per-file counts of the ingested files."""
    return rescued_by_file(_rescued_orders(spark, sf_dir, with_file_name=True)).agg(
        F.sum("rows").alias("rows"), F.sum("rescued_rows").alias("rescued_rows"))


@query("ingest_rescue_fields")
def q_ingest_rescue_fields(spark, sf_dir):
    """Rows that didn't parse: their key, the fields that did and the bad fields alone."""
    return _rescued_orders(spark, sf_dir).where("_rescued_data IS NOT NULL").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_orderdate").isNull().alias("no_date"), "_rescued_data")


@query("ingest_rescue_total")
def q_ingest_rescue_total(spark, sf_dir):
    return _rescued_orders(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("_rescued_data").alias("rescued_rows"),
        F.count_if(F.col("o_totalprice").isNull()).alias("null_totals"),
    )


SURPLUS = "landed_by"


def _landed(spark, sf_dir, name: str):
    """One raw table landed as CSV files of two forms: its own column order, and the reverse with a surplus column."""
    raw = A.raw(Tables(spark, sf_dir), name).drop("_rescued_data")
    odd = F.pmod(F.col(A.PRIMARY_KEYS[name][0]), F.lit(2)) == 1
    landing = io.write_csv(raw.where(~odd), io.scratch_path(spark, "landing"))
    turned = raw.where(odd).select(*reversed(raw.columns), F.lit("till").alias(SURPLUS))
    return raw, io.write_csv(turned, landing, mode="append")


def _ingested(spark, sf_dir, name: str, inferred: bool = False, **how):
    """The landed files of a raw table, read by a file stream by their headers, with declared or inferred types."""
    raw, landing = _landed(spark, sf_dir, name)
    base = io.scratch_path(spark, "stream")
    return ingest_stream(spark, landing, None if inferred else raw.schema, f"{base}/table", f"{base}/_checkpoint", fmt="csv",
                         glob="*.csv", options=LANDED, **how)


def _ingest_query(name: str):
    return lambda spark, sf_dir: _ingested(spark, sf_dir, name)


def _inferred_query(name: str):
    """Types inferred from the files; the surplus column is one of the table's when the first batch has it."""
    return lambda spark, sf_dir: _ingested(spark, sf_dir, name, inferred=True)


@query("ingest_by_name")
def q_ingest_by_name(spark, sf_dir):
    """Key, total and rescued fields of orders from files of two column orders, types declared."""
    return _ingested(spark, sf_dir, "orders", rescue=True).select("order_id", "total_amount", "order_status", "_rescued_data")


# texts may hold line feeds and quotes, and padded values keep their spaces
LANDED = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "multiLine": "true", "escape": '"'}
for _name in A.SOURCES:
    query(f"ingest_{_name}")(_ingest_query(_name))
    query(f"ingest_inferred_{_name}")(_inferred_query(_name))


@query("materialize_roundtrip")
def q_materialize_roundtrip(spark, sf_dir):
    mart = marts.agg_revenue_by_category(fct_order_items_of(Tables(spark, sf_dir)))
    return io.materialize(mart, io.scratch_path(spark, "mart"))


@query("materialize_partitioned")
def q_materialize_partitioned(spark, sf_dir):
    """fct_orders written partitioned by year_month; a month filter prunes partitions."""
    fct = fct_orders_of(Tables(spark, sf_dir))
    return io.materialize(fct, io.scratch_path(spark, "fct"), partition_by=["year_month"])


@query("usage_monthly_trend")
def q_usage_monthly_trend(spark, sf_dir):
    t = Tables(spark, sf_dir)
    mart = marts.agg_revenue_monthly(fct_orders_of(t), fct_order_items_of(t))
    return spark.sql(
        "SELECT year_month, revenue, aov, gross_margin_pct FROM {m} ORDER BY year_month", m=mart)


@query("usage_top_items")
def q_usage_top_items(spark, sf_dir):
    mart = marts.agg_item_performance(fct_order_items_of(Tables(spark, sf_dir)))
    return spark.sql(
        "SELECT restaurant_id, item_id, units_sold, revenue, margin_pct FROM {p} "
        "ORDER BY restaurant_id, revenue DESC", p=mart)


@query("gold_refresh")
def q_gold_refresh(spark, sf_dir):
    """All 22 gold tables written in dependency order; rows per written table."""
    from .refresh import refresh_gold, table_row_counts
    from .registry import AS_OF
    t = Tables(spark, sf_dir)
    silver = {name: A.source(t, name) for name in A.SOURCES}
    written = refresh_gold(silver, io.scratch_path(spark, "gold"), AS_OF, by_month=A.BY_MONTH)
    return table_row_counts(written)


@query("gold_refresh_monthly")
def q_gold_refresh_monthly(spark, sf_dir):
    """fct_orders (with per-order margin) written partitioned by month, and the
    monthly mart computed from the written table, as a refresh does it."""
    from .registry import fct_orders_priced_of
    fct = io.materialize(fct_orders_priced_of(Tables(spark, sf_dir)), io.scratch_path(spark, "gold"),
                         partition_by=["year_month"])
    return marts.agg_revenue_monthly(fct)


@query("ingest_clean_orders")
def q_ingest_clean_orders(spark, sf_dir):
    """Raw orders landed as CSV files -> file stream (bronze, declared schema) -> clean_orders (silver)."""
    from . import silver
    raw = A.raw(Tables(spark, sf_dir), "orders")
    landing = io.write_csv(raw, io.scratch_path(spark, "landing"))
    base = io.scratch_path(spark, "stream")
    bronze = ingest_stream(spark, landing, raw.schema, f"{base}/table", f"{base}/_checkpoint",
                           fmt="csv", glob="*.csv",
                           options={"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return silver.clean_orders(bronze)
