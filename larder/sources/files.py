"""File sources and sinks: CSV scans, file inventory, file grouping, materialised tables.

Scratch output (CSV copies, materialised tables, stream sinks) goes under the
session's shared checkpoint folder; a machine-local one is used by local sessions
only (see ``session.checkpoint_dir``).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import checkpoint_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/larder-{label}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------------- CSV

def csv_scan(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None,
             header: bool = True, **options) -> DataFrame:
    """Read one file, a list of files (one table) or a directory of CSV files.

    With ``schema`` the types are declared (recommended: inference reads the
    data twice and silently turns a dirty column into text); without it the
    types are inferred like the reference's batch reads.
    """
    reader = spark.read.option("header", header).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    if isinstance(paths, str):
        return reader.csv(paths)
    return reader.csv(sorted(paths))


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", compression: str = "none") -> str:
    """Write CSV files keeping values exactly (the writer trims spaces by default)."""
    (df.write.mode(mode).option("header", header).option("compression", compression)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("escape", chr(34))
     .csv(path))
    return path


# ---------------------------------------------------------- file inventory

def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder and what is in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def file_inventory(spark: SparkSession, root: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """name, entry, path, size, modified for every file under ``root``.

    ``entry`` is the first part of the path below ``root``: the file itself, or the
    folder a table's part files are in.

    The listing is distributed by the binaryFile source; only path, length and
    modification time are selected, so file contents are never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(root)
    # paths come back as URIs; the folder is told by its own path part
    folder = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*(?=/)", "", root).rstrip("/").split("/")[-1]
    below = F.substring_index(F.col("path"), f"/{folder}/", -1)
    return df.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.substring_index(below, "/", 1).alias("entry"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


# Fixed values that must equal the reference's: how raw file names map to
# datasets, checked in this order; ("prefix", p) matches names starting with p,
# ("exact", n) matches the name n.
REFERENCE_FILE_RULES = (
    ("customer_reviews", "prefix", "customer_reviews_"),
    ("customers", "exact", "customers.csv"),
    ("daily_operations", "prefix", "daily_operations_"),
    ("delivery_performance", "prefix", "delivery_performance_"),
    ("employees", "exact", "employees.csv"),
    ("inventory", "prefix", "inventory_"),
    ("menu_items", "exact", "menu_items.csv"),
    ("order_details", "prefix", "order_details_"),
    ("orders", "prefix", "orders_"),
    ("restaurants", "exact", "restaurants.csv"),
)


def classify_files(files: DataFrame, rules=REFERENCE_FILE_RULES, by: str = "name") -> DataFrame:
    """Add ``dataset`` from the first matching (dataset, kind, pattern) rule on column ``by``.

    ``by="entry"`` groups the part files of a folder-shaped table under the folder. kinds: ``prefix``, ``exact`` or ``regex``; unmatched files get NULL.
    """
    name = F.col(by)
    expr = None
    for dataset, kind, pattern in rules:
        if kind == "prefix":
            cond = name.startswith(pattern)
        elif kind == "exact":
            cond = name == pattern
        elif kind == "regex":
            cond = name.rlike(pattern)
        else:
            raise ValueError(kind)
        expr = F.when(cond, F.lit(dataset)) if expr is None else expr.when(cond, F.lit(dataset))
    return files.withColumn("dataset", expr if expr is not None else F.lit(None).cast("string"))


def file_groups(files: DataFrame, rules=REFERENCE_FILE_RULES, by: str = "name") -> DataFrame:
    """dataset -> number of files, total bytes, first and last path (sorted).

    The per-dataset path list itself stays distributed (``classify_files``);
    a dataset can hold millions of files, so it is not collected into one row.
    """
    return classify_files(files, rules, by).where(F.col("dataset").isNotNull()).groupBy("dataset").agg(
        F.expr("count(1) AS files"), F.expr("sum(size) AS total_bytes"),
        F.expr("min(path) AS first_path"), F.expr("max(path) AS last_path"))


# ------------------------------------------------------------ materialising

# pages of version 2 hold whole numbers as packed differences
PARQUET = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def gathered(df: DataFrame, by: str) -> DataFrame:
    """``df`` with the rows of one value of the SQL expression ``by`` brought together, as ``materialize`` does.

    For a table whose partition column and others are derived from fewer columns: gather
    those, derive the rest, and materialize with ``gather=False``, so that less is moved.
    """
    return df.withColumn("_by", F.expr(by)).hint("rebalance", "_by").drop("_by")


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", gather: bool = True) -> DataFrame:
    """Write ``df`` as a table (overwrite, parquet by zstd) and return the table read back.

    Reading back cuts the lineage: later jobs start from the written files.
    An ordering of ``df`` is not kept by storage; sort where it is consumed.
    ``gather=False``: the rows of a partition value lie together already (``gathered``).
    """
    if partition_by and gather:
        # REBALANCE lets AQE size the output files: rows of one partition value
        # are gathered (few files per value instead of one per task), and a value
        # holding a large share of the rows is split over several tasks
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "parquet":
        writer = writer.options(**PARQUET)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return df.sparkSession.read.format(fmt).load(path)
