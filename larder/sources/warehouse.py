"""Tables by name, bucketed layouts, and layers published as versions.

A table saved in the session's catalog is read by name (``spark.read.table``). Tables
that meet on one key are saved in the same number of buckets of it, sorted, so that
joins and aggregates on the key read their buckets side by side and shuffle nothing.

A layer is published as a whole: it is built in a folder of its own version, and a
pointer file, put in place by one rename, makes it the current one. Readers have the old
version until then, and a build that fails changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import PARQUET, discard, scratch_path

# --------------------------------------------------------------- tables by name


def save_table(df: DataFrame, name: str, path: str | None = None, bucket_by: Sequence[str] = (), buckets: int | None = None,
               partition_by: Sequence[str] = (), dealt: bool = False) -> DataFrame:
    """Save ``df`` in the catalog as ``name`` and return it read by name.

    ``path`` makes it an external table there; without one it goes to the
    warehouse. ``bucket_by`` hashes the rows into ``buckets`` (the session's
    shuffle partitions unless given) sorted files: rows are dealt by the same hash before the
    write, so a bucket is one file. All rows of a key share a bucket, so bucket by a key that
    no value dominates. NULL keys are one value. ``dealt``: the rows are in ``buckets`` partitions by that hash
    already, and are written unsorted.
    """
    spark = df.sparkSession
    if bucket_by and not dealt:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.mode("overwrite").format("parquet").options(**PARQUET)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by)
        writer = writer if dealt else writer.sortBy(*bucket_by)
    writer.saveAsTable(name)
    return spark.read.table(name)


def deals_evenly(df: DataFrame, key: str, buckets: int, most: float = 4.0, few: int = 200_000) -> bool:
    """Whether no bucket of ``key`` has above ``most`` times its share of the rows (or all have at most ``few``)."""
    rows = df.groupBy(F.expr(f"pmod(hash(`{key}`), {int(buckets)})").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    found = rows.agg(F.max("n").alias("largest"), F.sum("n").alias("total")).first()
    return found["total"] is None or found["largest"] <= max(few, most * found["total"] / buckets)


class CatalogTables:
    """Tables of the catalog under a common prefix, by their short names."""

    def __init__(self, spark: SparkSession, prefix: str | None = None):
        self.spark, self.prefix = spark, prefix or f"larder_{uuid.uuid4().hex[:12]}_"
        self._root = None

    def save(self, name: str, df: DataFrame, **how) -> DataFrame:
        """``save_table`` under the prefix, in the shared folder of the session."""
        self._root = self._root or scratch_path(self.spark, "tables")
        return save_table(df, self.prefix + name, f"{self._root}/{name}", **how)

    def save_all(self, tables: Mapping[str, DataFrame], bucket_by: Mapping[str, Sequence[str]] | None = None, buckets: int | None = None) -> None:
        """Save tables; ``bucket_by`` names the bucket keys of those that have some."""
        for name, df in tables.items():
            keys = (bucket_by or {}).get(name, ())
            self.save(name, df, bucket_by=keys, buckets=buckets if keys else None)

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.table(self.prefix + name)

    def names(self) -> list[str]:
        return sorted(t.name[len(self.prefix):] for t in self.spark.catalog.listTables() if t.name.startswith(self.prefix))

    def drop(self) -> None:
        """Remove the tables from the catalog, and their files."""
        for name in self.names():
            self.spark.sql(f"DROP TABLE {self.prefix}{name}")
        if self._root:
            discard(self.spark, self._root)


# ------------------------------------------------------------ published versions

_VERSIONS, _POINTERS = "versions", "current"


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _pointers(spark: SparkSession, root: str) -> list[str]:
    """Names of the published versions, oldest first."""
    fs, folder = _files(spark, f"{root}/{_POINTERS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(n for n in names if not n.startswith("."))


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the version that readers see, or None before the first."""
    names = _pointers(spark, root.rstrip("/"))
    return f"{root.rstrip('/')}/{_VERSIONS}/{names[-1]}" if names else None


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current version."""
    path = current_version(spark, root)
    if path is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.parquet(f"{path}/{name}")


def publish(spark: SparkSession, root: str, build: Callable[[str], object], keep: int = 2) -> str:
    """Build a new version of a layer and make it the current one; return its folder.

    ``build`` gets the new version's folder and writes the layer's tables under it. Only
    when it returns, a pointer file is written aside and renamed into place under a name of its
    own: nothing that readers use is overwritten, so there is no moment without a
    version. If ``build`` raises, its folder is removed and the old version stays.
    The ``keep`` latest versions stay on disk for readers that began with one.
    """
    root = root.rstrip("/")
    before = _pointers(spark, root)
    number = int(before[-1].split("-")[0]) + 1 if before else 1
    version = f"{number:010d}-{uuid.uuid4().hex[:8]}"
    path = f"{root}/{_VERSIONS}/{version}"
    try:
        build(path)
    except BaseException:
        discard(spark, path)
        raise
    fs, aside = _files(spark, f"{root}/{_POINTERS}/.{version}")
    out = fs.create(aside, False)
    out.write(bytearray(version.encode()))
    out.close()
    _, place = _files(spark, f"{root}/{_POINTERS}/{version}")
    if not fs.rename(aside, place):
        raise OSError(f"could not publish {version} under {root}")
    published = _pointers(spark, root)
    for old in published[:-keep] if keep else []:
        # the pointer goes first: no reader is sent to a version that is being removed
        discard(spark, f"{root}/{_POINTERS}/{old}")
        discard(spark, f"{root}/{_VERSIONS}/{old}")
    return path


# ------------------------------------------------------------- touched partitions


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], gather: bool = True) -> DataFrame:
    """Write ``df`` over the partitions that it has rows of; other partitions' files stay as they are.

    ``gather=False``: the rows of a partition value lie together already (``files.gathered``).
    """
    df = df.hint("rebalance", *partition_by) if gather else df
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(*partition_by).parquet(path))
    return df.sparkSession.read.parquet(path)


def within(df: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``values`` (its one column), NULL among them if it holds one."""
    few = values.select(F.col(values.columns[0]).alias("_value")).distinct()
    return df.join(few, df[column].eqNullSafe(few["_value"]), "left_semi")
