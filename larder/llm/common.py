"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_IDX_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder (lineage ends there)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks, beside the JVM's heap."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


_libc = ctypes.CDLL(None)


def text_batches(batches: Iterator[pa.RecordBatch], max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each slice holds about ``max_bytes`` (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        step = max(1, min(n, int(n * max_bytes / max(1, batch.nbytes))))
        for i in range(0, n, step):
            yield batch.slice(i, step)
    give_back()


def numbered(df: DataFrame, order: list[str], pos: str, total: str) -> DataFrame:
    """Rows in total ``order`` with their 0-based position and the row count.

    One range shuffle, kept in the checkpoint folder so that partitions stay
    fixed when executors are lost. Positions are the row counts of earlier
    partitions (one row per partition, so the window and broadcast are bounded
    by the partition count) plus the row's number in its own partition.
    """
    kept = stored(df.repartitionByRange(*order).sortWithinPartitions(*order))
    rows = kept.withColumn("_mid", F.monotonically_increasing_id()).withColumns({
        "_pid": F.shiftright("_mid", _IDX_BITS), "_idx": F.expr(f"_mid & {(1 << _IDX_BITS) - 1}")})
    sizes = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy()).alias(total))
    return (rows.join(F.broadcast(offsets), "_pid")
            .withColumn(pos, F.col("_before") + F.col("_idx")).drop("_pid", "_mid", "_idx", "_before"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node reachable over ``edges`` (a, b).

    Alternates large-star and small-star rounds, which need a number of rounds
    logarithmic in the component size. Every round is grouped with map-side
    minima, so a node with many edges is reduced before the shuffle, and is
    kept in the checkpoint folder. Nodes without an edge to another node are
    not returned.
    """
    e = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u != v").distinct())

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.where("v < u")
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = both.join(low, "u")
        if large:  # repeated pairs go in the small star after it
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u != v").distinct()

    last = None
    for _ in range(max_rounds):
        e = stored(star(star(e, True), False))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
