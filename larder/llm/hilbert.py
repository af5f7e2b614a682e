"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into cells of about equal row counts, the cells'
Hilbert index orders the rows, and runs of that order become shards. Rows of a
shard are close in every dimension, so minimum and maximum of each column let a
reader skip most shards.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import numbered, stored


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points: (rows, dims) below 2**bits -> (rows,) int64."""
    x = np.array(cells, dtype=np.int64).T.copy()
    dims = len(x)
    if dims * bits > 62:
        raise ValueError("dims * bits must be at most 62")
    # undo excess work from the highest bit down
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(on, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def string_cuts(df: DataFrame, name: str, cells: int) -> list[str]:
    """Whole strings at which each cell but the last ends, by row counts; a string with many rows ends several.

    Distinct strings are counted map-side, sorted once over range partitions, and summed up
    in each; at most ``cells`` strings come to the driver.
    """
    counts = df.where(F.col(f"`{name}`").isNotNull()).groupBy(F.col(f"`{name}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    kept = stored(counts.repartitionByRange("v").withColumn("_pid", F.spark_partition_id()))
    sums = kept.groupBy("_pid").agg(F.sum("n").alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_total"))
    within = Window.partitionBy("_pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = kept.join(F.broadcast(offsets), "_pid").withColumn("_upto", F.sum("n").over(within) + F.col("_before"))
    ends = upto.select("v", F.expr(f"least((_upto * {cells}) div _total, {cells - 1}) - ((_upto - n) * {cells}) div _total").alias("k"))
    return [r.v for r in ends.where("k > 0").orderBy("v").collect() for _ in range(r.k)]


def with_hilbert(df: DataFrame, dims: list[str], bits: int = 8, out: str = "hilbert") -> DataFrame:
    """Add the Hilbert index of ``dims``.

    Cell borders are quantiles: of numbers approximate ones from one aggregate, of strings
    those of their whole values by row counts (at most 2**bits per dimension), so a
    skewed dimension still spreads over the cells; null values take the first cell.
    """
    size = 1 << bits
    steps = [k / size for k in range(1, size)]
    numbers = [d for d in dims if not _is_text(df, d)]
    row = df.agg(*[F.percentile_approx(F.col(f"`{d}`").cast("double"), steps, 2000).alias(f"d{i}") for i, d in enumerate(numbers)]).first() if numbers else []
    # repeated borders stay: a value with many rows skips as many cells, so few values still spread over all cells
    cuts = {d: np.array(row[i] if row[i] is not None else [], dtype=float) for i, d in enumerate(numbers)}
    cuts |= {d: string_cuts(df, d, size) for d in dims if d not in cuts}

    def cells(d: str, v: pd.Series) -> np.ndarray:
        if d in numbers:
            x = v.to_numpy(dtype=float, na_value=np.nan)
            return np.where(np.isnan(x), 0, np.searchsorted(cuts[d], x, side="left"))
        codes, values = pd.factorize(v)
        found = np.array([bisect_left(cuts[d], x) for x in values] + [0], dtype=np.int64)
        return found[codes]  # code -1, null, takes the last

    @F.pandas_udf("long")
    def index(*cols: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([cells(d, c) for d, c in zip(dims, cols)], axis=1), bits))

    return df.withColumn(out, index(*[F.col(f"`{d}`") if _is_text(df, d) else F.col(f"`{d}`").cast("double") for d in dims]))


def shard_rows(df: DataFrame, dims: list[str], ties: list[str], shards: int, bits: int = 8) -> DataFrame:
    """``df`` with ``hilbert``, ``shard`` (0 ..) and ``slot`` (0 .. in its shard).

    Shards are runs of the curve's order and their row counts differ by one at
    most. ``ties`` order rows of one cell; rows equal in all of them are
    interchangeable. A cell that holds a third of all rows is split over range
    partitions by the ties. An empty table gives an empty one.
    """
    placed = numbered(with_hilbert(df, dims, bits), ["hilbert", *ties], "_pos", "_total")
    shard = F.expr(f"(_pos * {shards}L) div _total")
    first = F.expr(f"(shard * _total + {shards - 1}L) div {shards}L")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("_pos") - first)
            .withColumn("shard", F.col("shard").cast("int")).drop("_pos", "_total"))


def document_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert, lang, source, n_chars).

    The curve runs over language, source and length. ``size`` is the text's
    UTF-8 bytes plus one; a null text has none and the checksum of empty text.
    The law is ``rows``. Repeated rows and equal texts keep a slot each; null
    ids sort first.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), "lang", "source",
                       F.col("n_chars").cast("long").alias("n_chars"))
    placed = shard_rows(rows, ["lang", "source", "n_chars"], ["doc_id", "text_crc32", "size"], shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "hilbert", "lang", "source", "n_chars")


def shard_ranges(placed: DataFrame, dims: list[str]) -> DataFrame:
    """Rows, minimum and maximum of each dimension per shard: what a reader prunes by."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *[
        f(F.col(d)).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))])
