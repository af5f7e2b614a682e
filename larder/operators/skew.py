"""Joins on a key with hot values: only the hot ones are split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, pieces: int = 256) -> DataFrame:
    """(key, parts) for each value of ``key`` with more than a ``pieces``-th of the rows: how many such shares it has.

    Counted with map-side combine. Fewer than ``pieces`` values can be hot, at any size of the table.
    """
    share = df.agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(pieces)), F.lit(1))).scalar()
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > share).select(key, F.ceil(F.col("_n") / share).cast("int").alias("parts"))


def salted_join(big: DataFrame, small: DataFrame, key: str, spread_by: Sequence[str], pieces: int = 256, how: str = "left") -> DataFrame:
    """``big`` joined to ``small`` on ``key``, hot values of ``big`` spread over tasks; same rows as the plain join.

    The values of ``hot_keys`` (fewer than ``pieces`` rows, which bounds what is
    broadcast) are split by a hash of ``spread_by``, columns that tell their rows apart, and
    ``small``'s rows of these values alone are repeated, once for each part. The hash is a
    function of the row, so a task that runs again deals the rows alike. ``how`` is
    ``left`` or ``inner``. Rows without a key match nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    hot = F.broadcast(hot_keys(big, key, pieces).withColumnRenamed("parts", "_parts"))
    salt = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int")).otherwise(0)
    left = big.join(hot, key, "left").withColumn("_salt", salt).drop("_parts")
    right = small.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0))))).drop("_parts")
    return left.join(right, [key, "_salt"], how).drop("_salt")
