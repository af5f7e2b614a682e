"""Cleaning operators: trim, fill, IQR capping, keyed de-duplication.

All are column-parameterised DataFrame -> DataFrame functions built from
JVM-side expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rank import quantile_table

RESCUE_COL = "_rescued_data"


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip leading/trailing spaces (spaces only, as SQL trim)."""
    have = set(df.columns)
    present = [c for c in columns if c in have]
    return df.withColumns({c: F.trim(F.col(c)) for c in present}) if present else df


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULLs per column; the value is cast to the column's type."""
    return df.fillna(dict(values)) if values else df


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = 1.5,
               exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """One row: ``_q1_<c>, _q3_<c>, _lower_<c>, _upper_<c>`` for every column.

    One quantile pass covers all columns (exact: bracketing and counting, see
    operators.rank; approximate: one ``percentile_approx`` aggregate).
    """
    q = quantile_table(df, columns, [0.25, 0.75], ["q1", "q3"], exact=exact, accuracy=accuracy)
    picks = []
    for c in columns:
        picks += [f"max(CASE WHEN column = '{c}' THEN q1 END) AS `_q1_{c}`",
                  f"max(CASE WHEN column = '{c}' THEN q3 END) AS `_q3_{c}`"]
    row = q.agg(*[F.expr(e) for e in picks])
    k = f"{float(factor)!r}D"
    bounds = []
    for c in columns:
        q1, q3 = f"`_q1_{c}`", f"`_q3_{c}`"
        bounds += [f"{q1} - {k} * ({q3} - {q1}) AS `_lower_{c}`", f"{q3} + {k} * ({q3} - {q1}) AS `_upper_{c}`"]
    return row.selectExpr("*", *bounds)


def cap_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5,
                 exact: bool = True, accuracy: int = 10000,
                 drop_underscore: bool = True) -> DataFrame:
    """Clamp each column to [q1 - factor*IQR, q3 + factor*IQR] of its own values.

    Quartiles are global: the bounds are one value, a scalar subquery that runs
    before the scan. NULL stays NULL; capped columns come out as
    double. Like the reference, every column whose name starts with ``_`` is
    dropped afterwards (``drop_underscore``); with no columns the input is
    returned unchanged. ``exact=False`` uses ``percentile_approx`` as the
    reference does.
    """
    columns = list(columns)
    if not columns:
        return df
    stats = iqr_bounds(df, columns, factor, exact, accuracy)
    bounds = stats.select(F.struct(*[f"_{side}_{c}" for c in columns for side in ("lower", "upper")])).scalar()
    joined = df.withColumn("_bounds", bounds)
    capped = set(columns)
    cols = []
    for c in df.columns:
        if c in capped:
            x, lo, hi = F.col(c), F.col(f"_bounds.`_lower_{c}`"), F.col(f"_bounds.`_upper_{c}`")
            cols.append(F.when(x < lo, lo).when(x > hi, hi).otherwise(x.cast("double")).alias(c))
        elif not (drop_underscore and c.startswith("_")):
            cols.append(F.col(c))
    return joined.select(*cols)


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the smallest by ``order`` (default: all other columns).

    Implemented as ``min(struct(order..., rest...))`` per key, an aggregate with
    map-side partial aggregation, so a key holding a large share of the rows
    is reduced inside each map task instead of being sorted in one task.
    """
    keys = list(keys)
    all_cols = df.columns
    rest = [c for c in all_cols if c not in keys]
    order = list(order) if order is not None else rest
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"t{i}") for i, c in enumerate(tail)])
    g = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    cols = {c: F.col(f"_best.o{i}") for i, c in enumerate(order)}
    cols.update({c: F.col(f"_best.t{i}") for i, c in enumerate(tail)})
    return g.select(*[F.col(c) if c in keys else cols[c].alias(c) for c in all_cols])
