"""Audits from mergeable sketches: quartiles, distinct values, frequent values, distinct ids.

A sketch has a bounded size and a stated error, and sketches of parts merge into the
sketch of the whole. An audit keeps one row of sketches per part (a month, a day) of a
table; the next audit scans the new parts alone, and no cell of the table is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Items that a quantile sketch keeps at its lowest level; the rank error falls with it.
KLL_K = 2000
#: Rank error of a quantile at KLL_K, in shares of the rows (three standard errors).
KLL_RANK_ERROR = 0.003
#: Steps of the quantiles from which a value's rank is read.
GRID = 2000
#: log2 of the registers of a distinct sketch; its standard error is 1.04 / sqrt(2 ** LG_K).
HLL_LG_K = 14
HLL_ERROR = 3 * 1.04 / 2 ** (HLL_LG_K / 2)


def q(c: str) -> str:
    return f"`{c.replace('`', '``')}`"


# ------------------------------------------------------------ sketches of a table's parts

def part_sketches(df: DataFrame, columns: Sequence[str], part: str | None = None) -> DataFrame:
    """(part, column, rows, kll, hll) per part of ``df`` and numeric column: one aggregate over the scan.

    ``part`` is a column of ``df`` (else the table is one part, NULL). ``rows`` counts
    all rows; the sketches hold the non-NULL values, NaN among the distinct ones only.
    """
    aggs = [F.expr("count(1) AS n")]
    for i, c in enumerate(columns):
        x = f"CAST({q(c)} AS DOUBLE)"
        aggs += [F.expr(f"kll_sketch_agg_double(CASE WHEN NOT isnan({x}) THEN {x} END, {KLL_K}) AS k{i}"),
                 F.expr(f"hll_sketch_agg(CAST({x} + 0.0D AS STRING), {HLL_LG_K}) AS h{i}"), F.expr(f"count_if({x} IS NULL) AS z{i}")]
    name = F.col(q(part)).cast("string") if part else F.lit(None).cast("string")
    wide = df.groupBy(name.alias("part")).agg(*aggs) if part else df.agg(*aggs).where("n > 0").withColumn("part", name)
    rows = ", ".join(f"'{c.replace(chr(39), chr(92) + chr(39))}', n, z{i}, k{i}, h{i}" for i, c in enumerate(columns))
    return wide.selectExpr("part", f"stack({len(columns)}, {rows}) AS (column, rows, nulls, kll, hll)")


def update_sketches(df: DataFrame, columns: Sequence[str], part: str, path: str) -> DataFrame:
    """Add the sketches of ``df``'s parts that ``path`` doesn't have yet; return all that are stored.

    Parts (a column the table is partitioned by, so that the filter prunes files) are
    taken as final: a part with stored sketches isn't read again. Their names, one per part
    and no more, are compared on the driver's side of the plan.
    """
    spark = df.sparkSession
    try:
        known = spark.read.parquet(path).select("part").distinct()
        have = [r.part for r in known.collect()]
    except Exception as e:  # noqa: BLE001 - nothing is stored before the first audit
        if "PATH_NOT_FOUND" not in str(e):
            raise
        have = []
    fresh = df
    if have:
        named = [p for p in have if p is not None]
        fresh = fresh.where(~F.coalesce(F.col(q(part)).cast("string").isin(named), F.lit(False)))
        if len(named) < len(have):
            fresh = fresh.where(F.col(q(part)).isNotNull())
    part_sketches(fresh, columns, part).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def merged_sketches(stored: DataFrame) -> DataFrame:
    """(column, rows, nulls, kll, hll) of all parts together."""
    return stored.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
                                        F.expr(f"kll_merge_agg_double(kll, {KLL_K}) AS kll"), F.expr("hll_union_agg(hll) AS hll"))


def outliers_from_sketches(stored: DataFrame, factor: float = 1.5, min_distinct: int = 5, max_distinct_share: float = 0.9) -> DataFrame:
    """IQR outlier report from stored sketches alone: no row of the table is read.

    column, rows, distinct_estimate, q1, q3, lower_bound, upper_bound, outlier_estimate,
    outlier_error. Quartiles are values whose rank is off by at most KLL_RANK_ERROR of the rows; the
    outliers are estimated from how many of GRID quantiles lie beyond the bounds, within
    ``outlier_error`` rows of the count for the same bounds. Columns with few distinct values (NULL counted as one), or with
    nearly one a row, are skipped, by an estimate within HLL_ERROR.
    """
    k = repr(float(factor)) + "D"
    m = merged_sketches(stored).selectExpr("*", "kll_sketch_get_n_double(kll) AS n").where("n > 0")
    m = m.selectExpr("*", "kll_sketch_get_quantile_double(kll, 0.25D) AS q1", "kll_sketch_get_quantile_double(kll, 0.75D) AS q3",
                     "hll_sketch_estimate(hll) + CASE WHEN nulls > 0 THEN 1 ELSE 0 END AS distinct_estimate")
    m = m.selectExpr("*", f"q1 - {k} * (q3 - q1) AS lower_bound", f"q3 + {k} * (q3 - q1) AS upper_bound")
    grid = ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1))
    m = m.withColumn("grid", F.expr(f"kll_sketch_get_quantile_double(kll, array({grid}))"))
    share = lambda cond: f"greatest(size(filter(grid, x -> {cond})) - 0.5D, 0.0D) / {GRID}"
    below, above = share("x < lower_bound"), share("x > upper_bound")
    return m.where(f"distinct_estimate >= {int(min_distinct)} AND distinct_estimate <= rows * {float(max_distinct_share)!r}D").selectExpr(
        "column", "rows", "distinct_estimate", "q1", "q3", "lower_bound", "upper_bound",
        f"CAST(round(n * ({below} + {above})) AS BIGINT) AS outlier_estimate",
        f"CAST(ceil(n * {2 * KLL_RANK_ERROR + 1 / GRID!r}D) AS BIGINT) AS outlier_error")


# ------------------------------------------------------------------ distinct values

def distinct_sketches(df: DataFrame, columns: Sequence[str], fold: bool = False) -> DataFrame:
    """(column, hll, nulls[, hll_lower]) of text forms: one aggregate, nothing but sketches is shuffled."""
    aggs, args = [], []
    for i, c in enumerate(columns):
        x = f"CAST({q(c)} AS STRING)"
        aggs += [F.expr(f"hll_sketch_agg({x}, {HLL_LG_K}) AS h{i}"), F.expr(f"count_if({x} IS NULL) AS z{i}")]
        if fold:
            aggs.append(F.expr(f"hll_sketch_agg(lower({x}), {HLL_LG_K}) AS l{i}"))
        args.append(f"'{c}', h{i}, z{i}" + (f", l{i}" if fold else ""))
    names = "(column, hll, nulls, hll_lower)" if fold else "(column, hll, nulls)"
    return df.agg(*aggs).selectExpr(f"stack({len(columns)}, {', '.join(args)}) AS {names}")


def _estimate(hll: str, nulls: str) -> str:
    return f"coalesce(hll_sketch_estimate({hll}), 0L) + CASE WHEN {nulls} > 0 THEN 1 ELSE 0 END"


def _settled(hll: str) -> str:
    """An estimate that depends on the set of values alone; that of a sketch as it was filled also depends on their order."""
    return f"hll_sketch_estimate(hll_union({hll}, {hll}))"


def distinct_estimates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct_estimate), NULL counted as one value; within HLL_ERROR of the count."""
    return distinct_sketches(df, columns).selectExpr("column", f"{_estimate('hll', 'nulls')} AS distinct_estimate")


def casing_estimates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct_estimate, lower_estimate, inconsistent): columns whose values differ in case alone.

    Equal sets of values have equal sketches, so a column without such values is never
    called inconsistent; one is missed only if the few that fold don't change the estimate.
    """
    s = distinct_sketches(df, columns, fold=True)
    return s.selectExpr("column", f"{_estimate('hll', 'nulls')} AS distinct_estimate", f"{_estimate('hll_lower', 'nulls')} AS lower_estimate",
                        f"coalesce({_settled('hll')} > {_settled('hll_lower')}, false) AS inconsistent")


def reconcile_estimates(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, left_estimate, right_estimate, union_estimate, differ) of two versions of a table.

    The union's sketch is that of both sides' values together: where it differs from a
    side's, the other side has values that this one lacks.
    """
    a = distinct_sketches(left, columns).selectExpr("column", "hll AS lh", "nulls AS lz")
    b = distinct_sketches(right, columns).selectExpr("column", "hll AS rh", "nulls AS rz")
    both = a.join(F.broadcast(b), "column")  # one row per column
    union = "hll_sketch_estimate(hll_union(lh, rh))"
    return both.selectExpr(
        "column", f"{_estimate('lh', 'lz')} AS left_estimate", f"{_estimate('rh', 'rz')} AS right_estimate",
        f"coalesce({union}, 0L) + CASE WHEN lz + rz > 0 THEN 1 ELSE 0 END AS union_estimate",
        f"coalesce({_settled('lh')} <> {union} OR {_settled('rh')} <> {union}, false) OR (lz > 0) <> (rz > 0) AS differ")


# ------------------------------------------------------------------ frequent values

def frequent_values(df: DataFrame, columns: Sequence[str], share: float = 0.01, tracked: int = 8192) -> DataFrame:
    """(column, value, count, count_error): all values that hold at least ``share`` of a column's non-NULL rows.

    One aggregate of ``approx_top_k`` sketches with at most ``tracked`` counters a column,
    however many distinct values it has. Counts are exact while a column has up to three quarters
    of ``tracked`` distinct values; else they are too high by at most 3.5 / ``tracked`` of the
    rows, so values are reported from ``share`` on and none is missed.
    """
    if share <= 3.5 / tracked:
        raise ValueError("share must exceed 3.5 / tracked")
    most = min(tracked, int(1 / share) + 1)
    aggs = []
    for i, c in enumerate(columns):
        x = f"CAST({q(c)} AS STRING)"
        aggs += [F.expr(f"approx_top_k({x}, {most}, {tracked}) AS t{i}"), F.expr(f"count({x}) AS n{i}"),
                 F.expr(f"approx_count_distinct({x}) AS d{i}")]
    args = ", ".join(f"'{c}', t{i}, n{i}, d{i}" for i, c in enumerate(columns))
    rows = df.agg(*aggs).selectExpr(f"stack({len(columns)}, {args}) AS (column, top, n, d)").selectExpr("column", "n", "d", "inline(top) AS (value, count)")
    exact = int(tracked * 0.75 / 1.2)  # the distinct values are estimated too
    return rows.where(f"value IS NOT NULL AND count >= {float(share)!r}D * n").selectExpr(
        "column", "value", "count", f"CASE WHEN d <= {exact} THEN 0L ELSE CAST(ceil(n * {3.5 / tracked!r}D) AS BIGINT) END AS count_error")


# --------------------------------------------------------------------- distinct ids

def id_bitmaps(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """(keys..., bucket, bits): the ids of each group as bitmaps of 32,768 ids. Ids are whole numbers; NULL is none.

    Partial bitmaps are made map-side, so an id is moved once per task and group at most, as a
    bit. Good for dense ids; a group with few ids of a wide range has a bitmap for nearly each.
    """
    ids = F.col(id_col).cast("long")
    return df.where(ids.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(ids).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("bits"))


def roll_up_bitmaps(bitmaps: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Bitmaps of coarser groups: ``keys`` maps each new key to its expression over the finer ones."""
    return bitmaps.groupBy(*[F.expr(e).alias(k) for k, e in keys.items()], "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(keys..., name): distinct ids of each group."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
