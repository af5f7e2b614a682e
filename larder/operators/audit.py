"""Data-quality audits and source-to-table reconciliation.

The reference notebooks run one Spark job per column and check, collecting
counts to the driver. Here every audit is one aggregate pass per table whose
single wide row is unpivoted into (column, measure) rows, and the result
stays a DataFrame. Multi-table audits are unions of per-table results.
Column lists and types are schema metadata and are read on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               NumericType, ShortType, StringType, TimestampNTZType, TimestampType)

from ..functions.numeric import pct_sql
from ..sources.files import discard, materialize, scratch_path
from .rank import ACCURACY, order_statistics, ranked_values

OUTLIER_TYPES = (IntegerType, LongType, DoubleType, FloatType, DecimalType)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def q(c: str) -> str:
    """Quote an identifier for SQL text."""
    return "`" + c.replace("`", "``") + "`"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _long(row: DataFrame, keep: Sequence[str], items: Sequence[tuple[str, str]], value_names,
          name_col: str = "column") -> DataFrame:
    """Unpivot with SQL ``stack``: each item is (name, sql_expr) or (name, [sql_exprs]).

    One ``selectExpr`` call regardless of the number of columns.
    """
    value_names = [value_names] if isinstance(value_names, str) else list(value_names)
    args = []
    for name, e in items:
        args.append(_lit(name))
        args.extend(e if isinstance(e, (list, tuple)) else [e])
    outs = ", ".join(q(v) for v in [name_col, *value_names])
    return row.selectExpr(*[q(k) for k in keep], f"stack({len(items)}, {', '.join(args)}) AS ({outs})")


def _stack_values(df: DataFrame, columns: Sequence[str], cast: str | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) for every listed column of every row.

    Floating values are normalised (-0.0 -> 0.0) before a cast to text, so
    text-based distinct counts agree with numeric equality.
    """
    types = _types(df)

    def expr(c):
        x = q(c)
        if cast == "string" and isinstance(types[c], (DoubleType, FloatType)):
            x = f"({x} + 0.0D)"
        return f"CAST({x} AS {cast})" if cast else x
    return _long(df, keep, [(c, expr(c)) for c in columns], "value")


def _types(df: DataFrame) -> dict:
    """Column -> data type, read once (each ``df.schema`` is a JVM round trip)."""
    return {f.name: f.dataType for f in df.schema.fields}


def numeric_columns(df: DataFrame, types=(NumericType,)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


# ------------------------------------------------------------------ overview

def audit_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table -> rows, cols."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("cols"))
        for name, df in tables.items()
    ])


# ----------------------------------------------------------------------- nulls

def _aggs(df: DataFrame, *exprs: str) -> DataFrame:
    return df.agg(*[F.expr(e) for e in exprs])


def _null_test(types: dict, c: str) -> str:
    if isinstance(types[c], (DoubleType, FloatType)):
        return f"{q(c)} IS NULL OR isnan({q(c)})"
    return f"{q(c)} IS NULL"


def table_nulls(df: DataFrame, name: str) -> DataFrame:
    """Columns with NULLs (NaN counts as NULL for floating columns)."""
    types = _types(df)
    cols = list(types)
    row = _aggs(df, "count(1) AS _total",
                *[f"count_if({_null_test(types, c)}) AS {q('n' + str(i))}" for i, c in enumerate(cols)])
    long = _long(row, ["_total"], [(c, q(f"n{i}")) for i, c in enumerate(cols)], "null_count")
    return long.where("null_count > 0").selectExpr(
        f"{_lit(name)} AS table", "column", "null_count", f"{pct_sql('null_count', '_total')} AS null_pct")


def audit_nulls(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([table_nulls(df, n) for n, df in tables.items()]).orderBy(F.col("null_pct").desc())


# ------------------------------------------------------------------ duplicates

def row_hash_sql(columns: Sequence[str]) -> list[str]:
    """Two 64-bit hashes of the columns' values; equal rows have equal ones, NULLs and their places included."""
    cells, nulls = [q(c) for c in columns], [f"{q(c)} IS NULL" for c in columns]
    return [f"xxhash64({', '.join(cells + nulls)})", f"xxhash64({', '.join(['1', *nulls, *reversed(cells)])})"]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: total_rows, distinct_rows, dup_rows, dup_pct (NULLs compare equal).

    Rows are told apart by 128 bits, so texts aren't shuffled; the group is
    pre-aggregated map-side, so many copies of one row are counted inside each
    map task first.
    """
    a, b = row_hash_sql(df.columns)
    g = df.groupBy(F.expr(a).alias("_a"), F.expr(b).alias("_b")).agg(F.expr("count(1) AS _n"))
    return _aggs(g, "CAST(coalesce(sum(_n), 0) AS BIGINT) AS total_rows", "count(1) AS distinct_rows").selectExpr(
        "total_rows", "distinct_rows", "total_rows - distinct_rows AS dup_rows",
        f"{pct_sql('total_rows - distinct_rows', 'total_rows')} AS dup_pct")


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: pk_total, pk_distinct, pk_dups (rows beyond the first per key)."""
    g = df.groupBy(*keys).agg(F.expr("count(1) AS _n"))
    return _aggs(g, "CAST(coalesce(sum(_n), 0) AS BIGINT) AS pk_total", "count(1) AS pk_distinct").selectExpr(
        "pk_total", "pk_distinct", "pk_total - pk_distinct AS pk_dups")


def table_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total_rows, dup_rows, dup_pct, pk_dups (0 without keys).

    The key's duplicates come from the counted distinct rows, so the table is
    read and moved once.
    """
    a, b = row_hash_sql(df.columns)
    rows = df.groupBy(*keys, F.expr(a).alias("_a"), F.expr(b).alias("_b")).agg(F.expr("count(1) AS _n"))
    by_key = rows.groupBy(*keys).agg(F.expr("sum(_n) AS _n"), F.expr("count(1) AS _d")) if keys else rows.selectExpr("_n", "1L AS _d")
    pk_dups = "total_rows - count(1)" if keys else "0L"
    total = "CAST(coalesce(sum(_n), 0) AS BIGINT)"
    return _aggs(by_key, f"{total} AS total_rows", "CAST(coalesce(sum(_d), 0) AS BIGINT) AS distinct_rows",
                 f"{pk_dups.replace('total_rows', total)} AS pk_dups").selectExpr(
        "total_rows", "total_rows - distinct_rows AS dup_rows",
        f"{pct_sql('total_rows - distinct_rows', 'total_rows')} AS dup_pct", "pk_dups")


def audit_duplicates(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """table, total_rows, dup_rows, dup_pct, primary_key, pk_dups."""
    frames = []
    for name, df in tables.items():
        pk = list(keys.get(name, []))
        frames.append(table_duplicates(df, pk).selectExpr(
            f"{_lit(name)} AS table", "total_rows", "dup_rows", "dup_pct", f"{_lit(', '.join(pk))} AS primary_key", "pk_dups"))
    return _union(frames).orderBy(F.col("dup_rows").desc())


# -------------------------------------------------------------------- outliers

_OUTLIERS = "table string, column string, q1 double, q3 double, lo double, hi double, total bigint, outlier_count bigint"
_AT_ONCE = 20_000_000  # values of a column up to which a bracket of a few thousandths is counted in one step


def table_outliers(df: DataFrame, name: str, factor: float = 1.5, exact: bool = True,
                   min_distinct: int = 5, max_distinct_share: float = 0.9) -> DataFrame:
    """``audit_outliers`` of one table."""
    return audit_outliers({name: df}, exact, factor, min_distinct, max_distinct_share)


def audit_outliers(tables: Mapping[str, DataFrame], exact: bool = True, factor: float = 1.5,
                   min_distinct: int = 5, max_distinct_share: float = 0.9) -> DataFrame:
    """IQR outlier report of the numeric columns of several tables.

    Columns with fewer than ``min_distinct`` distinct values (NULL counted as
    one) or more than ``max_distinct_share`` x rows (id-like) are skipped. The
    numeric columns are written once as doubles; from there three aggregates over all tables
    together give sketches of every column, its exact quartiles (from the values that the
    sketches bracket) and the outliers. What comes back between them is a few rows per
    column. Distinct values are estimated, and counted only for columns whose estimate doesn't decide the rule.
    """
    spark = next(iter(tables.values())).sparkSession
    path = scratch_path(spark, "outliers")
    columns = {n: numeric_columns(df, OUTLIER_TYPES) for n, df in tables.items()}
    columns = {n: cols for n, cols in columns.items() if cols}

    def keep(n: str) -> DataFrame:
        narrow = tables[n].select(*[F.col(q(c)).cast("double").alias(f"_{i}") for i, c in enumerate(columns[n])])
        # small row groups: a table that came as one split is read in several
        narrow.write.option("parquet.block.size", 8 << 20).option("compression", "zstd").parquet(f"{path}/{n}")
        return spark.read.parquet(f"{path}/{n}")

    with ThreadPoolExecutor(4) as pool:
        kept = dict(zip(columns, pool.map(keep, columns)))
    rows = _outlier_rows(spark, kept, columns, factor, exact, min_distinct, max_distinct_share) if kept else []
    counts = {}
    if rows:
        beyond = []
        for n, df in kept.items():
            mine = [r for r in rows if r[0] == n]
            tests = [f"{_lit(r[1])}, count_if(_{columns[n].index(r[1])} < {r[4]!r}D OR _{columns[n].index(r[1])} > {r[5]!r}D)".replace("nanD", "double('NaN')").replace(
                "infD", "double('Infinity')") for r in mine]
            if mine:
                wide = df.agg(*[F.expr(f"struct({t})").alias(f"o{i}") for i, t in enumerate(tests)])
                beyond.append(wide.selectExpr(f"{_lit(n)} AS table", f"inline(array({', '.join(f'o{i}' for i in range(len(mine)))})) AS (column, beyond)"))
        counts = {(r.table, r.column): r.beyond for r in _union(beyond).collect()}  # a row per numeric column
    discard(spark, path)
    return _outlier_report(spark.createDataFrame([(*r, counts[r[0], r[1]]) for r in rows], _OUTLIERS))


def _outlier_report(found: DataFrame) -> DataFrame:
    return found.where("outlier_count > 0").selectExpr(
        "table", "column", "round(q1, 2) AS q1", "round(q3, 2) AS q3", "round(lo, 2) AS lower_bound", "round(hi, 2) AS upper_bound",
        "outlier_count", f"{pct_sql('outlier_count', 'total')} AS outlier_pct").orderBy(F.col("outlier_count").desc())


def _stacked_tables(kept: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]], ids: Mapping[tuple[str, str], int]) -> DataFrame:
    """(id, value) of all rows of the columns that have an id."""
    frames = []
    for n, df in kept.items():
        args = [f"{ids[n, c]}, _{i}" for i, c in enumerate(columns[n]) if (n, c) in ids]
        if args:
            frames.append(df.selectExpr(f"stack({len(args)}, {', '.join(args)}) AS (id, value)"))
    return _union(frames)


def _outlier_rows(spark, kept: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]], factor: float, exact: bool,
                  min_distinct: int, max_distinct_share: float) -> list[tuple]:
    """Quartiles and bounds of the columns that the skip rule leaves."""
    error = 0.01  # of 2 ** 14 registers
    ends = ", ".join(f"{p + d!r}D" for p in (0.25, 0.75) for d in (-0.004, 0.004))  # a sketch of 4,000 items is off by far less
    ids = {k: i for i, k in enumerate((n, c) for n in kept for c in columns[n])}
    names = list(ids)
    stats = _stacked_tables(kept, columns, ids).groupBy("id").agg(
        F.expr("count(1) AS total"), F.expr("count(value) AS n"),
        F.expr("hll_sketch_estimate(hll_sketch_agg(CASE WHEN value IS NOT NULL THEN xxhash64(value) END, 14)) AS d"),
        F.expr(f"CASE WHEN count(value) > 0 THEN kll_sketch_get_quantile_double(kll_sketch_agg_double(value, 4000), array({ends})) END AS e"))
    stats = {names[r.id]: r for r in stats.collect()}
    distinct = {k: (r.d or 0) + (r.n < r.total) for k, r in stats.items()}
    most = {k: r.total * max_distinct_share for k, r in stats.items()}
    # a sketch of few values can only have too few of them, and that if two share one of 2 ** 26 places
    unsure = {k for k, d in distinct.items() if abs(d - min_distinct) <= 2 or abs(d - most[k]) <= 6 * error * most[k]}
    if unsure:
        counted = _stacked_tables(kept, columns, {k: ids[k] for k in unsure}).distinct().groupBy("id").agg(F.count(F.lit(1)).alias("d"))
        distinct |= {names[r.id]: r.d for r in counted.collect()}
    asked = [k for k, r in stats.items() if min_distinct <= distinct[k] <= most[k] and r.n]
    if not asked:
        return []
    probs = (0.25, 0.75)
    rank = lambda k, p: max(1, math.ceil(p * stats[k].n))
    quartiles: dict[tuple[str, str], dict[float, float]] = {k: {} for k in asked}
    small = {k for k in asked if stats[k].n <= _AT_ONCE} if exact else set()
    if small:
        targets = [(ids[k], p, rank(k, p), stats[k].e[2 * i], stats[k].e[2 * i + 1]) for k in small for i, p in enumerate(probs)]
        values = _stacked_tables(kept, columns, {k: ids[k] for k in small}).where("value IS NOT NULL").withColumnRenamed("id", "cell")
        hits = ranked_values(values, ["cell"], spark.createDataFrame(targets, "cell int, id double, rank long, lo double, hi double"), True)
        for r in hits.collect():
            quartiles[names[r.cell]][r.id] = r.value
    for n, df in kept.items():
        large = [(k, f"_{i}") for i, k in enumerate((n, c) for c in columns[n]) if k in quartiles and k not in small]
        if large and exact:
            found = order_statistics(df, [(x, rank(k, p)) for k, x in large for p in probs])
            for j, (k, _) in enumerate(large):
                quartiles[k] = {p: found[2 * j + i][0] for i, p in enumerate(probs)}
        elif large:
            near = df.agg(*[F.percentile_approx(x, list(probs), ACCURACY).alias(x) for _, x in large]).first()
            for k, x in large:
                quartiles[k] = dict(zip(probs, near[x]))
    out = []
    for k in asked:
        q1, q3 = (quartiles[k][p] for p in probs)
        out.append((*k, q1, q3, q1 - factor * (q3 - q1), q3 + factor * (q3 - q1), stats[k].total))
    return out


# -------------------------------------------------------------- standardising

def audit_value_counts(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """table, column, value, count for categorical columns (several at once)."""
    frames = []
    for name, df in tables.items():
        present = set(df.columns)
        cols = [c for c in columns.get(name, []) if c in present]
        if cols:
            s = _stack_values(df, cols, "string")
            frames.append(s.groupBy("column", "value").agg(F.expr("count(1) AS count"))
                          .selectExpr(f"{_lit(name)} AS table", "column", "value", "count"))
    return _union(frames).orderBy(F.col("count").desc())


def _per_column_counts(df: DataFrame, name: str, cols: Sequence[str], cond, value_name: str) -> DataFrame:
    """One pass: count_if(cond(c)) for each column, unpivoted, non-zero only."""
    row = _aggs(df, *[f"count_if({cond(c)}) AS {q('n' + str(i))}" for i, c in enumerate(cols)])
    long = _long(row, [], [(c, q(f"n{i}")) for i, c in enumerate(cols)], value_name)
    return long.where(f"{value_name} > 0").selectExpr(f"{_lit(name)} AS table", "column", value_name)


def audit_whitespace(tables: Mapping[str, DataFrame]) -> DataFrame:
    """String columns holding values with leading/trailing spaces."""
    frames = []
    for name, df in tables.items():
        cols = string_columns(df)
        if cols:
            f = _per_column_counts(df, name, cols, lambda c: f"{q(c)} IS NOT NULL AND {q(c)} <> trim({q(c)})",
                                   "ws_count")
            frames.append(f.selectExpr("table", "column", "'Whitespace' AS issue", "ws_count"))
    return _union(frames)


def audit_casing(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct values vs distinct lower-cased values per categorical column.

    NULL counts as one value (as ``distinct().count()`` does). Two-step
    grouping: distinct (column, value) first, then lower-case those.
    """
    frames = []
    for name, df in tables.items():
        present = set(df.columns)
        cols = [c for c in columns.get(name, []) if c in present]
        if not cols:
            continue
        vals = _stack_values(df, cols, "string").select("column", "value").distinct()
        n_vals = vals.groupBy("column").agg(F.expr("count(1) AS distinct_values"))
        n_low = vals.selectExpr("column", "lower(value) AS v").distinct() \
            .groupBy("column").agg(F.expr("count(1) AS distinct_lower"))
        frames.append(n_vals.join(n_low, "column").selectExpr(
            f"{_lit(name)} AS table", "column", "distinct_values", "distinct_lower",
            "distinct_values > distinct_lower AS inconsistent"))
    return _union(frames)


INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
DOUBLE_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _nonconforming_sql(types: dict, c: str, expected: str) -> str:
    """Condition: the value of ``c`` does not fit the ``expected`` type."""
    dt = types[c]
    if isinstance(dt, StringType):
        pattern = INT_TEXT if expected in ("int", "bigint") else DOUBLE_TEXT
        return f"{q(c)} IS NOT NULL AND NOT {q(c)} RLIKE {_lit(pattern)}"
    if isinstance(dt, (DoubleType, FloatType, DecimalType)) and expected in ("int", "bigint"):
        return f"{q(c)} IS NOT NULL AND {q(c)} <> floor({q(c)})"
    return "false"


def audit_types(tables: Mapping[str, DataFrame], expected: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """table, column, actual_type, expected_type, nonconforming_rows."""
    frames = []
    for name, df in tables.items():
        types = _types(df)
        exp = {c: t for c, t in expected.get(name, {}).items() if c in types}
        if not exp:
            continue
        cols = list(exp)
        row = _aggs(df, *[f"count_if({_nonconforming_sql(types, c, exp[c])}) AS {q('n' + str(i))}"
                          for i, c in enumerate(cols)])
        long = _long(row, [], [(c, [q(f"n{i}"), _lit(types[c].simpleString()), _lit(exp[c])])
                               for i, c in enumerate(cols)],
                     ["nonconforming_rows", "actual_type", "expected_type"])
        frames.append(long.selectExpr(f"{_lit(name)} AS table", "column", "actual_type", "expected_type",
                                      "nonconforming_rows"))
    return _union(frames)


def audit_negatives(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns (from a list per table) holding negative values, with the count."""
    frames = []
    for name, df in tables.items():
        present = set(df.columns)
        cols = [c for c in columns.get(name, []) if c in present]
        if cols:
            frames.append(_per_column_counts(df, name, cols, lambda c: f"{q(c)} < 0", "negative_count"))
    return _union(frames)


# -------------------------------------------------------------- reconciliation

Pairs = Mapping[str, tuple[DataFrame, DataFrame]]


def _count(df: DataFrame, alias: str) -> DataFrame:
    return _aggs(df, f"count(1) AS {alias}")


def _two_counts(a: DataFrame, a_name: str, b: DataFrame, b_name: str) -> DataFrame:
    """One row with the row counts of ``a`` and ``b`` (union + aggregate, no join)."""
    return _count(a, a_name).unionByName(_count(b, b_name), allowMissingColumns=True).agg(
        F.expr(f"max({a_name}) AS {a_name}"), F.expr(f"max({b_name}) AS {b_name}"))


def reconcile_rows(pairs: Pairs) -> DataFrame:
    """Row counts and column sets of two versions of each table (left = source)."""
    frames = []
    for name, (left, right) in pairs.items():
        lc, rc = set(left.columns), set(right.columns)
        extra = ", ".join(sorted(rc - lc)) or "none"
        missing = ", ".join(sorted(lc - rc)) or "none"
        frames.append(_two_counts(left, "left_rows", right, "right_rows").selectExpr(
            f"{_lit(name)} AS table", "left_rows", "right_rows", "right_rows - left_rows AS row_diff",
            f"{len(lc)} AS left_cols", f"{len(rc)} AS right_cols",
            f"{_lit(extra)} AS extra_cols", f"{_lit(missing)} AS missing_cols"))
    return _union(frames)


def reconcile_types(pairs: Pairs) -> DataFrame:
    """Shared columns whose types differ, with the left rows that do not
    survive a cast to the right type (cast, then back, and compare)."""
    frames = []
    for name, (left, right) in pairs.items():
        lt_, rt_ = _types(left), _types(right)
        diff = [(c, lt_[c].simpleString(), rt_[c].simpleString()) for c in lt_
                if c in rt_ and lt_[c].simpleString() != rt_[c].simpleString()]
        if not diff:
            continue

        def bad(c, lt, rt):
            back = f"CAST(try_cast({q(c)} AS {rt}) AS {lt})"
            return f"{q(c)} IS NOT NULL AND ({back} IS NULL OR {back} <> {q(c)})"
        row = _aggs(left, *[f"count_if({bad(c, lt, rt)}) AS {q('n' + str(i))}"
                            for i, (c, lt, rt) in enumerate(diff)])
        long = _long(row, [], [(c, [q(f"n{i}"), _lit(lt), _lit(rt)]) for i, (c, lt, rt) in enumerate(diff)],
                     ["nonconforming_rows", "left_type", "right_type"])
        frames.append(long.selectExpr(f"{_lit(name)} AS table", "column", "left_type", "right_type",
                                      "nonconforming_rows"))
    return _union(frames)


def _profile(df: DataFrame, cols: Sequence[str], numeric: set[str]) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(f"count_if({q(c)} IS NULL) AS n{i}")
        if c in numeric:
            aggs += [f"min(CAST({q(c)} AS DOUBLE)) AS lo{i}", f"max(CAST({q(c)} AS DOUBLE)) AS hi{i}"]
    row = _aggs(df, *aggs)
    none = "CAST(NULL AS DOUBLE)"
    items = [(c, [f"n{i}", f"lo{i}" if c in numeric else none, f"hi{i}" if c in numeric else none])
             for i, c in enumerate(cols)]
    return _long(row, [], items, ["nulls", "lo", "hi"])


def reconcile_profile(pairs: Pairs) -> DataFrame:
    """Shared columns whose NULL count or (numeric) min/max differ."""
    frames = []
    for name, (left, right) in pairs.items():
        lt_, rt_ = _types(left), _types(right)
        shared = [c for c in lt_ if c in rt_]
        numeric = {c for c in shared if isinstance(lt_[c], NumericType) and isinstance(rt_[c], NumericType)}
        lp = _profile(left, shared, numeric).selectExpr(
            "column", "nulls AS left_nulls", "lo AS left_min", "hi AS left_max")
        rp = _profile(right, shared, numeric).selectExpr(
            "column", "nulls AS right_nulls", "lo AS right_min", "hi AS right_max")
        frames.append(lp.join(rp, "column").where(
            "left_nulls <> right_nulls OR NOT (left_min <=> right_min) OR NOT (left_max <=> right_max)"
        ).selectExpr(f"{_lit(name)} AS table", "column", "left_nulls", "right_nulls",
                     "left_min", "right_min", "left_max", "right_max"))
    return _union(frames)


def _value_bits(types: Mapping, c: str) -> list[str]:
    """At most 128 bits of a value as two longs, NULL for NULL.

    Values of up to eight bytes are told apart by themselves (floating ones and local times by the 64-bit
    hash, which is one-to-one on eight bytes), never as text; other values by 128 bits of their text.
    """
    x, kind = q(c), types[c]
    none = "CAST(NULL AS BIGINT)"
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return [f"CAST({x} AS BIGINT)", none]
    if isinstance(kind, (DoubleType, FloatType)):
        return [f"CASE WHEN {x} IS NOT NULL THEN xxhash64(CAST({x} AS DOUBLE) + 0.0D) END", none]
    if isinstance(kind, BooleanType):
        return [f"CAST(CAST({x} AS INT) AS BIGINT)", none]
    if isinstance(kind, DateType):
        return [f"CAST(unix_date({x}) AS BIGINT)", none]
    if isinstance(kind, TimestampType):
        return [f"unix_micros({x})", none]
    if isinstance(kind, TimestampNTZType):
        return [f"CASE WHEN {x} IS NOT NULL THEN xxhash64({x}) END", none]
    text = x if isinstance(kind, StringType) else f"CAST({x} AS STRING)"
    return [f"CASE WHEN {text} IS NOT NULL THEN xxhash64({text}) END", f"CASE WHEN {text} IS NOT NULL THEN xxhash64(1, {text}) END"]


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column -> distinct values (NULL counted once), by unpivot + two-step group over the column's place and ``_value_bits``."""
    types = _types(df)
    cells = ", ".join(f"{i}, {', '.join(_value_bits(types, c))}" for i, c in enumerate(cols))
    counts = df.selectExpr(f"stack({len(cols)}, {cells}) AS (place, a, b)").distinct().groupBy("place").agg(F.expr("count(1) AS distinct"))
    return counts.selectExpr(f"element_at(array({', '.join(_lit(c) for c in cols)}), place + 1) AS column", "distinct")


def bag_prints(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """column -> (rows, values, sums of both halves of 64-bit hashes): the same for columns of the same cells in any order.

    Nothing is shuffled but one row a task. Two columns that differ agree here with a chance of 2^-64.
    """
    types = _types(df)
    aggs, hashed = ["count(1) AS n"], []
    for i, c in enumerate(cols):
        bits = _value_bits(types, c)[0]
        hashed.append(f"{bits if 'xxhash64' in bits else f'CASE WHEN {q(c)} IS NOT NULL THEN xxhash64({bits}) END'} AS h{i}")
        aggs.append(f"struct(count(h{i}) AS v, sum(h{i} & 4294967295L) AS lo, sum(shiftrightunsigned(h{i}, 32)) AS hi) AS s{i}")
    row = _aggs(df.selectExpr(*hashed), *aggs).first()
    return {c: (row["n"], *row[f"s{i}"]) for i, c in enumerate(cols)}


def reconcile_distinct(pairs: Pairs) -> DataFrame:
    """Shared columns whose numbers of distinct values differ.

    Every column of both sides is read at once for its ``bag_prints``: one that holds the same cells on both sides
    has as many distinct values. The values of the others are counted.
    """
    def job(name: str) -> DataFrame:
        left, right = pairs[name]
        right_cols = set(right.columns)
        shared = [c for c in left.columns if c in right_cols]
        lp, rp = bag_prints(left, shared), bag_prints(right, shared)
        differ = [c for c in shared if lp[c] != rp[c]]
        if not differ:
            return left.sparkSession.createDataFrame([], "table string, column string, left_distinct long, right_distinct long")
        ld = distinct_counts(left, differ).withColumnRenamed("distinct", "left_distinct")
        rd = distinct_counts(right, differ).withColumnRenamed("distinct", "right_distinct")
        return ld.join(rd, "column").where("left_distinct <> right_distinct").selectExpr(f"{_lit(name)} AS table", "column", "left_distinct", "right_distinct")

    with ThreadPoolExecutor(4) as pool:
        return _union(list(pool.map(job, pairs)))


def layer_row_delta(pairs: Pairs) -> DataFrame:
    """table, bronze_rows, silver_rows, rows_removed, removed_pct."""
    frames = []
    for name, (bronze, silver) in pairs.items():
        frames.append(_two_counts(bronze, "bronze_rows", silver, "silver_rows").selectExpr(
            f"{_lit(name)} AS table", "bronze_rows", "silver_rows", "bronze_rows - silver_rows AS rows_removed"))
    return _union(frames).selectExpr("*", f"{pct_sql('rows_removed', 'bronze_rows')} AS removed_pct") \
        .orderBy(F.col("rows_removed").desc())


# ------------------------------------------------------------------- profiles

def profile_numeric(df: DataFrame, name: str, places: int = 6) -> DataFrame:
    """count, mean, stddev (sample), min, max of every numeric column, long form."""
    cols = numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = f"CAST({q(c)} AS DOUBLE)"
        aggs += [f"count({x}) AS c{i}", f"round(avg({x}), {places}) AS m{i}",
                 f"round(stddev_samp({x}), {places}) AS s{i}", f"min({x}) AS lo{i}", f"max({x}) AS hi{i}"]
    row = _aggs(df, *aggs)
    items = [(c, [f"c{i}", f"m{i}", f"s{i}", f"lo{i}", f"hi{i}"]) for i, c in enumerate(cols)]
    return _long(row, [], items, ["count", "mean", "stddev", "min", "max"]).selectExpr(
        f"{_lit(name)} AS table", "column", "count", "mean", "stddev", "min", "max")


def sample_rows(df: DataFrame, key: Sequence, n: int = 3) -> DataFrame:
    """The first ``n`` rows by ``key`` (a top-n: each task keeps n rows, then one merge)."""
    return df.orderBy(*key).limit(n)
