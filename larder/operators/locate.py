"""Where two versions of a table differ, found from fingerprints.

Rows are dealt into buckets by a hash of their key. Each side is reduced to sums of cell
hashes per bucket and column, in one aggregate that is combined map-side; sums don't
depend on the order of rows. Only rows of buckets whose sums differ are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

BUCKETS = 4096
_LOW = "4294967295L"


def _cells(df: DataFrame, keys: Sequence[str], columns: Sequence[str], types: dict[str, str], buckets: int) -> DataFrame:
    """Key and cell hashes (h<i>) beside the columns cast to common types."""
    def cell(c: str) -> str:
        x = f"CAST(`{c}` AS {types[c]})"
        return f"({x} + 0.0D)" if types[c] in ("double", "float") else x  # one zero

    key = ", ".join(f"`{k}`" for k in keys)
    return df.selectExpr(*[f"`{k}`" for k in keys], f"CAST(pmod(xxhash64({key}), {int(buckets)}) AS INT) AS _bucket",
                         *[f"xxhash64({i}, {key}, {cell(c)}, {cell(c)} IS NULL) AS h{i}" for i, c in enumerate(columns)],
                         *[f"{cell(c)} AS v{i}" for i, c in enumerate(columns)])


def _sums(n: int) -> list:
    return [F.expr("count(1) AS rows"), *[F.expr(f"struct(sum(h{i} & {_LOW}), sum(shiftrightunsigned(h{i}, 32))) AS f{i}") for i in range(n)]]


def common_types(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The type each column is compared in: the common one of both sides, else text."""
    lt, rt = dict(left.dtypes), dict(right.dtypes)
    numbers = ["tinyint", "smallint", "int", "bigint", "float", "double"]

    def of(c: str) -> str:
        if lt[c] == rt[c]:
            return lt[c]
        return numbers[max(numbers.index(lt[c]), numbers.index(rt[c]))] if lt[c] in numbers and rt[c] in numbers else "string"

    return {c: of(c) for c in columns}


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows_differ, columns): buckets of keys whose rows or cells differ, and the columns that do."""
    types = common_types(left, right, columns)
    n = len(columns)
    side = lambda df: _cells(df, keys, columns, types, buckets).groupBy("_bucket").agg(*_sums(n))
    a, b = side(left).alias("a"), side(right).alias("b")
    differ = [F.when(~F.col(f"a.f{i}").eqNullSafe(F.col(f"b.f{i}")), F.lit(c)) for i, c in enumerate(columns)]
    both = a.join(b, F.col("a._bucket") == F.col("b._bucket"), "full").select(
        F.coalesce("a._bucket", "b._bucket").alias("bucket"), (~F.col("a.rows").eqNullSafe(F.col("b.rows"))).alias("rows_differ"),
        F.array_compact(F.array(*differ)).alias("columns"))
    return both.where("rows_differ OR size(columns) > 0")


def _met(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None, buckets: int, values: bool) -> tuple[list[str], DataFrame]:
    """The columns that differ anywhere, and per key of a differing bucket its rows on each side (l, r) and which of them differ (f<i>).

    ``values`` adds their least values as text (l<i>, r<i>). Keys and the columns that differ
    move alone; without ``values`` a text moves as its hash.
    """
    columns = [c for c in left.columns if c in right.columns and c not in keys] if columns is None else list(columns)
    types = common_types(left, right, columns)
    found = stored(differing_buckets(left, right, keys, columns, buckets))  # at most ``buckets`` rows
    some = {r[0] for r in found.select(F.explode("columns")).distinct().collect()}  # names of columns
    columns = [c for c in columns if c in some]
    bad = F.broadcast(found.select(F.col("bucket").alias("_bucket")))
    hashed = [f"h{i}" for i in range(len(columns))]
    plain = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")
    short = {} if values else {f"v{i}": F.expr(f"CASE WHEN v{i} IS NOT NULL THEN xxhash64(v{i}) END") for i, c in enumerate(columns) if types[c] not in plain}

    def rows(df: DataFrame, side: int) -> DataFrame:
        """Keys and values alone: cell hashes are random bits, so they are taken again where the rows meet."""
        kept = _cells(df, keys, columns, types, buckets).join(bad, "_bucket", "left_semi")
        return kept.drop("_bucket", *hashed).withColumns(short | {"_side": F.lit(side)})

    met = rows(left, 0).unionByName(rows(right, 1)).repartition(*keys)
    key = ", ".join(f"`{k}`" for k in keys)
    met = met.selectExpr("*", *[f"xxhash64({i}, {key}, v{i}, v{i} IS NULL) AS h{i}" for i in range(len(columns))])
    signed = lambda x: f"sum(CASE WHEN _side = 0 THEN {x} ELSE -({x}) END)"
    aggs = ["count_if(_side = 0) AS l", "count_if(_side = 1) AS r"]
    for i in range(len(columns)):
        aggs.append(f"{signed(f'(h{i} & {_LOW})')} <> 0 OR {signed(f'shiftrightunsigned(h{i}, 32)')} <> 0 AS f{i}")
        if values:
            aggs += [f"CAST(min(CASE WHEN _side = {side} THEN v{i} END) AS STRING) AS {name}{i}" for side, name in ((0, "l"), (1, "r"))]
    return columns, met.groupBy(*keys).agg(*[F.expr(e) for e in aggs])


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                buckets: int = BUCKETS) -> DataFrame:
    """(keys..., column, kind, left_value, right_value): every cell that differs, and every key on one side alone.

    ``kind`` is ``changed``, or with a NULL column ``left_only``, ``right_only`` or ``rows`` (the key has
    another number of rows); values are text. Columns
    of different numeric types are compared in the wider one. Null keys are a key; rows
    that repeat a key are compared as a whole by their number and cells, and show
    their least value. Equal tables shuffle ``buckets`` rows of sums and nothing else (these are
    taken at once); else each row of a differing bucket moves once, with the columns that
    differ anywhere, to where both sides of its key are compared.
    """
    keys = list(keys)
    columns, both = _met(left, right, keys, columns, buckets, values=True)
    cells = [F.when(F.col(f"f{i}"), F.struct(
        F.lit(c).alias("column"), F.lit("changed").alias("kind"), F.col(f"l{i}").alias("left_value"), F.col(f"r{i}").alias("right_value")))
        for i, c in enumerate(columns)]
    none = F.lit(None).cast("string")
    cells.append(F.when(F.col("l") != F.col("r"), F.struct(
        none.alias("column"), F.lit("rows").alias("kind"), F.col("l").cast("string").alias("left_value"), F.col("r").cast("string").alias("right_value"))))
    alone = lambda kind: F.array(F.struct(none.alias("column"), F.lit(kind).alias("kind"), none.alias("left_value"), none.alias("right_value")))
    found = F.when(F.col("r") == 0, alone("left_only")).when(F.col("l") == 0, alone("right_only")).otherwise(F.array_compact(F.array(*cells)))
    return both.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.explode(found).alias("_d")).select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], "_d.*")


def difference_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(column, kind, cells) over ``differences``, counted where the keys meet: no value moves but as a hash."""
    columns, both = _met(left, right, list(keys), columns, BUCKETS, values=False)
    kinds = [("NULL", "left_only", "r = 0"), ("NULL", "right_only", "l = 0"), ("NULL", "rows", "l > 0 AND r > 0 AND l <> r")]
    kinds += [("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'", "changed", f"l > 0 AND r > 0 AND f{i}") for i, c in enumerate(columns)]
    row = both.agg(*[F.expr(f"count_if({test}) AS n{i}") for i, (_, _, test) in enumerate(kinds)])
    args = ", ".join(f"CAST({c} AS STRING), '{kind}', n{i}" for i, (c, kind, _) in enumerate(kinds))
    return row.selectExpr(f"stack({len(kinds)}, {args}) AS (column, kind, cells)").where("cells > 0")
