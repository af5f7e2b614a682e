"""Exact order statistics without a global sort: quantiles and ntile edges.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task
(``Exchange SinglePartition``), and a distributed sort moves every row once. Here
a first aggregate takes approximate quantiles around each wanted rank
(``percentile_approx``, whose rank error is bounded by n / accuracy). They
bracket the exact value, so a second aggregate needs only the number of rows
below the bracket and the counts of the values inside it, both combined map-side.
The exact value is the one at which the cumulated count reaches the rank; this
last step sees the distinct values of a bracket, a few ten-thousandths of the rows.

``exact_quantiles`` is one lazy plan: no job runs, and nothing is written, before an
action. ``order_statistics`` and ntile edges run their few aggregates at once, on stored rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

ACCURACY = 10_000


def ranked_values(rows: DataFrame, keys: Sequence[str], targets: DataFrame, broadcast: bool) -> DataFrame:
    """The exact value at each wanted rank.

    ``rows``: (keys..., value), no NULL values. ``targets``: (keys..., id, rank,
    lo, hi), rank counted from 1 and lo <= the value at that rank <= hi. Returns
    (keys..., id, value, before, ties): ``before`` rows are smaller, ``ties`` equal.
    """
    keys = list(keys)
    targets = F.broadcast(targets) if broadcast else targets
    spot = F.when(F.col("value") < F.col("lo"), F.lit(None)).otherwise(F.col("value"))
    inside = (rows.join(targets, keys) if keys else rows.join(targets)).where("value <= hi")
    counts = inside.groupBy(*keys, "id", "rank", spot.alias("spot")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*keys, "id").orderBy(F.col("spot").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.withColumn("upto", F.sum("n").over(upto))
    hit = summed.where("upto >= rank AND upto - n < rank")
    # the bracket holds the rank by its construction; a value below it would be a wrong result, so it raises
    value = F.when(F.col("spot").isNull(), F.raise_error(F.lit("rank outside its bracket"))).otherwise(F.col("spot"))
    return hit.select(*keys, "id", value.alias("value"), (F.col("upto") - F.col("n")).alias("before"), F.col("n").alias("ties"))


def _stacked(df: DataFrame, columns: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """(group..., column, value double) rows: one SQL ``stack`` over the listed columns."""
    args = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    return df.selectExpr(*[f"`{g}`" for g in group_cols], f"stack({len(columns)}, {args}) AS (column, value)")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact discrete quantiles (``percentile_disc``) of several columns at once.

    Output: ``group_cols..., column, p, value`` with ``value`` the smallest
    value whose cumulative share reaches ``p`` (NULLs ignored; a column with no
    values yields no row). All columns are unpivoted into one (column, value)
    stream, so any number of columns costs the same two aggregates.
    """
    keys = [*group_cols, "column"]
    rows = _stacked(df, columns, list(group_cols)).where("value IS NOT NULL")
    slack = 2 / ACCURACY  # twice the error of the approximate quantiles
    ends = [max(0.0, min(1.0, float(p) + d)) for p in probs for d in (-slack, slack)]
    stats = rows.groupBy(*keys).agg(F.percentile_approx("value", ends, ACCURACY).alias("_e"), F.count(F.lit(1)).alias("_n"))
    wanted = F.array(*[F.struct(
        F.lit(float(p)).alias("id"), F.greatest(F.ceil(F.lit(float(p)) * F.col("_n")), F.lit(1)).cast("long").alias("rank"),
        F.col("_e")[2 * i].alias("lo"), F.col("_e")[2 * i + 1].alias("hi")) for i, p in enumerate(probs)])
    targets = stats.select(*keys, F.explode(wanted).alias("_t")).select(*keys, "_t.*")
    # without groups there are len(columns) x len(probs) targets
    found = ranked_values(rows, keys, targets, broadcast=not group_cols)
    return found.select(*keys, F.col("id").alias("p"), "value")


def _literal(value: float | int, kind: str) -> str:
    return f"CAST('{value!r}' AS {kind})"


def order_statistics(df: DataFrame, wanted: Sequence[tuple[str, int | Callable[[int], int]]], kind: str = "double",
                     limit: int = 200_000) -> list[tuple[float | int, int, int] | None]:
    """(value, rows before it, rows equal to it) at wanted ranks of several expressions, exact.

    ``wanted``: (SQL expression of type ``kind``, rank from 1 or a function of the
    expression's number of values); NULL is no value, and a rank beyond the values gives None.
    ``df`` is read a few times, so it should be stored. A bracket around each rank, from
    quantile sketches, is narrowed until at most ``limit`` rows are in it (each round
    leaves a few thousandths) or they are all equal; its values are then counted. A bracket that
    misses its rank is not taken but widened. Every round is two wide aggregates
    with one row as their result; nothing is sorted but a bracket's counts.
    """
    if not wanted:
        return []
    exprs = list(dict.fromkeys(e for e, _ in wanted))
    first = df.agg(*[F.expr(f"struct(count({e}) AS n, min({e}) AS lo, max({e}) AS hi)").alias(f"s{i}") for i, e in enumerate(exprs)]).first()
    of = {e: first[f"s{i}"] for i, e in enumerate(exprs)}
    targets = []  # [expression, rank among all, lo, hi, rows below lo, rows inside]
    for e, rank in wanted:
        s = of[e]
        rank = rank(s["n"]) if callable(rank) else rank
        targets.append([e, rank, s["lo"], s["hi"], 0, s["n"]] if 1 <= rank <= s["n"] else None)

    def inside(t) -> str:
        return f"({t[0]}) >= {_literal(t[2], kind)} AND ({t[0]}) <= {_literal(t[3], kind)}"

    slack = 0.002  # of a bracket's rows; a sketch of 4,000 items is off by less
    while wide := [t for t in targets if t and t[5] > limit and t[2] != t[3]]:
        brackets = list(dict.fromkeys((t[0], t[2], t[3]) for t in wide))  # targets that share one share its sketch
        shares = {b: [(t, (t[1] - t[4]) / t[5]) for t in wide if (t[0], t[2], t[3]) == b] for b in brackets}
        aggs = []
        for i, b in enumerate(brackets):
            ends = ", ".join(f"{min(1.0, max(0.0, p + d))!r}D" for _, p in shares[b] for d in (-slack, slack))
            inner = f"CASE WHEN {inside(b[:1] + (None,) + b[1:])} THEN ({b[0]}) END"
            aggs.append(F.expr(f"kll_sketch_get_quantile_{kind}(kll_sketch_agg_{kind}({inner}, 4000), array({ends}))").alias(f"e{i}"))
        found = df.agg(*aggs).first()
        tried = {id(t): tuple(found[f"e{i}"][2 * k:2 * k + 2]) for i, b in enumerate(brackets) for k, (t, _) in enumerate(shares[b])}
        narrow = lambda t: (t[0], None, *tried[id(t)])
        counts = df.agg(*[F.expr(f"struct(count_if(({t[0]}) < {_literal(tried[id(t)][0], kind)}) AS b, count_if({inside(narrow(t))}) AS n)").alias(f"c{i}")
                          for i, t in enumerate(wide)]).first()
        moved = False
        for i, t in enumerate(wide):
            b, n = counts[f"c{i}"]
            if b < t[1] <= b + n and n < t[5]:
                t[2:] = [*tried[id(t)], b, n]
                moved = True
        if not moved:  # the brackets missed, or hold one value nearly alone
            if slack >= 0.5:
                break
            slack *= 4
    out: list[tuple | None] = [None] * len(wanted)
    open_ = [(i, t) for i, t in enumerate(targets) if t]
    for i, t in open_:
        if t[2] == t[3]:
            out[i] = (t[2], t[4], t[5])
    rest = [(i, t) for i, t in open_ if out[i] is None]
    if rest:
        hits = _counted(df, [(i, t[0], t[1], t[2], t[3]) for i, t in rest], kind)
        for i, _ in rest:
            out[i] = hits[i]
    return out


def _counted(df: DataFrame, brackets: Sequence[tuple], kind: str) -> dict[int, tuple]:
    """id -> (value, before, ties) from counting the values in (id, expression, rank, lo, hi); none where the rank lies outside."""
    def cell(i: int, e: str, rank: int, lo, hi) -> Column:
        value = f"CASE WHEN ({e}) >= {_literal(lo, kind)} THEN CAST(({e}) AS {kind}) END"  # rows below the bracket count as one NULL
        return F.expr(f"CASE WHEN ({e}) <= {_literal(hi, kind)} THEN named_struct('id', {i}, 'rank', {rank}L, 'value', {value}) END")

    cells = F.array_compact(F.array(*[cell(*b) for b in brackets]))
    counts = df.select(F.explode(cells).alias("c")).groupBy("c.id", "c.rank", "c.value").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("id").orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    hits = counts.withColumn("upto", F.sum("n").over(upto)).where("upto >= rank AND upto - n < rank AND value IS NOT NULL")
    return {r.id: (r.value, r.upto - r.n, r.n) for r in hits.collect()}  # one row a target


def ntile_edges(df: DataFrame, k: int, measures: Sequence[str], key: str) -> list[tuple[str, int, int, int]]:
    """(measure, tile, value, last): the last row of each tile but the highest, over each measure's order.

    Rows are ordered by the measure (a long, no NULLs) and then by ``key`` (a
    long, unique). A row is beyond an edge when its measure is larger than ``value``,
    or equal and its key larger than ``last``. At most len(measures) x (k - 1) edges.
    """
    # tile j ends after j * q + min(j, r) rows of n = k * q + r
    ends = lambda j: lambda n: max(1, j * (n // k) + min(j, n % k))
    wanted = [(m, j) for m in measures for j in range(1, k)]
    found = order_statistics(df, [(f"CAST(`{m}` AS BIGINT)", ends(j)) for m, j in wanted], "bigint")
    n, edges, split = None, [], []
    if any(f is not None for f in found):
        n = df.count()
    for (m, j), hit in zip(wanted, found):
        if hit is None:
            continue
        value, before, ties = hit
        need = ends(j)(n) - before
        edges.append([m, j, value, 2**63 - 1])
        if need < ties:  # within the ties of an edge the key decides: the need-th smallest key is the tile's last
            split.append((len(edges) - 1, (f"CASE WHEN `{m}` = {_literal(value, 'bigint')} THEN CAST(`{key}` AS BIGINT) END", need)))
    for (i, _), hit in zip(split, order_statistics(df, [w for _, w in split], "bigint")):
        edges[i][3] = hit[0]
    return [tuple(e) for e in edges]


def ntile_columns(df: DataFrame, k: int, measures: dict[str, str], key: str) -> DataFrame:
    """Add ``ntile(k) OVER (ORDER BY measure, key)`` for several measures: {new column: measure}.

    Measures are longs without NULLs and ``key`` is a unique long. ``df`` is stored, as the
    edges are found by reading it a few times; no row of it is sorted or moved. The few
    edges are literals of the plan.
    """
    kept = stored(df)
    edges = ntile_edges(kept, k, sorted(set(measures.values())), key)

    def tile(m: str) -> str:
        past = [f"CASE WHEN `{m}` > {_literal(v, 'bigint')} OR (`{m}` = {_literal(v, 'bigint')} AND `{key}` > {_literal(last, 'bigint')}) THEN 1 ELSE 0 END"
                for name, _, v, last in edges if name == m]
        return " + ".join(["1", *past])

    return kept.withColumns({c: F.expr(f"CAST({tile(m)} AS INT)") for c, m in measures.items()})


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   names: Sequence[str], group_cols: Sequence[str] = (),
                   exact: bool = True, accuracy: int = ACCURACY) -> DataFrame:
    """One row per (group, column) with one column per requested quantile.

    ``exact=False`` uses ``percentile_approx`` alone (the reference's estimator,
    one aggregate pass with bounded sketch memory).
    """
    group_cols = list(group_cols)
    if exact:
        long = exact_quantiles(df, columns, probs, group_cols)
        return long.groupBy(*group_cols, "column").agg(*[
            F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(nm)
            for p, nm in zip(probs, names)
        ])
    stacked = _stacked(df, columns, group_cols)
    agg = stacked.groupBy(*group_cols, "column").agg(
        F.percentile_approx("value", [float(p) for p in probs], accuracy).alias("_q"))
    return agg.select(*group_cols, "column", *[
        F.col("_q")[i].alias(nm) for i, nm in enumerate(names)
    ])
