"""Audits taken while a table is written: no scan of their own."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..sources.files import materialize

METRICS = "table string, column string, metric string, value long"


def _tests(df: DataFrame, negatives: Sequence[str]) -> list[tuple[str, str, str]]:
    """(column, metric, SQL aggregate) of a table's audit."""
    out = [(None, "rows", "count(1)")]
    for f in df.schema.fields:
        x = f"`{f.name}`"
        null = f"{x} IS NULL OR isnan({x})" if isinstance(f.dataType, (DoubleType, FloatType)) else f"{x} IS NULL"
        out.append((f.name, "nulls", f"count_if({null})"))
    out += [(c, "negatives", f"count_if(`{c}` < 0)") for c in negatives if c in df.columns]
    return out


def write_observed(df: DataFrame, name: str, path: str, negatives: Sequence[str] = (),
                   partition_by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` under ``path``; return the table read back and its metrics.

    Metrics (table, column, metric, value): ``rows`` of the table, ``nulls`` of every
    column (NaN counts), ``negatives`` of the columns named. They are gathered by the
    tasks that write. A task that runs again after a lost executor can be counted
    twice, so the rows are compared with those in the files' footers; if they
    differ, the metrics are taken from the written table instead.
    """
    tests = _tests(df, negatives)
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    aggs = lambda: [F.expr(e).alias(f"m{i}") for i, (_, _, e) in enumerate(tests)]
    written = materialize(df.observe(seen, *aggs()), path, partition_by)
    values = seen.get
    if not values or values["m0"] != written.count():
        values = written.agg(*aggs()).first().asDict()
    rows = [(name, c, m, int(values[f"m{i}"] or 0)) for i, (c, m, _) in enumerate(tests)]
    return written, df.sparkSession.createDataFrame(rows, METRICS)


def overview(metrics: DataFrame) -> DataFrame:
    """table, rows, cols."""
    return metrics.groupBy("table").agg(F.max(F.when(F.col("metric") == "rows", F.col("value"))).alias("rows"),
                                        F.count_if(F.col("metric") == "nulls").cast("int").alias("cols"))


def nulls(metrics: DataFrame) -> DataFrame:
    """table, column, null_count, null_pct of the columns with nulls."""
    from ..functions.numeric import pct_sql
    rows = metrics.where("metric = 'rows'").select("table", F.col("value").alias("_total"))
    return metrics.where("metric = 'nulls' AND value > 0").join(F.broadcast(rows), "table").selectExpr(
        "table", "column", "value AS null_count", f"{pct_sql('value', '_total')} AS null_pct")


def negatives(metrics: DataFrame) -> DataFrame:
    """table, column, negative_count of the columns with negative values."""
    return metrics.where("metric = 'negatives' AND value > 0").selectExpr("table", "column", "value AS negative_count")


def write_all_observed(tables: Mapping[str, DataFrame], target: str, checked: Mapping[str, Sequence[str]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """``write_observed`` of several tables under ``target``, side by side; their metrics in one table."""
    with ThreadPoolExecutor(4) as pool:
        running = {name: pool.submit(write_observed, df, name, f"{target.rstrip('/')}/{name}", checked.get(name, ())) for name, df in tables.items()}
    written, metrics = {}, None
    for name, done in running.items():
        written[name], found = done.result()
        metrics = found if metrics is None else metrics.unionByName(found)
    return written, metrics
