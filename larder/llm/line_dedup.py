"""Line de-duplication by site-relative frequency (DataFrame functions only).

Pages are grouped by host. A line's frequency is the number of the host's pages
that contain it divided by the host's page total; lines above a boilerplate
ratio are dropped from every page of that host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(line: Column) -> Column:
    """96-bit identity of a line, white space at its ends ignored."""
    return F.struct(F.xxhash64(F.trim(line)).alias("h"), F.hash(F.trim(line)).alias("g"))


def boilerplate_lines(docs: DataFrame, host: str = "source", text: str = "text",
                      ratio: float = 0.1, min_pages: int = 3) -> DataFrame:
    """One row per host with boilerplate: (host, bad), the keys of its boilerplate lines.

    A line counts once per page. It is boilerplate when at least ``min_pages``
    pages of the host hold it and they are more than ``ratio`` of the host's
    pages. A host has at most (lines per page / ratio) such lines, so ``bad``
    stays small however many pages the host has. Pages are reduced to distinct
    line keys before the shuffle and counted map-side, so neither a hot line nor
    a hot host meets in one task.
    """
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    keys = F.array_distinct(F.transform(
        F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != ""), _key))
    seen = pages.select("host", F.explode(keys).alias("key")).groupBy("host", "key").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages).alias("s")
    t = totals.alias("t")
    return (seen.join(t, F.col("s.host").eqNullSafe(F.col("t.host")))
            .where(F.col("s.n") > F.lit(float(ratio)) * F.col("t.pages"))
            .groupBy(F.col("s.host").alias("host")).agg(F.collect_list("s.key").alias("bad")))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                     ratio: float = 0.1, min_pages: int = 3) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``; all columns and rows stay.

    Other lines, blank lines among them, keep their order and are joined by
    line feeds again; a page without boilerplate keeps its text unchanged. A
    null text stays null, an empty one empty; a null host is a host of its own;
    an empty table gives an empty one. Repeated rows count as pages each. Further
    columns pass through under any name.
    """
    bad = boilerplate_lines(docs, host, text, ratio, min_pages).select(F.struct("host", "bad").alias("__boiler"))
    cols = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__page"))
    page = F.col("__page")
    joined = packed.join(bad, page[host].eqNullSafe(F.col("__boiler.host")), "left")
    kept = F.array_join(F.filter(F.split(page[text], "\n", -1), lambda x: (F.trim(x) == "") | ~F.array_contains(
        F.col("__boiler.bad"), _key(x))), "\n")
    cut = F.when(F.col("__boiler.bad").isNull() | page[text].isNull(), page[text]).otherwise(kept)
    return joined.select(*[cut.alias(c) if c == text else page[c].alias(c) for c in cols])


def line_report(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text",
                ratio: float = 0.1, min_pages: int = 3) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row; ``n_lines`` counts non-blank lines before the cut."""
    count = lambda c: F.size(F.filter(F.split(F.coalesce(c, F.lit("")), "\n", -1), lambda x: F.trim(x) != ""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("source"), F.col(text).alias("text"),
                       count(F.col(text)).cast("long").alias("n_lines"))
    cut = drop_boilerplate(rows, "source", "text", ratio, min_pages)
    return cut.select("doc_id", "text", "n_lines", (F.col("n_lines") - count(F.col("text"))).alias("n_dropped"))


def line_report_sql(ratio: float = 0.1, min_pages: int = 3) -> str:
    """DuckDB SQL for ``line_report`` over the table ``documents``."""
    return f"""
    WITH pages AS (
      SELECT doc_id, source, text, row_number() OVER () AS rid,
             string_split(text, chr(10)) AS lines FROM documents),
    flat AS (SELECT rid, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM pages),
    totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
    seen AS (SELECT source, trim(line) AS line, count(DISTINCT rid) AS n
             FROM flat WHERE trim(line) <> '' GROUP BY ALL),
    bad AS (SELECT s.source, s.line FROM seen s JOIN totals t ON s.source IS NOT DISTINCT FROM t.source
            WHERE s.n >= {min_pages} AND s.n > {float(ratio)!r} * t.pages),
    marked AS (SELECT f.*, b.line IS NOT NULL AS is_bad FROM flat f LEFT JOIN bad b
               ON f.source IS NOT DISTINCT FROM b.source AND trim(f.line) = b.line),
    cut AS (SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT is_bad), '') AS text,
                   count(*) FILTER (trim(line) <> '') AS n_lines,
                   count(*) FILTER (is_bad) AS n_dropped FROM marked GROUP BY rid)
    SELECT p.doc_id, CASE WHEN p.text IS NULL THEN NULL ELSE c.text END AS text,
           coalesce(c.n_lines, 0)::BIGINT AS n_lines, coalesce(c.n_dropped, 0)::BIGINT AS n_dropped
    FROM pages p LEFT JOIN cut c USING (rid)
    """
