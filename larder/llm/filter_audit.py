"""Filter interaction audit by min-plus removal ranks.

Every document gets a failure mask, one bit per filter. A filter order is a
permutation; its inverse says at which position each filter runs. The min-plus
product of the masks (0 where a filter fails, infinite where it passes) with the
positions is, for each mask and order, the first position whose filter fails: the
step that removes the document. Steps only depend on the mask, so documents are
counted per part and mask in Spark and the counts are scattered over steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letter -> SQL condition that holds where a document fails, over ``text`` (never null) and ``words`` (its words).
TEXT_FILTERS = {
    "A": "size(words) < 200",
    "B": "100 * size(array_distinct(words)) < 50 * size(words)",
    "C": "100 * regexp_count(text, '[A-Z]') > 2 * char_length(text)",
    "D": "text rlike '[#$%&*|]'",
}
COPY_FILTER = "E"
_WORD = r"[^\\x20\\x09-\\x0D]+"
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def removal_steps(fails: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Step (1-based) at which each mask is removed under each order; number of filters + 1 where it is kept.

    ``fails`` is masks x filters (boolean), ``orders`` is orders x filters, the filter
    that runs at each position. This is the min-plus product of the masks with the
    inverse permutations.
    """
    filters = fails.shape[1]
    position = np.argsort(orders, axis=1) + 1                        # orders x filters: when each filter runs
    cost = np.where(fails, 0, filters + 1)                           # masks x filters
    return np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2), filters + 1)


class Interaction:
    """Scatter matrices of a number of filters: which masks count at each (order, step)."""

    def __init__(self, letters: Sequence[str]):
        k = len(letters)
        self.orders = np.array(list(permutations(range(k))))
        self.names = ["".join(letters[i] for i in order) for order in self.orders]
        self.fails = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1 == 1
        self.step = removal_steps(self.fails, self.orders)           # masks x orders
        at = np.arange(1, k + 1)
        here = self.step[:, :, None] == at                           # masks x orders x steps
        failing = self.fails[:, self.orders]                         # does the mask fail the filter of (order, step)
        earlier = self.step[:, :, None] < at
        alone = failing & (self.fails.sum(axis=1) == 1)[:, None, None]
        self.flat = {"removed": here, "redundant": failing & earlier, "unique_fails": alone, "kept": self.step[:, :, None] > at}
        self.flat = {n: m.reshape(1 << k, -1).astype(np.int64) for n, m in self.flat.items()}

    def counts(self, docs: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
        """Counts per (part, order x step) from counts per (part, mask)."""
        out = {n: docs @ m for n, m in self.flat.items()}
        out["good_lost"], out["toxic_lost"] = good @ self.flat["removed"], toxic @ self.flat["removed"]
        runs = self.orders.reshape(-1)                               # the filter of each (order, step)
        total = np.stack([out["removed"][:, runs == f].sum(axis=1) for f in range(self.orders.shape[1])], axis=1)
        out["shapley"] = total[:, runs]
        return out


def failure_masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc, part, mask, h1, h2, n): rows by id, part and whole text, with the mask of the filters on text alone.

    ``h1`` and ``h2`` are 128 bits of the text. Texts never leave the scan; repeated
    rows are added up before the shuffle.
    """
    rows = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.expr(f"regexp_extract_all(text, '{_WORD}', 0)"))
    bits = [f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, cond in enumerate(TEXT_FILTERS.values())]
    return rows.select("doc", "part", F.expr(" + ".join(bits)).alias("mask"), F.xxhash64("text").alias("h1"),
                       F.xxhash64(F.md5("text")).alias("h2")).groupBy("doc", "part", "mask", "h1", "h2").agg(
        F.count(F.lit(1)).alias("n"))


def mask_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
                quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, mask, docs, good, toxic): documents by part and failure mask, all five filters.

    A text's first holder is found by the smallest id of its group (reduced before
    the shuffle) and joined by id and text, so a text with many copies meets in no task.
    """
    rows = failure_masks(docs, doc_id, text, part)
    first = rows.where("doc IS NOT NULL").groupBy("h1", "h2").agg(F.min("doc").alias("doc")).withColumn("_first", F.lit(True))
    marks = labels.select(F.col(doc_id).alias("doc"), F.col(quality).alias("q"), F.col(toxic).alias("t")).where("doc IS NOT NULL").groupBy(
        "doc").agg(F.coalesce(F.max(F.col("q") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("t") == 1), F.lit(False)).alias("toxic"))
    copy = F.when(F.col("doc").isNotNull() & F.col("_first").isNull(), 1 << len(TEXT_FILTERS)).otherwise(0)
    joined = rows.join(first, ["h1", "h2", "doc"], "left").join(marks, "doc", "left")
    held = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return joined.withColumn("mask", F.col("mask") + copy).groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), held("good").alias("good"), held("toxic").alias("toxic"))


def filter_interactions(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
                        quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """One row per part, filter order and step: what each filter removes, and what it would have.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley (all counts within the part). Filters A to D are
    ``TEXT_FILTERS``; E fails where a smaller id holds the same text. A null text is
    empty, a null part the empty string. A row without an id is a copy of none and
    makes none; rows that repeat an id and its text count each and are no copies of one another. A
    document has a label of 1 if any of its label rows says so; label rows without
    an id, or of unknown documents, are ignored. An empty table gives no rows. Further
    columns are ignored.
    """
    counted = mask_counts(docs, labels, doc_id, text, part, quality, toxic)
    letters = [*TEXT_FILTERS, COPY_FILTER]
    masks = 1 << len(letters)

    def vector(c: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)) for m in range(masks)]).alias(c)

    parts = counted.groupBy("part").agg(vector("docs"), vector("good"), vector("toxic"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Interaction(letters)
        orders, k = len(model.names), len(letters)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                of = {c: some.column(c).flatten().to_numpy().reshape(-1, masks) for c in ("docs", "good", "toxic")}
                got = model.counts(of["docs"], of["good"], of["toxic"])
                rows = some.num_rows
                names = some.column("part").take(pa.array(np.repeat(np.arange(rows), orders * k)))
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(np.tile(np.repeat(np.array(model.names, dtype=object), k), rows), pa.string()),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows * orders)),
                     *[pa.array(got[c].reshape(-1)) for c in _COUNTS]],
                    names=["part", "filter_order", "step", *_COUNTS])

    return parts.mapInArrow(scatter, schema)


def filter_interactions_sql() -> str:
    """DuckDB SQL for ``filter_interactions`` over ``documents`` and ``labels`` (ids without repeats)."""
    each = ", ".join(f"({i}, '{c}')" for i, c in enumerate("ABCDE"))
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS low FROM d),
    f AS (SELECT doc_id, part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
                 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > low, false)] AS fails
          FROM w),
    l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
    m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
          FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
    x(i, c) AS (VALUES {each}),
    o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS runs
          FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
    s AS (SELECT filter_order, runs, unnest([1, 2, 3, 4, 5]) AS step FROM o),
    t AS (SELECT m.*, o.filter_order, least(
              {", ".join(f"CASE WHEN fails[runs[{j}] + 1] THEN {j} ELSE 6 END" for j in range(1, 6))}) AS gone
          FROM m, o),
    c AS (SELECT part, filter_order, s.step, runs[s.step] AS filter,
                 sum(CASE WHEN gone > s.step THEN n ELSE 0 END)::BIGINT AS kept,
                 sum(CASE WHEN gone = s.step THEN n ELSE 0 END)::BIGINT AS removed,
                 sum(CASE WHEN gone < s.step AND fails[runs[s.step] + 1] THEN n ELSE 0 END)::BIGINT AS redundant,
                 sum(CASE WHEN fails[runs[s.step] + 1] AND len(list_filter(fails, lambda b: b)) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
                 sum(CASE WHEN gone = s.step THEN good ELSE 0 END)::BIGINT AS good_lost,
                 sum(CASE WHEN gone = s.step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
          FROM t JOIN s USING (filter_order) GROUP BY ALL)
    SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM c
    """
