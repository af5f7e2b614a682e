"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are token lists. Shared runs of a few tokens
(seeds) join documents with items. For each joined pair the longest common run
of unmarked tokens is marked again and again, found by running Karp-Rabin
hashes of falling length. An item's coverage is the share of its tokens under
tiles, so a passage whose parts are reordered is still found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import text_batches

_BASE = np.uint64(0x9E3779B97F4A7C15)
_words = re.compile(r"\w+").findall
_BITS = 26  # of the seed filter: 8 MB


class _Tokens:
    """Texts -> 64-bit token hashes; hashes of known words are kept."""

    LIMIT = 150_000

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > self.LIMIT:
            self.known.clear()
        words = [_words(t.lower()) if t else [] for t in texts]
        for w in set().union(*words) - self.known.keys():
            self.known[w] = xxhash.xxh64_intdigest(w.encode("utf-8"))
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), dtype=np.uint64)
        return np.split(flat, np.cumsum([len(w) for w in words])[:-1]) if words else []


def gram_hashes(tokens: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``k`` tokens."""
    n = len(tokens) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * _BASE + tokens[i:i + n]
    h ^= h >> np.uint64(32)
    return h * _BASE


def tile(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item position, document position, length), longest first.

    Of equally long matches the one that starts first in the item, then in the
    document, is marked. Matches shorter than ``min_match`` tokens, or than the
    item if that is shorter, are not tiles.
    """
    least = min(min_match, len(item))
    if not least:
        return []
    # only document tokens inside a shared seed can be in a tile
    hit = np.isin(gram_hashes(doc, least), gram_hashes(item, least))
    near = np.zeros(len(doc), bool)
    for i in range(least):
        near[i:i + len(hit)] |= hit
    free_i, free_d = np.ones(len(item), bool), near.copy()
    tiles = []
    length = len(item)
    while length >= least:
        runs = np.diff(np.r_[0, free_d.astype(int), 0])
        longest = (np.flatnonzero(runs == -1) - np.flatnonzero(runs == 1)).max(initial=0)
        length = min(length, longest)
        if length < least:
            break
        clear = lambda free: np.flatnonzero(np.convolve(free, np.ones(length, int), "valid") == length)
        at_i, at_d = clear(free_i), clear(free_d)
        hash_i, hash_d = gram_hashes(item, length)[at_i], gram_hashes(doc, length)[at_d]
        where: dict[int, list[int]] = {}
        for h, p in zip(hash_d.tolist(), at_d.tolist()):
            where.setdefault(h, []).append(p)
        for h, i in zip(hash_i.tolist(), at_i.tolist()):
            if not free_i[i:i + length].all():
                continue
            for d in where.get(h, ()):
                if free_d[d:d + length].all() and np.array_equal(item[i:i + length], doc[d:d + length]):
                    tiles.append((i, d, length))
                    free_i[i:i + length] = free_d[d:d + length] = False
                    break
        length -= 1
    return tiles


def coverage(item: np.ndarray, doc: np.ndarray, min_match: int) -> float:
    """Share of the item's tokens under tiles (0 for an item without tokens)."""
    return sum(t[2] for t in tile(item, doc, min_match)) / len(item) if len(item) else 0.0


def _item_seeds(items: DataFrame, min_match: int) -> DataFrame:
    """(seed, k, item, item_key, n, n_tokens): the seeds of each item, how often it holds each, and its length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens()
        for batch in text_batches(batches):
            out = {"seed": [], "k": [], "item": [], "item_key": [], "n": [], "n_tokens": []}
            ids, keys = batch.column("item").to_pylist(), batch.column("item_key").to_pylist()
            for i, key, t in zip(ids, keys, tokens(batch.column("text").to_pylist())):
                k = min(min_match, len(t))
                if not k:
                    continue
                seeds, n = np.unique(gram_hashes(t, k).view(np.int64), return_counts=True)
                for c, v in zip(out.values(), (seeds.tolist(), [k] * len(n), [i] * len(n), [key] * len(n), n.tolist(), [len(t)] * len(n))):
                    c.extend(v)
            kinds = dict.fromkeys(out, pa.int64()) | {"item": batch.schema.field("item").type}
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(list(kinds.items())))

    return items.select("item", "item_key", "text").mapInArrow(
        run, f"seed long, k long, item {id_kind(items, 'item')}, item_key long, n long, n_tokens long")


def _seed_filter(seeds: DataFrame, max_slots: int) -> np.ndarray | None:
    """Bits of the seeds' leading hash bits; None beyond ``max_slots``, when all grams go to the join."""
    slots = seeds.select(F.expr(f"shiftrightunsigned(seed, {64 - _BITS})").alias("s")).distinct().limit(max_slots + 1)
    found = slots.toPandas()["s"].to_numpy(dtype=np.int64)
    if len(found) > max_slots:
        return None
    bits = np.zeros(1 << (_BITS - 3), np.uint8)
    np.bitwise_or.at(bits, found >> 3, (1 << (found & 7)).astype(np.uint8))
    return bits


def id_kind(df: DataFrame, name: str) -> str:
    """The type that ids are compared in: whole numbers as longs, others as they are."""
    kind = df.schema[name].dataType
    return "long" if isinstance(kind, IntegralType) else kind.simpleString()


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", min_match: int = 5, threshold: float = 0.6,
                  max_filter_slots: int = 4_000_000) -> DataFrame:
    """(doc_id, text_key, item_id, coverage) of each document and item whose coverage reaches ``threshold``.

    Tokens are lower-case word runs. Items with less than ``min_match`` tokens
    must occur whole; items without tokens, null and empty texts match nothing.
    A document is its id and text: repeated rows count once, null ids are
    ids like others, of documents and of items; ids may be numbers or text. Repeated benchmark rows are taken once. Empty tables give no
    pair.

    Documents' grams pass a filter of the benchmark's seeds (a bitmap of fixed size
    sent to the tasks; left out for benchmarks beyond ``max_filter_slots``) and
    are joined with the seeds. Tiles are at least ``min_match`` long, so a
    pair needs threshold / min_match of the item's seed positions; pairs with
    fewer are dropped before any text is moved. Only texts of documents in a
    remaining pair are shuffled.
    """
    spark = docs.sparkSession
    id_type, item_type = id_kind(docs, doc_id), id_kind(items, item_id)
    rows = docs.select(F.col(f"`{doc_id}`").cast(id_type).alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where(
        "text IS NOT NULL").withColumn("key", F.xxhash64("text"))
    bench = items.select(F.col(f"`{item_id}`").cast(item_type).alias("item"), F.col(f"`{item_text}`").cast("string").alias("text")).distinct().withColumn(
        "item_key", F.xxhash64("text"))
    seeds = _item_seeds(bench, min_match).groupBy("seed", "k", "item", "item_key", "n_tokens").agg(F.max("n").alias("n"))
    lengths = sorted(r.k for r in seeds.select("k").distinct().collect())  # min_match values at most
    bits = _seed_filter(seeds, max_filter_slots)
    sent = spark.sparkContext.broadcast(bits)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, have = _Tokens(), sent.value
        for batch in text_batches(batches):
            out = []
            for t in tokens(batch.column("text").to_pylist()):
                found = []
                for k in lengths:
                    h = gram_hashes(t, k)
                    if have is not None:
                        slot = (h >> np.uint64(64 - _BITS)).astype(np.int64)
                        h = h[(have[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1]
                    found.append(np.unique(h))
                out.append(np.concatenate(found) if found else np.zeros(0, np.uint64))
            size = np.array([len(x) for x in out])
            if not size.sum():
                continue
            at = pa.array(np.repeat(np.arange(len(out)), size))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("key").take(at),
                                              pa.array(np.concatenate(out).view(np.int64))], ["id", "key", "seed"])

    hits = rows.mapInArrow(grams, f"id {id_type}, key long, seed long")
    # repeated rows give a seed twice; a seed's n counts once per document
    pairs = (hits.join(seeds, "seed").groupBy("id", "key", "item", "item_key", "n_tokens", "seed").agg(F.max("n").alias("n"))
             .groupBy("id", "key", "item", "item_key", "n_tokens").agg(F.sum("n").alias("n"))
             .where(F.col("n") * F.lit(min_match) >= F.lit(float(threshold)) * F.col("n_tokens"))
             .groupBy("id", "key").agg(F.collect_set(F.struct("item", "item_key")).alias("items")))
    texts = (rows.alias("r").join(pairs.alias("p"), F.col("r.id").eqNullSafe(F.col("p.id")) & (F.col("r.key") == F.col("p.key")))
             .select("r.id", "r.key", "r.text", F.explode("p.items").alias("i"))).alias("t")
    both = texts.join(bench.alias("b"), F.col("t.i.item").eqNullSafe(F.col("b.item")) & (F.col("t.i.item_key") == F.col("b.item_key"))).select(
        "t.id", "t.key", "b.item", "t.text", F.col("b.text").alias("item_text"))

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens()
        for batch in text_batches(batches):
            d, i = tokens(batch.column("text").to_pylist()), tokens(batch.column("item_text").to_pylist())
            share = pa.array([coverage(x, y, min_match) for x, y in zip(i, d)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), batch.column("item"), share],
                                             ["id", "key", "item", "coverage"])

    found = both.mapInArrow(tiles, f"id {id_type}, key long, item {item_type}, coverage double").where(F.col("coverage") >= threshold)
    return found.groupBy("id", "key", "item").agg(F.max("coverage").alias("coverage")).select(
        F.col("id").alias("doc_id"), F.col("key").alias("text_key"), F.col("item").alias("item_id"), "coverage")


def document_report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, contaminated, n_items, max_coverage, item_ids) of every row of ``docs``."""
    found = contamination(docs, items, **options).groupBy("doc_id", "text_key").agg(
        F.count(F.lit(1)).alias("n_items"), F.max("coverage").alias("max_coverage"),
        F.sort_array(F.collect_list(F.struct("item_id")))["item_id"].alias("item_ids")).alias("f")
    d = docs.select(F.col("doc_id").cast(id_kind(docs, "doc_id")).alias("doc_id"), F.xxhash64("text").alias("text_key")).alias("d")
    return d.join(found, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key")), "left").select(
        "d.doc_id", F.col("f.n_items").isNotNull().alias("contaminated"), F.coalesce("f.n_items", F.lit(0)).alias("n_items"),
        F.coalesce("f.max_coverage", F.lit(0.0)).alias("max_coverage"),
        F.coalesce("f.item_ids", F.array().cast(found.schema["item_ids"].dataType)).alias("item_ids"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` without a benchmark item in them, all columns as they were."""
    found = contamination(docs, items, doc_id=doc_id, text=text, **options).select(
        F.struct(F.col("doc_id").alias("i"), F.col("text_key").alias("k")).alias("__leak")).distinct()
    page = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"))
    own = F.struct(F.col("__doc")[doc_id].cast(id_kind(docs, doc_id)).alias("i"), F.xxhash64(F.col("__doc")[text].cast("string")).alias("k"))
    return page.join(found, own.eqNullSafe(F.col("__leak")), "left_anti").select("__doc.*")
