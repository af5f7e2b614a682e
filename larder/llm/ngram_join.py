"""N-gram Jaccard self-join with a MinHash LSH forest and exact verification.

Every distinct text has a signature of MinHash values, read as one path in each
of several prefix tries. Texts that share a trie prefix are candidates. The
matched prefix is short enough for links right at the threshold to be found with the
target's chance; a longer one serves only where no candidates are that far
apart. Candidates are then compared by their whole shingle sets.

Candidates are never written as pairs. The texts of a trie node are tied to
the node's smallest text, ties are joined to groups, and a group is compared in
blocks of bounded size, so that all pairs of a group which can reach the
threshold are counted inside tasks and only counts and spanning links leave them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, stored, text_batches

TREES, DEPTH = 16, 6
_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Texts -> 64-bit hashes of their runs of ``n`` words (shorter texts: one run of all words)."""

    LIMIT = 150_000

    def __init__(self, n: int):
        self.n, self.known = n, {}

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > self.LIMIT:
            self.known.clear()
        words = [t.split() if t else [] for t in texts]
        for w in set().union(*words) - self.known.keys():
            self.known[w] = xxhash.xxh64_intdigest(w.encode("utf-8"))
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), dtype=np.uint64)
        out, at = [], 0
        for ws in words:
            out.append(self._runs(flat[at:at + len(ws)]))
            at += len(ws)
        return out

    def _runs(self, tokens: np.ndarray) -> np.ndarray:
        k = min(self.n, len(tokens))
        h = np.full(max(0, len(tokens) - k + 1) if k else 0, k, np.uint64)
        for i in range(k):
            h = (h ^ (h >> np.uint64(29))) * _BASE + tokens[i:i + len(h)]
        h ^= h >> np.uint64(32)
        return h * _BASE


def signatures(shingles: list[np.ndarray]) -> np.ndarray:
    """MinHash values (texts, TREES * DEPTH) of non-empty shingle lists."""
    out = np.empty((len(shingles), len(_A)), np.uint32)
    i = 0
    while i < len(shingles):
        j, size = i, 0
        while j < len(shingles) and (j == i or size + len(shingles[j]) <= 1 << 16):
            size += len(shingles[j])
            j += 1
        flat = np.concatenate(shingles[i:j])
        starts = np.cumsum([0, *(len(s) for s in shingles[i:j - 1])])
        for k, (a, b) in enumerate(zip(_A, _B)):
            out[i:j, k] = np.minimum.reduceat((flat * a + b) >> np.uint64(32), starts)
        i = j
    return out


def collision(similarity: np.ndarray, depth: int) -> np.ndarray:
    """Chance that two texts share a prefix of ``depth`` in one of the tries."""
    return 1 - (1 - np.asarray(similarity, float) ** depth) ** TREES


def _signed(texts: DataFrame, n: int) -> DataFrame:
    """(key, size, sig) of each distinct text with words; size counts its distinct shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in text_batches(batches):
            found = shingler(batch.column("text").to_pylist())
            some = [i for i, s in enumerate(found) if len(s)]
            if not some:
                continue
            sig = signatures([found[i] for i in some]).view(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, sig.shape[1], dtype=np.int32)), pa.array(sig.ravel()))
            size = pa.array([len(np.unique(found[i])) for i in some], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(some)), size, lists], ["key", "size", "sig"])

    signed = texts.select("key", "text").mapInArrow(run, "key binary, size long, sig array<int>")
    return signed.groupBy("key").agg(F.first("size").alias("size"), F.first("sig").alias("sig"))


def _ties(signed: DataFrame, depth: int) -> DataFrame:
    """(a, b): each text and the smallest text of a trie node of ``depth`` that holds both."""
    node = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(
        t, F.slice("sig", t * DEPTH + 1, F.lit(depth))))
    nodes = signed.select("key", F.explode(node).alias("node"))
    first = nodes.groupBy("node").agg(F.min("key").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("node", "b")
    return nodes.join(first, "node").where("key != b").select(F.col("key").alias("a"), "b").distinct()


def _farthest(ties: DataFrame, signed: DataFrame) -> float:
    """Least similarity of a tie, estimated from all signature values (1 without ties)."""
    a, b = signed.select(F.col("key").alias("a"), F.col("sig").alias("s")), signed.select(F.col("key").alias("b"), F.col("sig").alias("t"))
    same = F.aggregate(F.zip_with("s", "t", lambda x, y: (x == y).cast("int")), F.lit(0), lambda x, y: x + y)
    least = ties.join(a, "a").join(b, "b").agg(F.min(same)).first()[0]
    return 1.0 if least is None else least / (TREES * DEPTH)


def candidate_groups(signed: DataFrame, threshold: float, target: float) -> tuple[DataFrame, int]:
    """(node, component) of texts with candidates, and the depth used.

    Links right at the threshold reach the target at the safe depth, so its ties show
    how far apart candidates are. A deeper prefix is used only if even the
    farthest of them is found there with the target's chance, so the number of
    close texts has no say in it.
    """
    deepest = lambda s: max((d for d in range(1, DEPTH + 1) if collision(s, d) >= target), default=1)
    safe = deepest(threshold)
    ties = stored(_ties(signed, safe))
    if safe == DEPTH:
        return connected_components(ties), safe
    depth = deepest(max(threshold, _farthest(ties, signed)))
    if depth > safe:
        ties = stored(_ties(signed, depth))
    return connected_components(ties), depth


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sets, (left, right)."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left], float)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    uniq, col, count = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[col]
    rows, col = rows[keep], number[col[keep]]
    out = np.zeros((len(left), len(right)))
    width = max(1, (1 << 22) // (len(left) + len(right)))
    order = np.argsort(col, kind="stable")
    rows, col = rows[order], col[order]
    for start in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(col, [start, start + width])
        m = np.zeros((len(left) + len(right), width), np.float32)
        m[rows[i:j], col[i:j] - start] = 1
        out += m[:len(left)] @ m[len(left):].T
    return out


def _spans(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component in a symmetric link matrix."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            reach = np.zeros(len(linked), bool)
            new = np.zeros(len(linked), bool)
            new[i] = True
            while new.any():
                reach |= new
                new = linked[new].any(axis=0) & ~reach
            root[reach] = i
    return root


def compare_blocks(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Link matrix over a, or over a and b with links between the two only (b not None)."""
    other = a if b is None else b
    both = _intersections(a, other)
    union = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in other])[None, :] - both
    hit = both >= threshold * union - 1e-9
    if b is None:
        np.fill_diagonal(hit, False)
        return hit
    out = np.zeros((len(a) + len(b),) * 2, bool)
    out[:len(a), len(a):], out[len(a):, :len(a)] = hit, hit.T
    return out


def _dealt(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """``members`` (comp, key, copies, low, size) with ``tasks``, the comparisons each takes part in.

    Set sizes of a link differ by the factor 1 / threshold at most, so a group is
    cut into size classes of that width, each into blocks, and each two blocks
    of equal or next classes are a task (level, block, other level, other block).
    """
    width = float(np.log(1 / threshold))
    rows = members.withColumn("level", F.floor(F.log("size") / F.lit(width) + F.lit(1e-9)))
    count = rows.groupBy("comp", "level").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    near = lambda d, name: count.select("comp", (F.col("level") + d).alias("level"), F.col("blocks").alias(name))
    placed = (rows.join(near(0, "blocks"), ["comp", "level"])
              .join(near(-1, "above"), ["comp", "level"], "left").join(near(1, "below"), ["comp", "level"], "left")
              .fillna(0, ["above", "below"]).withColumn("own", F.expr("pmod(xxhash64(key), blocks)")))
    # side 0 is the first of the two blocks
    return placed.withColumn("tasks", F.expr("""concat(
        transform(sequence(0L, blocks - 1), x -> struct(level AS l, least(own, x) AS i, level AS m, greatest(own, x) AS j,
                  IF(own <= x, 0, 1) AS side)),
        IF(above > 0, transform(sequence(0L, above - 1), x -> struct(level AS l, own AS i, level + 1 AS m, x AS j, 0 AS side)),
           array()),
        IF(below > 0, transform(sequence(0L, below - 1), x -> struct(level - 1 AS l, x AS i, level AS m, own AS j, 1 AS side)),
           array()))""")).select("comp", "key", "copies", "low", "tasks")


def _verified(members: DataFrame, n: int, threshold: float) -> DataFrame:
    """(key, root, links) of linked texts: ``links`` documents linked in one task, ``root`` a text linked to key's part.

    ``members``: (comp, key, copies, tasks, text). Shingle sets are moved once, to their tasks.
    """
    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in text_batches(batches):
            sets = [np.unique(s) for s in shingler(batch.column("text").to_pylist())]
            ends = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("comp", "key", "copies", "tasks")] + [lists],
                                             ["comp", "key", "copies", "tasks", "shingles"])

    kind = members.schema["tasks"].dataType.simpleString()
    sets = members.select("comp", "key", "copies", "tasks", "text").mapInArrow(
        shingled, f"comp binary, key binary, copies long, tasks {kind}, shingles array<long>")
    dealt = sets.select("comp", "key", "copies", "shingles", F.explode("tasks").alias("t"))
    run = (dealt.select("comp", "t.l", "t.i", "t.m", "t.j", "t.side", "key", "copies", "shingles")
           .repartition("comp", "l", "i", "m", "j").sortWithinPartitions("comp", "l", "i", "m", "j", "side", "key"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, out = None, [], []

        def finish():
            if len(held) < 2:
                return
            sides = [[r for r in held if r[0] == s] for s in (0, 1)]
            within = task[1:3] == task[3:5]
            if within:
                sides = [held, []]
            elif not sides[0] or not sides[1]:
                return
            linked = compare_blocks([r[3] for r in sides[0]], None if within else [r[3] for r in sides[1]], threshold)
            every = [*sides[0], *sides[1]]
            links = linked @ np.array([r[2] for r in every], dtype=np.int64)
            for k, root in enumerate(_spans(linked)):
                if links[k]:
                    out.append((every[k][1], every[root][1], int(links[k])))

        def rows_out():
            cols = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.int64()))],
                                              ["key", "root", "links"])

        for batch in text_batches(batches):
            lists = batch.column("shingles")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            cols = [batch.column(c).to_pylist() for c in ("comp", "l", "i", "m", "j", "side", "key", "copies")]
            for k, (comp, l, i, m, j, side, key, copies) in enumerate(zip(*cols)):
                if (comp, l, i, m, j) != task:
                    finish()
                    task, held = (comp, l, i, m, j), []
                elif held and held[-1][:2] == (side, key):
                    continue  # a repeated row
                held.append((side, key, copies, np.array(values[ends[k]:ends[k + 1]])))
            if len(out) > 10_000:
                yield rows_out()
                out = []
        finish()
        if out:
            yield rows_out()

    return run.mapInArrow(compared, "key binary, root binary, links long")


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5,
                    threshold: float = 0.8, target: float = 0.999, block: int = 256) -> DataFrame:
    """(doc_id, text_key, class_id, n_links, repeats) of each distinct (doc_id, text).

    ``class_id`` is the smallest id reachable over links, ``n_links`` the
    number of other rows whose texts are equal or have at least ``threshold``
    Jaccard similarity of their sets of ``words``-word runs (words are runs
    without white space; a text with fewer words is one run). Equal texts are one
    text with copies. Null and empty texts link with nothing; texts of white
    space alone link with equal texts. ``repeats`` counts rows equal in id and
    text; null ids are larger than others. An empty table gives an empty one.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where(
        "text IS NOT NULL AND text != ''").withColumn("key", F.unhex(F.md5(F.encode("text", "UTF-8"))))
    ids = stored(rows.groupBy("key", "id").agg(F.count(F.lit(1)).alias("repeats")))
    texts = ids.groupBy("key").agg(F.min("id").alias("low"), F.sum("repeats").alias("copies"))
    signed = stored(_signed(rows, words))
    groups, _ = candidate_groups(signed, threshold, target)
    members = groups.select(F.col("node").alias("key"), F.col("component").alias("comp")).join(texts, "key").join(
        signed.select("key", "size"), "key")
    dealt = stored(_dealt(members, threshold, block)).alias("m")
    # by key and id, so the copies of a text neither meet in one task nor are compared
    whole = rows.alias("r").join(dealt, (F.col("r.key") == F.col("m.key")) & F.col("r.id").eqNullSafe(F.col("m.low"))).select(
        "m.comp", "m.key", "m.copies", "m.tasks", "r.text")
    links = stored(_verified(whole, words, threshold))
    classes = connected_components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    known = (texts.join(classes.select(F.col("node").alias("key"), "component"), "key", "left").join(counts, "key", "left")
             .withColumn("component", F.coalesce("component", "key")))
    lows = known.groupBy("component").agg(F.min("low").alias("class_id"))
    found = known.join(lows, "component").select("key", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return ids.join(found, "key").select(F.col("id").alias("doc_id"), F.col("key").alias("text_key"), "class_id", "n_links", "repeats")


def document_classes(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, n_links, kept) of every row; rows without text are classes of their own."""
    found = jaccard_classes(docs, **options).alias("f")
    d = docs.select("doc_id", F.unhex(F.md5(F.encode("text", "UTF-8"))).alias("key")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.key") == F.col("f.text_key"))
    return d.join(found, same, "left").select(
        "d.doc_id", F.when(F.col("f.text_key").isNull(), F.col("d.doc_id")).otherwise(F.col("f.class_id")).alias("class_id"),
        F.coalesce("f.n_links", F.lit(0)).alias("n_links")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class (that of the class id), and every row without text; all columns as they were."""
    found = jaccard_classes(docs, doc_id, text, **options).where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(
        F.struct(F.col("doc_id").alias("i"), F.col("text_key").alias("k")).alias("__key"), F.col("repeats").alias("__repeats"))
    page = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"))
    body = F.col("__doc")[text].cast("string")
    own = F.struct(F.col("__doc")[doc_id].alias("i"), F.unhex(F.md5(F.encode(body, "UTF-8"))).alias("k"))
    bare = page.where(body.isNull() | (body == "")).select("__doc")
    first = page.where(body.isNotNull() & (body != "")).withColumn("__own", own).join(
        found, F.col("__own").eqNullSafe(F.col("__key")))
    once = first.where("__repeats = 1").select("__doc")
    again = first.where("__repeats > 1").dropDuplicates(["__own"]).select("__doc")
    return once.union(again).union(bare).select("__doc.*")
