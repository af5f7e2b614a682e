"""Embedding near-duplicates by NN-descent.

A neighbour graph starts from runs of vectors that random hyperplanes sort next
to each other, and is refined by comparing the neighbours of each vector with
one another. Edges at the threshold are the links. A neighbour list full of links
can hide further ones, so components that hold such lists are first compared with one
another where their balls come near enough, and then all vectors of a component
are, in blocks of bounded size. Recall is audited against brute force for a bounded
sample of vectors; below the target another forest is added and refined, and
when that does not reach it, all vectors of a label are compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import connected_components, stored
from .ngram_join import _spans

RUN = 64  # rows of half a run
BITS = 32  # hyperplanes of a tree


def unit_rows(vectors: list[bytes], dtype: str) -> np.ndarray:
    """Raw vectors as rows of length one, in double precision."""
    x = np.frombuffer(b"".join(vectors), dtype=dtype).reshape(len(vectors), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows_out(out: list[tuple]) -> pa.RecordBatch:
    """(node, near, sim) arrays gathered in ``out`` as a batch."""
    node, near, sim = (np.concatenate(c) if c else np.zeros(0) for c in (zip(*out) if out else ((), (), ())))
    return pa.RecordBatch.from_arrays([pa.array(node.astype(np.int64)), pa.array(near.astype(np.int64)), pa.array(sim.astype(float))],
                                      ["node", "near", "sim"])


def _best(sim: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the up to ``k`` largest entries of each row above the row's ``least``."""
    k = min(k, sim.shape[1])
    top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    row = np.repeat(np.arange(len(sim)), k)
    col = top.ravel()
    good = sim[row, col] > least[row]
    return row[good], col[good]


def _leaves(nodes: DataFrame, dtype: str, trees: range, k: int) -> DataFrame:
    """(node, near, sim): each vector's nearest ones among its neighbours in the trees' orders.

    A tree is the order by the sides of random hyperplanes, the first of them
    the most significant, so neighbours share the longest run of sides. The
    order is range-partitioned; a third of all vectors on one side of all planes
    are told apart by their distance from the last.
    """
    def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (np.int64(1) << np.arange(BITS, dtype=np.int64)[::-1])
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                dims = part.column("dim").to_numpy()
                for d in np.unique(dims):
                    some = part.filter(pa.array(dims == d))
                    x = unit_rows(some.column("vec").to_pylist(), dtype)
                    for t in trees:
                        planes = np.random.default_rng([t, int(d)]).standard_normal((int(d), BITS + 1))
                        side = x @ planes
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(x), t, np.int64)), some.column("label"), some.column("dim"),
                            pa.array((side[:, :BITS] > 0) @ weights), pa.array(side[:, BITS]), some.column("node"), some.column("vec")],
                            ["tree", "label", "dim", "code", "offset", "node", "vec"])

    rows = nodes.select("node", "label", "dim", "vec").mapInArrow(
        planted, "tree long, label long, dim long, code long, offset double, node long, vec binary")
    order = ["tree", "label", "dim", "code", "offset", "node"]

    def halves(batches: Iterator[pa.RecordBatch]):
        """Rows of one tree and label in order, up to RUN at a time: (key, nodes, vectors)."""
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("tree", "label", "dim")])
            edge = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0), True])
            node, vec = batch.column("node").to_numpy(), batch.column("vec").to_pylist()
            for a, b in zip(edge[:-1], edge[1:]):
                for i in range(a, b, RUN):
                    j = min(b, i + RUN)
                    yield tuple(key[:, a]), node[i:j], unit_rows(vec[i:j], dtype)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        last = None
        for key, node, x in halves(batches):
            sim = x @ x.T
            np.fill_diagonal(sim, -2)
            found = [(node, node, sim)]
            if last is not None and last[0] == key:
                across = last[2] @ x.T
                found += [(last[1], node, across), (node, last[1], across.T)]
            for own, other, s in found:
                row, col = _best(s, k, np.full(len(own), -1.5))
                out.append((own[row], other[col], s[row, col]))
                size += len(row)
            last = (key, node, x)
            if size > 50_000:
                yield _rows_out(out)
                out, size = [], 0
        yield _rows_out(out)

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "node long, near long, sim double")


def _lists(found: DataFrame, k: int) -> DataFrame:
    """(node, nears): the ``k`` nearest of each vector, nearest first."""
    once = found.groupBy("node", "near").agg(F.max("sim").alias("sim"))
    return once.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("sim", "near")), asc=False), 1, k).alias("nears"))


def _flat(lists: DataFrame) -> DataFrame:
    return lists.select("node", F.explode("nears").alias("e")).select("node", F.col("e.near").alias("near"), F.col("e.sim").alias("sim"))


def _local_join(lists: DataFrame, nodes: DataFrame, dtype: str, k: int, group: int = 256) -> DataFrame:
    """(node, near, sim): better neighbours found among the neighbours of each vector.

    The vectors around a centre are those in its list and those that list it.
    A centre listed by very many is split by hash into groups of about ``group``.
    """
    flat = _flat(lists)
    around = flat.select(F.col("node").alias("centre"), F.col("near").alias("node")).union(
        flat.select(F.col("near").alias("centre"), "node")).union(lists.select(F.col("node").alias("centre"), "node")).distinct()
    parts = around.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / F.lit(group)).alias("parts"))
    least = lists.select("node", F.when(F.size("nears") >= k, F.col("nears")[k - 1]["sim"]).otherwise(F.lit(-1.5)).alias("least"))
    rows = (around.join(parts, "centre").withColumn("part", F.expr("pmod(xxhash64(node), parts)"))
            .join(nodes.select("node", "vec").join(least, "node"), "node")
            .select("centre", "part", "node", "least", "vec")
            .repartition("centre", "part").sortWithinPartitions("centre", "part", "node"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, held, at = [], 0, [], None

        def finish():
            if len(held) < 3:  # a centre with one neighbour has nothing to compare
                return 0
            node, least = np.array([h[0] for h in held]), np.array([h[1] for h in held])
            x = unit_rows([h[2] for h in held], dtype)
            sim = x @ x.T
            np.fill_diagonal(sim, -2)
            row, col = _best(sim, k, least)
            out.append((node[row], node[col], sim[row, col]))
            return len(row)

        for batch in batches:
            for centre, part, *row in zip(*(batch.column(c).to_pylist() for c in ("centre", "part", "node", "least", "vec"))):
                if (centre, part) != at:
                    size += finish()
                    held, at = [], (centre, part)
                held.append(row)
            if size > 50_000:
                yield _rows_out(out)
                out, size = [], 0
        finish()
        yield _rows_out(out)

    return rows.mapInArrow(joined, "node long, near long, sim double")


def refine(lists: DataFrame, nodes: DataFrame, dtype: str, k: int, rounds: int, settled: float) -> DataFrame:
    """NN-descent rounds until less than ``settled`` of all list entries change."""
    total = None
    for _ in range(rounds):
        better = stored(_local_join(lists, nodes, dtype, k))
        old = _flat(lists)
        total = total or max(1, old.count())
        new = better.join(old, ["node", "near"], "left_anti").select("node", "near").distinct().count()
        if new < settled * total:
            return lists
        lists = stored(_lists(old.union(better), k))
    return lists


def _compared(rows: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """(node, links, root) of the tasks (comp, i, j): ``links`` rows linked in one task, ``root`` a vector linked to node's part.

    Sides 0 and 1 of a task are compared with one another; where i = j all its rows are.
    """
    rows = rows.select("comp", "i", "j", "side", "node", "copies", "vec").repartition("comp", "i", "j").sortWithinPartitions(
        "comp", "i", "j", "side", "node")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, out = [], None, [[], [], []]

        def finish():
            if len(held) < 2:
                return
            node, copies = np.array([h[1] for h in held]), np.array([h[2] for h in held], dtype=np.int64)
            x = unit_rows([h[3] for h in held], dtype)
            side = np.array([h[0] for h in held])
            hit = np.empty((len(x), len(x)), bool)
            for c in range(0, len(x), 512):
                hit[c:c + 512] = x[c:c + 512] @ x.T >= threshold
            hit = np.triu(hit, 1)
            if at[1] != at[2]:
                hit &= side[:, None] != side[None, :]
            hit |= hit.T
            some = np.flatnonzero(hit.any(axis=0))
            if not len(some):
                return
            hit = hit[np.ix_(some, some)]
            for c, v in zip(out, (node[some], hit @ copies[some], node[some[_spans(hit)]])):
                c.append(v)

        def rows_out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], ["node", "links", "root"])

        for batch in batches:
            for comp, i, j, *row in zip(*(batch.column(c).to_pylist() for c in ("comp", "i", "j", "side", "node", "copies", "vec"))):
                if (comp, i, j) != at:
                    finish()
                    held, at = [], (comp, i, j)
                held.append(row)
            if len(out[0]) > 1000:
                yield rows_out()
                out = [[], [], []]
        finish()
        yield rows_out()

    return rows.mapInArrow(compared, "node long, links long, root long")


_TASKS = "transform(sequence(0L, blocks - 1), x -> struct(least(own, x) AS i, greatest(own, x) AS j, IF(own <= x, 0, 1) AS side))"


def _blocks(members: DataFrame, dtype: str, threshold: float, block: int) -> DataFrame:
    """(node, links, root) of (comp, node, copies, vec): links within the component, all compared in blocks."""
    count = members.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    rows = (members.join(count, "comp").withColumn("own", F.expr("pmod(xxhash64(node), blocks)"))
            .select("comp", "node", "copies", "vec", F.explode(F.expr(_TASKS)).alias("t"))
            .select("comp", "t.i", "t.j", "t.side", "node", "copies", "vec"))
    return _compared(rows, dtype, threshold)


def _balls(placed: DataFrame, dtype: str) -> DataFrame:
    """(label, dim, comp, part, centre, radius): a ball of unit vectors around each part, its radius as an angle."""
    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, out = [], None, []

        def finish():
            if held:
                x = unit_rows(held, dtype)
                centre = x.mean(axis=0)
                norm = np.linalg.norm(centre)
                centre = centre / norm if norm > 1e-9 else x[0]
                out.append((*at, centre.tobytes(), float(np.arccos(np.clip(x @ centre, -1, 1)).max())))

        for batch in batches:
            for *key, vec in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "comp", "part", "vec"))):
                if key != at:
                    finish()
                    held, at = [], key
                held.append(vec)
        finish()
        cols = list(zip(*out)) if out else [()] * 6
        kinds = (*[pa.int64()] * 4, pa.binary(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["label", "dim", "comp", "part", "centre", "radius"])

    key = ["label", "dim", "comp", "part"]
    return placed.select(*key, "vec").repartition(*key).sortWithinPartitions(*key).mapInArrow(
        around, "label long, dim long, comp long, part long, centre binary, radius double")


def _near_balls(balls: DataFrame, threshold: float, block: int) -> DataFrame:
    """(comp, part, comp2, part2): balls of different components that can hold linked vectors."""
    count = balls.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    task = ["label", "dim", "i", "j"]
    rows = (balls.join(count, ["label", "dim"]).withColumn("own", F.expr("pmod(xxhash64(comp, part), blocks)"))
            .select("*", F.explode(F.expr(_TASKS)).alias("t")).select("label", "dim", "t.i", "t.j", "t.side", "comp", "part", "centre", "radius")
            .repartition(*task).sortWithinPartitions(*task, "side", "comp", "part"))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def finish():
            if len(held) < 2:
                return
            side, comp, part, radius = (np.array([h[c] for h in held]) for c in (0, 1, 2, 4))
            x = np.frombuffer(b"".join(h[3] for h in held)).reshape(len(held), -1)
            # a little wider, so that rounding can only add candidates
            near = np.arccos(np.clip(x @ x.T, -1, 1)) <= radius[:, None] + radius[None, :] + np.arccos(threshold) + 1e-6
            near &= comp[:, None] != comp[None, :]
            if at[2] != at[3]:
                near &= side[:, None] != side[None, :]
            a, b = np.nonzero(np.triu(near, 1))
            for i in range(0, len(a), 50_000):
                cols = (comp[a[i:i + 50_000]], part[a[i:i + 50_000]], comp[b[i:i + 50_000]], part[b[i:i + 50_000]])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["comp", "part", "comp2", "part2"])

        for batch in batches:
            for *key, side, comp, part, centre, radius in zip(*(batch.column(c).to_pylist() for c in (
                    *task, "side", "comp", "part", "centre", "radius"))):
                if key != at:
                    yield from finish()
                    held, at = [], key
                held.append((side, comp, part, centre, radius))
        yield from finish()

    return rows.mapInArrow(met, "comp long, part long, comp2 long, part2 long")


def bridges(full: DataFrame, nodes: DataFrame, dtype: str, threshold: float, block: int) -> DataFrame:
    """(a, b): links that join the components of vectors (node, comp) whose lists are full of links.

    A vector whose list is not full lists all of its links, so only links
    between two full lists can be missing between components. Their vectors are cut
    into parts, and parts whose balls come nearer than the threshold are compared.
    """
    own = full.join(nodes.select("node", "label", "dim"), "node")
    # a label with one such component has nothing to join
    several = own.groupBy("label", "dim").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("label", "dim")
    count = full.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("parts"))
    placed = stored(own.join(several, ["label", "dim"]).join(count, "comp").withColumn("part", F.expr("pmod(xxhash64(node), parts)"))
                    .select("label", "dim", "comp", "part", "node"))
    balls = stored(_balls(placed.join(nodes.select("node", "vec"), "node"), dtype))
    pairs = stored(_near_balls(balls, threshold, block)).withColumn("task", F.monotonically_increasing_id())
    sides = pairs.select("task", F.lit(0).alias("side"), "comp", "part").union(
        pairs.select("task", F.lit(1), F.col("comp2"), F.col("part2")))
    rows = (sides.join(placed, ["comp", "part"]).join(nodes.select("node", "copies", "vec"), "node")
            .select(F.col("task").alias("comp"), F.lit(0).alias("i"), F.lit(1).alias("j"), "side", "node", "copies", "vec"))
    return _compared(rows, dtype, threshold).select(F.col("node").alias("a"), F.col("root").alias("b")).where("a != b").distinct()


def audit(nodes: DataFrame, degrees: DataFrame, dtype: str, threshold: float, sample: int) -> float:
    """Mean share of a vector's links that ``degrees`` counts, over ``sample`` vectors and against brute force over all.

    Every vector with links has one vote, however many links it has. Vectors with one, with
    up to nine and with more links are judged apart, and the least mean is returned.
    The sample is the vectors with the smallest hash; its size bounds what is
    sent to the tasks and gathered.
    """
    asked = nodes.orderBy(F.xxhash64("node", F.lit(11)), "node").limit(sample).select("node", "label", "dim", "vec").collect()
    if not asked:
        return 1.0
    groups: dict[tuple, list] = {}
    for r in asked:
        groups.setdefault((r["label"], r["dim"]), []).append(r)
    packed = {key: (np.array([r["node"] for r in rows]), unit_rows([bytes(r["vec"]) for r in rows], dtype)) for key, rows in groups.items()}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            label, dim, node = (batch.column(c).to_numpy() for c in ("label", "dim", "node"))
            copies, vec = batch.column("copies").to_numpy(), batch.column("vec").to_pylist()
            for key, (ids, x) in packed.items():
                some = np.flatnonzero((label == key[0]) & (dim == key[1]))
                if len(some):
                    hit = (x @ unit_rows([vec[i] for i in some], dtype).T >= threshold) & (ids[:, None] != node[some][None, :])
                    for i, n in zip(ids.tolist(), (hit @ copies[some]).tolist()):
                        total[i] = total.get(i, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["node", "links"])

    true = nodes.select("node", "label", "dim", "copies", "vec").mapInArrow(counted, "node long, links long").groupBy("node").agg(
        F.sum("links").alias("true"))
    strata = F.when(F.col("true") == 1, 0).when(F.col("true") < 10, 1).otherwise(2)
    shares = true.where(F.col("true") > 0).join(degrees, "node", "left").groupBy(strata.alias("stratum")).agg(
        F.avg(F.least("true", F.coalesce("links", F.lit(0))) / F.col("true")).alias("share")).collect()  # three rows at most
    return min((r["share"] for r in shares), default=1.0)


def trees_for(threshold: float, rows: int, target: float) -> int:
    """Trees after which two vectors at ``threshold`` among ``rows`` have shared a run with chance ``target``.

    A hyperplane parts them with chance angle / pi, and they meet when they share the planes that cut the rows down to a run.
    """
    met = (1 - np.arccos(min(1.0, max(-1.0, threshold))) / np.pi) ** max(0.0, np.log2(max(1, rows) / RUN))
    return 1 if met >= target else int(np.ceil(np.log(1 - target) / np.log1p(-met)))


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = 0.98, k: int = 10, trees: int = 6, rounds: int = 3, settled: float = 0.001,
                    target: float = 0.995, attempts: int = 3, sample: int = 1024, block: int = 512) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) of every row of ``vectors``.

    Rows are linked when their labels are equal and not null and the cosine of their
    vectors is at least ``threshold`` in double precision. Null labels, null or
    empty vectors, null or non-finite components and zero vectors link with
    nothing; vectors of different lengths aren't compared. ``n_links`` counts
    other rows linked directly, equal rows and copies of a vector among them;
    ``component_id`` is the smallest id reachable, ``kept`` whether it is the row's
    own. Null ids count as rows but never are a component's id, unless it has no
    other. ``recall`` is the audited mean share of a vector's links found. Forests
    are added until it reaches ``target``; after ``attempts`` of them without that, all
    vectors of a label are compared, and it is 1. An empty table gives an empty one.

    Equal vectors of a label are one node with a number of copies, so a vector
    that a third of all rows share is compared once.
    """
    kind = vectors.schema[embedding].dataType
    dtype = "<f4" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "<f8"
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"),
                          F.col(f"`{embedding}`").cast("array<float>" if dtype == "<f4" else "array<double>").alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, dim = [], []
            for label_, v in zip(batch.column("label").to_pylist(), batch.column("v").to_pylist()):
                ok = label_ is not None and v and None not in v
                a = np.array(v if ok else [], dtype=dtype) + 0  # minus zero is zero
                ok = ok and np.isfinite(a).all() and np.isfinite(s := float(np.square(a.astype(float)).sum())) and s > 0
                vec.append(a.tobytes() if ok else None)
                dim.append(len(a))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(dim, pa.int64()),
                                              pa.array(vec, pa.binary())], ["vec_id", "label", "dim", "vec"])

    rows = stored(rows.mapInArrow(packed, "vec_id long, label long, dim long, vec binary"))
    valid = rows.where("vec IS NOT NULL").groupBy("label", "dim", "vec").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    # numbered by place in the stored table, which stays as it is
    nodes = stored(valid).withColumn("node", F.monotonically_increasing_id())

    largest = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0]
    trees = max(trees, trees_for(threshold, largest or 0, target))
    lists, used, recall = None, 0, 0.0
    for _ in range(attempts):
        found = _leaves(nodes, dtype, range(used, used + trees), k)
        used += trees
        lists = stored(_lists(found if lists is None else found.union(_flat(lists)), k))
        lists = refine(lists, nodes, dtype, k, rounds, settled)
        edges = stored(_flat(lists).where(F.col("sim") >= threshold).select(
            F.least("node", "near").alias("a"), F.greatest("node", "near").alias("b")).distinct())
        components = stored(connected_components(edges))
        full = lists.where((F.size("nears") >= k) & (F.col("nears")[k - 1]["sim"] >= threshold)).select("node")
        more = stored(bridges(components.join(full, "node").select("node", F.col("component").alias("comp")), nodes, dtype, threshold, block))
        if not more.isEmpty():
            components = stored(connected_components(edges.union(more)))
        crowded = components.join(full, "node").select("component").distinct()
        inside = components.join(crowded, "component").select("node", F.col("component").alias("comp"))
        many = stored(_blocks(inside.join(nodes, "node").select("comp", "node", "copies", "vec"), dtype, threshold, block)
                      .groupBy("node").agg(F.sum("links").alias("links")))
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        few = (both.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node"))
               .agg(F.sum("copies").alias("links")).join(inside.select("node"), "node", "left_anti"))
        own = nodes.select("node", "copies").join(few.union(many), "node", "left").select(
            "node", F.coalesce("links", F.lit(0)).alias("links"))
        degrees = stored(own)
        recall = audit(nodes, degrees, dtype, threshold, sample)
        if recall >= target:
            break
    else:
        groups = nodes.groupBy("label", "dim").agg(F.min("node").alias("comp"))
        links = stored(_blocks(nodes.join(groups, ["label", "dim"]).select("comp", "node", "copies", "vec"), dtype, threshold, 4 * block))
        degrees = nodes.select("node").join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").select(
            "node", F.coalesce("links", F.lit(0)).alias("links"))
        components = stored(connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        recall = 1.0
    known = (nodes.join(degrees, "node").join(components.select("node", "component"), "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    lows = known.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = known.join(lows, "component").select("label", "dim", "vec", "component_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    linked = rows.join(classes, ["label", "dim", "vec"], "left")
    return linked.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumn("recall", F.lit(float(recall)))
