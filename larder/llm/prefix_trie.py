"""Conversation prefix trie from double arrays.

Conversations are sorted by their turns, so every shard of the sorted rows holds
neighbouring prefixes. A shard's turns get dense ids and its trie is packed into BASE
and CHECK arrays: the child of state s by id t is ``BASE[s] + t`` if ``CHECK`` of that
slot is s. Walking the rows through the arrays gives the nodes and their sums.

Only nodes on the path of a shard's first or last row can go on in another shard.
These few, the shared upper nodes, are merged globally by depth and a 128-bit key of
their turns; all others are final where they were found. Conversations longer than a
block of turns are cut into blocks, each in the trie of those that start with the same
turns, so neither a shard nor a row grows with the longest conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, stored

_IDX_BITS = 33
_WORD = r"[^\\x20\\x09-\\x0D]+"
_NONE = np.iinfo(np.int64).min // 2


class DoubleArray:
    """BASE and CHECK over integer labels above 0; state 0 is the root."""

    def __init__(self, size: int):
        self.base = np.full(size, _NONE, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.check[0] = 0
        self.low = 1                                     # no free slot below

    def reserve(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.full(more, _NONE, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def step(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The child states by ``labels``, -1 where there is none."""
        slots = self.base[states] + labels
        inside = (slots > 0) & (slots < len(self.check))
        return np.where(inside & (self.check[np.where(inside, slots, 0)] == states), slots, -1)

    def place(self, parents: np.ndarray, labels: np.ndarray) -> None:
        """Add edges; a parent's are given together, in order of their labels, and once."""
        starts = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]]) if len(parents) else np.array([], np.int64)
        sizes = np.diff(np.r_[starts, len(parents)])
        for i in np.flatnonzero(sizes > 1):
            self._fit(int(parents[starts[i]]), labels[starts[i]:starts[i] + sizes[i]])
        only = starts[sizes == 1]
        if len(only):
            self.reserve(self.low + len(only) + 1)
            while len(free := self.low + np.flatnonzero(self.check[self.low:] < 0)) < len(only):
                self.reserve(len(self.check) + len(only))
            slots = free[:len(only)]
            self.base[parents[only]] = slots - labels[only]
            self.check[slots] = parents[only]
            self.low = int(slots[-1]) + 1

    def _fit(self, parent: int, labels: np.ndarray) -> None:
        """The first place from ``low`` on at which all labels find free slots."""
        away, at, many = labels - labels[0], self.low, 1
        while True:
            self.reserve(at + many + int(away[-1]) + 1)
            fits = (self.check[(at + np.arange(many))[:, None] + away] < 0).all(axis=1)
            if fits.any():
                at += int(fits.argmax())
                break
            at, many = at + many, min(2 * many, max(1, 65_536 // len(away)))
        self.base[parent] = at - labels[0]
        self.check[at + away] = parent
        if at == self.low:
            self.low = at + 1


def dense_ids(*columns: np.ndarray) -> np.ndarray:
    """Ids from 1 for the distinct rows of ``columns``."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    ids = np.empty(len(order), np.int64)
    ids[order] = np.cumsum(new) + 1
    return ids


def _matrix(flat: np.ndarray, lens: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``flat`` with a column before them, padded with zeros."""
    out = np.zeros((len(lens), width), flat.dtype)
    out[:, 0] = first
    out[:, 1:][np.arange(width - 1) < lens[:, None]] = flat
    return out


_NODE = [("shard", pa.int64()), ("open", pa.bool_()), ("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
         ("pk1", pa.int64()), ("pk2", pa.int64()), ("conv", pa.int64()), ("parent_conv", pa.int64()), ("n", pa.int64()),
         ("children", pa.int64()), ("words", pa.int64()), ("said", pa.int64()), ("dw", pa.int64()), ("leaves", pa.int64()),
         ("digest", pa.string()), ("ends", pa.string()), ("first_end", pa.int64()),
         ("upper", pa.list_(pa.struct([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())])))]
_NODE_SCHEMA = ("shard long, open boolean, depth long, k1 long, k2 long, pk1 long, pk2 long, conv long, parent_conv long, n long, "
                "children long, words long, said long, dw long, leaves long, digest string, ends string, first_end long, "
                "upper array<struct<depth:long, k1:long, k2:long>>")


def shard_nodes(batch: pa.RecordBatch, shard: int, block_turns: int) -> pa.RecordBatch:
    """The nodes of one shard (rows sorted by j, p1, p2, turns, conv) from its double-array trie.

    ``said`` sums the words of all members from the node on, ``dw`` those of distinct
    nodes. For open nodes ``dw``, ``leaves`` and ``children`` hold what closed children and later
    blocks bring; the node's own part is added when it is merged.
    """
    col = {n: batch.column(n) for n in batch.schema.names}
    num = lambda c: col[c].to_numpy(zero_copy_only=False)
    lists = col["turns"]
    lens = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    flat = lists.flatten()
    t1, t2, w, x1, x2 = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("t1", "t2", "w", "k1", "k2"))
    conv, j, p1, p2 = (num(c).astype(np.int64) for c in ("conv", "j", "p1", "p2"))
    more = num("more").astype(bool)
    width, rows = int(lens.max()) + 2, len(lens)

    turn_ids, groups = dense_ids(t1, t2), dense_ids(j, p1, p2)
    ids = _matrix(turn_ids, lens, groups + (turn_ids.max() if len(turn_ids) else 0), width)[:, :width - 1]
    there = ids > 0
    same = (ids[1:] == ids[:-1]) & there[1:]
    shared = np.r_[0, np.where(same.all(axis=1), width - 1, same.argmin(axis=1))]
    fresh = there & (np.arange(width - 1) >= shared[:, None])        # a row's cells that are the first of their node

    trie = DoubleArray(2 * (int(fresh.sum()) + 2))
    state = np.zeros(rows, np.int64)
    for d in range(width - 1):                                       # pack, one depth after the other
        at = np.flatnonzero(fresh[:, d])
        order = at[np.lexsort((ids[at, d], state[at]))]
        trie.place(state[order], ids[order, d])
        state = np.where(there[:, d], trie.step(state, ids[:, d]), state)

    size = len(trie.check)
    states = np.zeros((rows, width - 1), np.int64)
    walk = np.zeros(rows, np.int64)
    for d in range(width - 1):                                       # walk every row through the arrays
        walk = np.where(there[:, d], trie.step(walk, ids[:, d]), walk)
        states[:, d] = np.where(there[:, d], walk, 0)
    if (walk < 0).any():
        raise AssertionError("a row left the trie")
    last, at = walk, states[there]

    def per_state(values: np.ndarray, how) -> np.ndarray:
        out = np.zeros(size, np.int64) if how is np.add else np.full(size, np.iinfo(np.int64).max)
        how.at(out, at, np.broadcast_to(values, states.shape)[there])
        return out

    words = _matrix(w, lens, np.zeros(rows, np.int64), width)[:, :width - 1]
    from_here = words[:, ::-1].cumsum(axis=1)[:, ::-1] + num("after_words").astype(np.int64)[:, None]
    n, said, low = per_state(1, np.add), per_state(from_here, np.add), per_state(conv[:, None], np.minimum)
    key1 = np.bitwise_xor.accumulate(_matrix(x1, lens, p1, width)[:, :width - 1], axis=1)
    key2 = np.bitwise_xor.accumulate(_matrix(x2, lens, p2, width)[:, :width - 1], axis=1)
    k1, k2, node_words, depth, block = (np.zeros(size, np.int64) for _ in range(5))
    for target, values in ((k1, key1), (k2, key2), (node_words, words), (depth, np.arange(width - 1)), (block, j[:, None])):
        target[at] = np.broadcast_to(values, states.shape)[there]

    opened = np.zeros(size, bool)
    opened[states[0][there[0]]] = opened[states[-1][there[-1]]] = True
    opened[states[:, 0]] = opened[last[more]] = True
    for path in states[more]:
        opened[path[path > 0]] = True
    nodes = np.flatnonzero(trie.check[1:] >= 0) + 1
    parent = trie.check
    dw, leaves, children = (np.zeros(size, np.int64) for _ in range(3))
    np.add.at(dw, last[more], num("after_dw").astype(np.int64)[more])
    np.add.at(leaves, last[more], num("after_leaves").astype(np.int64)[more])
    for d in range(width - 2, -1, -1):                               # from the deepest nodes up
        closed = nodes[(depth[nodes] == d) & ~opened[nodes]]
        dw[closed] += node_words[closed]
        leaves[closed] += children[closed] == 0
        np.add.at(dw, parent[closed], dw[closed])
        np.add.at(leaves, parent[closed], leaves[closed])
        np.add.at(children, parent[closed], 1)

    ends: dict[int, list[int]] = {}
    for s, c in zip(last[~more].tolist(), conv[~more].tolist()):
        ends.setdefault(s, []).append(c)
    joined = {s: ",".join(map(str, c)) for s, c in ends.items()}

    later_root = (depth[nodes] == 0) & (block[nodes] > 0)            # the block before has this node's own sums
    inner, up_closed = depth[nodes] > 0, ~opened[parent[nodes]]
    upper = []
    for s, o, r in zip(nodes.tolist(), opened[nodes].tolist(), later_root.tolist()):
        if not o or r:
            upper.append(None)
            continue
        path, v = [], s
        while depth[v] > 0 or (v and block[v] == 0):
            path.append({"depth": int(depth[v] + block_turns * block[v]), "k1": int(k1[v]), "k2": int(k2[v])})
            v = int(parent[v]) if depth[v] > 0 else 0
        upper.append(path)
    is_open = opened[nodes].tolist()
    empty = hashlib.sha256(b"").hexdigest()
    digest = [None if o else (hashlib.sha256(joined[s].encode()).hexdigest() if s in joined else empty)
              for s, o in zip(nodes.tolist(), is_open)]
    held = [joined.get(s) if o else None for s, o in zip(nodes.tolist(), is_open)]
    first_end = [ends[s][0] if o and s in ends else None for s, o in zip(nodes.tolist(), is_open)]
    own = ~later_root
    masked = lambda values, keep: pa.array(values, pa.int64(), mask=~keep)
    zero = lambda values: pa.array(np.where(own, values[nodes], 0))
    arrays = [pa.array(np.full(len(nodes), shard)), pa.array(opened[nodes]), pa.array(depth[nodes] + block_turns * block[nodes]),
              pa.array(k1[nodes]), pa.array(k2[nodes]), masked(k1[parent[nodes]], inner), masked(k2[parent[nodes]], inner),
              masked(low[nodes], own), masked(low[parent[nodes]], inner & up_closed), zero(n), pa.array(children[nodes]),
              zero(node_words), zero(said), zero(dw), zero(leaves), pa.array(digest, pa.string()), pa.array(held, pa.string()),
              pa.array(first_end, pa.int64()), pa.array(upper, _NODE[-1][1])]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in _NODE])


def _shards(block_turns: int, shard_turns: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that cuts the sorted rows of its partition into shards of ``shard_turns`` turns and rows, and yields the nodes of each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << _IDX_BITS, [], 0

        def nodes() -> pa.RecordBatch:
            return shard_nodes(pa.Table.from_batches(held).combine_chunks().to_batches()[0], number, block_turns)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            slots = np.cumsum(np.diff(batch.column("turns").offsets.to_numpy()) + 1)
            start = 0
            while start < batch.num_rows:
                before = int(slots[start - 1]) if start else 0
                end = max(start + 1, int(np.searchsorted(slots, before + shard_turns - size, "right")))
                held.append(batch.slice(start, end - start))
                size += int(slots[end - 1]) - before
                start = end
                if size >= shard_turns or start < batch.num_rows:
                    yield nodes()
                    number, held, size = number + 1, [], 0
        if held:
            yield nodes()
        give_back()

    return work


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join each node's chunks of ids, which come in ascending order, into its digest; one chunk in memory at a time."""
    key, running = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()) for k in key] + [pa.array([running.hexdigest()])],
                                          names=["depth", "k1", "k2", "ends_sha256"])

    for batch in batches:
        for i in range(batch.num_rows):
            now = tuple(batch.column(c)[i].as_py() for c in ("depth", "k1", "k2"))
            text = batch.column("ends")[i].as_py().encode()
            if now == key:
                running.update(b",")
            else:
                if key is not None:
                    yield row()
                key, running = now, hashlib.sha256()
            running.update(text)
    if key is not None:
        yield row()


_KEY = ["depth", "k1", "k2"]


def _trie(rows: DataFrame, block_turns: int, shard_turns: int) -> DataFrame:
    """All nodes of block rows: depth, k1, k2, pk1, pk2, conv, parent_conv, n, children, said, dw, leaves, ends_sha256."""
    order = ["j", "p1", "p2", "turns", "conv"]
    found = stored(rows.select(*order, "more", "after_words", "after_leaves", "after_dw").repartitionByRange(*order)
                   .sortWithinPartitions(*order).mapInArrow(_shards(block_turns, shard_turns), _NODE_SCHEMA))
    result = ["depth", "k1", "k2", "pk1", "pk2", "conv", "parent_conv", "n", "children", "said", "dw", "leaves", "ends_sha256"]
    closed = found.where("NOT open").withColumnRenamed("digest", "ends_sha256")
    opened = found.where("open")

    merged = stored(opened.groupBy(*_KEY).agg(
        F.max("pk1").alias("pk1"), F.max("pk2").alias("pk2"), F.min("conv").alias("conv"), F.sum("n").alias("n"),
        F.sum("children").alias("children"), F.max("words").alias("words"), F.sum("said").alias("said"), F.sum("dw").alias("dw"),
        F.sum("leaves").alias("leaves"), F.first("upper", ignorenulls=True).alias("upper")))
    up = merged.where("pk1 IS NOT NULL").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("pk1").alias("k1"), F.col("pk2").alias("k2")).agg(F.count(F.lit(1)).alias("opened"))
    nodes = merged.join(up, _KEY, "left").withColumn("children", F.col("children") + F.coalesce("opened", F.lit(0)))
    # what each shared node adds to itself and to the shared nodes above it
    parts = nodes.select(F.explode("upper").alias("at"), (F.col("words") + F.col("dw")).alias("dw"),
                         (F.col("leaves") + F.when(F.col("children") == 0, 1).otherwise(0)).alias("leaves"))
    sums = parts.groupBy("at.depth", "at.k1", "at.k2").agg(F.sum("dw").alias("dw"), F.sum("leaves").alias("leaves"))
    chunks = opened.where("ends IS NOT NULL").select(*_KEY, "first_end", "ends").repartition(*_KEY).sortWithinPartitions(*_KEY, "first_end")
    digests = chunks.select(*_KEY, "ends").mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")
    above = merged.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"), F.col("conv").alias("parent_conv"))
    shared = (nodes.drop("dw", "leaves").join(sums, _KEY, "left").join(digests, _KEY, "left").join(above, ["depth", "pk1", "pk2"], "left")
              .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))))

    # closed nodes under a shared one take its smallest member, joined shard by shard
    tops = opened.select("shard", *_KEY).distinct().join(merged.select(*_KEY, F.col("conv").alias("parent_conv")), _KEY).select(
        "shard", (F.col("depth") + 1).alias("depth"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"), "parent_conv")
    under = closed.where("parent_conv IS NULL").drop("parent_conv").join(tops, ["shard", "depth", "pk1", "pk2"], "left")
    return closed.where("parent_conv IS NOT NULL").select(*result).union(under.select(*result)).union(shared.select(*result))


def prefix_trie(turns: DataFrame, turnless: DataFrame, block_turns: int = 64, shard_turns: int = 32_768) -> DataFrame:
    """Nodes of the prefix trie of conversations.

    ``turns`` has one row per turn: conv (long), total (turns of the conversation), i (from 0),
    t1 and t2 (128 bits that tell the turn's content) and w (its words). ``turnless``
    lists conversations without a turn (conv). Returns conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    A double array is packed from ``shard_turns`` turns, a row holds ``block_turns``; neither changes the result.
    """
    block = f"CAST(i DIV {block_turns} AS LONG)"
    gathered = turns.groupBy("conv", "total", F.expr(block).alias("j")).agg(F.sort_array(F.collect_list(F.struct("i", "t1", "t2", "w"))).alias("list"))
    keyed = gathered.select("conv", "total", "j", F.expr(
        "transform(list, x -> named_struct('t1', x.t1, 't2', x.t2, 'w', x.w, 'k1', xxhash64(x.t1, x.t2, x.i), 'k2', xxhash64(x.i, x.t2, x.t1, 1)))").alias("turns"))
    bare = turnless.select("conv", F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("j")).withColumn(
        "turns", F.from_json(F.lit("[]"), keyed.schema["turns"].dataType))
    blocks = stored(keyed.unionByName(bare).selectExpr(
        "*", "aggregate(turns, 0L, (a, x) -> a ^ x.k1) AS x1", "aggregate(turns, 0L, (a, x) -> a ^ x.k2) AS x2",
        "aggregate(turns, 0L, (a, x) -> a + x.w) AS sw"))
    none = ["0L AS after_leaves", "0L AS after_dw"]
    one = blocks.where(f"total <= {block_turns}").selectExpr("j", "0L AS p1", "0L AS p2", "turns", "conv", "false AS more", "0L AS after_words", *none)

    long = blocks.where(f"total > {block_turns}")
    if not long.isEmpty():
        of = Window.partitionBy("conv").orderBy("j")
        before, after = of.rowsBetween(Window.unboundedPreceding, -1), of.rowsBetween(1, Window.unboundedFollowing)
        long = stored(long.select("j", F.coalesce(F.bit_xor("x1").over(before), F.lit(0)).alias("p1"),
                                  F.coalesce(F.bit_xor("x2").over(before), F.lit(0)).alias("p2"), "turns", "conv",
                                  (F.col("total") > (F.col("j") + 1) * block_turns).alias("more"),
                                  F.coalesce(F.sum("sw").over(after), F.lit(0)).alias("after_words")))
        # what the trie of each later block holds is owned by its smallest conversation, which hands it to its earlier blocks
        later = _trie(long.where("j > 0").selectExpr("*", *none), block_turns, shard_turns).where(f"(depth - 1) % {block_turns} = 0")
        owned = later.groupBy((F.expr(f"(depth - 1) DIV {block_turns}")).alias("j"), "pk1", "pk2").agg(
            F.min("conv").alias("conv"), F.sum("leaves").alias("own_leaves"), F.sum("dw").alias("own_dw")).drop("pk1", "pk2")
        total = lambda c: F.coalesce(F.sum(c).over(after), F.lit(0))
        long = long.join(owned, ["conv", "j"], "left").withColumns(
            {"after_leaves": total("own_leaves"), "after_dw": total("own_dw")}).drop("own_leaves", "own_dw")
        one = one.unionByName(long)
    return _trie(one, block_turns, shard_turns).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("said") - F.col("dw")).alias("saved_tokens"), "ends_sha256")


def rebuilt_turns(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, turnless) for ``prefix_trie``: conversations that share first turns with the first of their family.

    Conversation c takes the first h turns of c - c % family (h = crc32 of c's
    decimal, modulo ``heads``; fewer if it has fewer, none if it is absent), then its own
    turns after its first h. Rows are sorted once by conversation and turn across range
    partitions, so a conversation of any length is spread over tasks; positions come
    from the counts of each partition's conversations.
    """
    narrow = chats.select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
                          F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(
        "conv IS NOT NULL").select("conv", "turn", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.md5("text"), "role").alias("t2"),
                                   F.expr(f"CAST(regexp_count(text, '{_WORD}') AS LONG)").alias("w"))
    order = ["conv", "turn", "t1", "t2"]
    kept = stored(narrow.repartitionByRange(*order).sortWithinPartitions(*order))
    rows = kept.withColumn("_mid", F.monotonically_increasing_id()).withColumns(
        {"_pid": F.shiftright("_mid", _IDX_BITS), "_idx": F.expr(f"_mid & {(1 << _IDX_BITS) - 1}")}).drop("_mid")
    over = Window.partitionBy("conv")
    runs = rows.groupBy("_pid", "conv").agg(F.min("_idx").alias("_lo"), F.count(F.lit(1)).alias("_n")).select(
        "_pid", "conv", "_lo", F.coalesce(F.sum("_n").over(over.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_carry"),
        F.sum("_n").over(over).alias("_len"), (F.col("conv") - F.col("conv") % family).alias("base"),
        (F.crc32(F.col("conv").cast("string")) % heads).alias("h"))
    runs = stored(runs)
    lengths = runs.where("_carry = 0").select(F.col("conv").alias("base"), F.col("_len").alias("_base_len"))
    runs = runs.join(lengths, "base", "left").withColumn("head", F.least("h", F.coalesce("_base_len", F.lit(0)))).withColumn(
        "total", F.col("head") + F.greatest(F.col("_len") - F.col("h"), F.lit(0)))
    convs = runs.where("_carry = 0").select("conv", "base", "head", "total")
    placed = rows.join(runs.select("_pid", "conv", "_lo", "_carry", "h", "head", "total"), ["_pid", "conv"]).withColumn(
        "pos", F.col("_idx") - F.col("_lo") + F.col("_carry"))
    own = placed.where("pos >= h").select("conv", "total", (F.col("pos") - F.col("h") + F.col("head")).alias("i"), "t1", "t2", "w")
    first = placed.where(f"conv % {family} = 0 AND pos < {heads - 1}").select(F.col("conv").alias("base"), F.col("pos").alias("i"), "t1", "t2", "w")
    given = first.join(convs, "base").where("i < head").select("conv", "total", "i", "t1", "t2", "w")
    return own.unionByName(given), convs.where("total = 0").select("conv")


def conversation_trie(chats: DataFrame, **columns: str) -> DataFrame:
    """One row per node of the prefix trie of rebuilt conversations (``rebuilt_turns``, ``prefix_trie``).

    A null role or text is empty; turns are ordered with null first, rows of
    the same turn by a hash of their content, repeated rows are turns each. Rows without a
    conv_id belong to no conversation. An empty table gives no rows, not even a root.
    Further columns are ignored.
    """
    return prefix_trie(*rebuilt_turns(chats, **columns))


def conversation_trie_sql() -> str:
    """DuckDB SQL for ``conversation_trie`` over the table ``conversations``."""
    return r"""
    WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT c, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS own FROM t GROUP BY c),
    bits AS (SELECT c, own, list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(9 * length(c::VARCHAR)), lambda k:
                 CASE WHEN k % 9 = 0 THEN 4294967296::UBIGINT + ascii(substr(c::VARCHAR, (k // 9 + 1)::BIGINT, 1))::UBIGINT ELSE 0::UBIGINT END)),
                 lambda a, b: CASE WHEN b >= 4294967296::UBIGINT THEN xor(a, b - 4294967296::UBIGINT)
                                   WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS crc FROM o),
    h AS (SELECT c, own, (4294967295::UBIGINT - crc) % 4 AS h FROM bits),
    b AS (SELECT h.c, list_concat(coalesce(list_slice(f.own, 1, h.h::BIGINT), []), list_slice(h.own, h.h::BIGINT + 1, len(h.own))) AS turns
          FROM h LEFT JOIN o f ON f.c = h.c - h.c % 20),
    p AS (SELECT c, len(turns) AS total, unnest(range(len(turns) + 1)) AS depth, turns FROM b),
    m AS (SELECT c, depth, total = depth AS ends, list_slice(turns, 1, depth) AS path, list_slice(turns, 1, depth - 1) AS up FROM p),
    n AS (SELECT path, depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256,
                 CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(any_value(path)[depth].t, '[^\x20\x09-\x0D]+')) END AS words
          FROM m GROUP BY path, depth),
    k AS (SELECT up AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
    q AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.path = n.path AND k.depth = n.depth),
    s AS (SELECT a.conv_id, a.depth, sum(CASE WHEN d.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
                 sum((d.n_convs - 1) * d.words)::BIGINT AS saved_tokens
          FROM q a JOIN q d ON d.depth >= a.depth AND list_slice(d.path, 1, a.depth) = a.path GROUP BY a.conv_id, a.depth)
    SELECT q.conv_id, q.depth, u.conv_id AS parent_conv_id, q.n_convs, q.n_children, s.n_leaves, s.saved_tokens, q.ends_sha256
    FROM q JOIN s ON s.conv_id = q.conv_id AND s.depth = q.depth LEFT JOIN n u ON u.path = q.up AND u.depth = q.depth - 1 AND q.depth > 0
    """
