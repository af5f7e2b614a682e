"""Byte-level BPE encoding and decoding on padded numpy matrices.

A text is cut by the split pattern; every distinct piece of a batch becomes a
row of byte tokens in a matrix of its length bucket. In each round every row
merges its leftmost pair of minimum rank, found by a hashed pair table, and
shifts the rest left; rows without a pair left leave the matrix.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

_NONE = np.int32(2**31 - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressing hash table of token pairs -> id of the joined token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray):
        size_bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 4))))
        self.shift, self.mask = np.uint64(64 - size_bits), (1 << size_bits) - 1
        self.keys = np.full(1 << size_bits, -1, dtype=np.int64)
        self.vals = np.full(1 << size_bits, _NONE, dtype=np.int32)
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot, left_over = self._slot(key), np.arange(len(key))
        while len(left_over):
            free = self.keys[slot[left_over]] == -1
            tried = left_over[free]
            self.keys[slot[tried]] = key[tried]  # one of those with the same slot stays
            won = tried[self.keys[slot[tried]] == key[tried]]
            self.vals[slot[won]] = joined[won]
            left_over = np.setdiff1d(left_over, won, assume_unique=True)
            slot[left_over] = (slot[left_over] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MULT) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where the pair doesn't join or one side is padding (-1)."""
        out = np.full(left.shape, _NONE, dtype=np.int32)
        live = np.flatnonzero(right.ravel() >= 0)
        key = (left.ravel()[live].astype(np.int64) << 32) | right.ravel()[live]
        slot, flat = self._slot(key), out.ravel()
        while len(live):
            at = self.keys[slot]
            hit = at == key
            flat[live[hit]] = self.vals[slot[hit]]
            more = ~hit & (at != -1)
            live, key, slot = live[more], key[more], (slot[more] + 1) & self.mask
        return flat.reshape(left.shape)


class ByteBPE:
    """Encoder and decoder for a rank file (token bytes in base64 and rank per line)."""

    #: Longer pieces are merged one by one with a heap: a matrix would need a round per merge of the whole row.
    LONG = 256
    #: Pieces kept with their ids in one Python worker; later ones are encoded batch by batch.
    CACHE = 150_000

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.split = regex.compile(pattern).findall
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lens = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lens)[:-1]])
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [(a, b, rank) for token, rank in self.ranks.items() for i in range(1, len(token))
                 if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None]
        self.pairs = PairTable(*(np.array(c, dtype=np.int32) for c in zip(*pairs)))
        self.index: dict[str, int] = {}
        self.flat, self.begin, self.count = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))

    # ------------------------------------------------------------- encoding

    def _merge(self, rows: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of byte tokens (-1: padding)."""
        done: list[np.ndarray] = [None] * len(rows)
        where = np.arange(len(rows))
        columns = np.arange(rows.shape[1])
        while len(rows):
            if rows.shape[1] == 1:
                best = np.full(len(rows), _NONE)
            else:
                rank = self.pairs.ranks(rows[:, :-1], rows[:, 1:])
                at = rank.argmin(axis=1)  # the leftmost of the least
                best = rank[np.arange(len(rows)), at]
            ended = best == _NONE
            for i in np.flatnonzero(ended):
                done[where[i]] = rows[i][rows[i] >= 0]
            rows, where = rows[~ended], where[~ended]
            if not len(rows):
                break
            at, best = at[~ended], best[~ended]
            rows[np.arange(len(rows)), at] = best
            stay = columns[None, :rows.shape[1]] != (at + 1)[:, None]
            rows = rows[stay].reshape(len(rows), -1)
        return done

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges in the same order for one long piece, by a heap over a linked list."""
        ids = self.byte_id[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        parts = [piece[i:i + 1] for i in range(n)]
        heap = [(r, i, 1, 1) for i in range(n - 1) if (r := self.ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or len(parts[i]) != a or len(parts[j]) != b:
                continue  # one side was merged since
            parts[i], parts[j] = parts[i] + parts[j], None
            ids[i] = rank
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.ranks.get(parts[x] + parts[y])) is not None:
                    heapq.heappush(heap, (r, x, len(parts[x]), len(parts[y])))
        return np.array([k for k, p in zip(ids, parts) if p is not None], dtype=np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece: whole pieces of the vocabulary as they are, others by merging."""
        out: list[np.ndarray] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = np.array([whole], dtype=np.int32)
            elif len(piece) > self.LONG:
                out[k] = self._merge_long(piece)
            else:
                buckets.setdefault((len(piece) + 3) // 4 if len(piece) <= 32 else 8 + (len(piece) - 1) // 32, []).append(k)
        for members in buckets.values():
            width = max(len(pieces[k]) for k in members)
            for i in range(0, len(members), 1 << 14):
                some = members[i:i + (1 << 14)]
                raw = np.frombuffer(b"".join(pieces[k].ljust(width, b"\0") for k in some), np.uint8).reshape(-1, width)
                size = np.array([len(pieces[k]) for k in some])
                rows = np.where(np.arange(width)[None, :] < size[:, None], self.byte_id[raw], np.int32(-1))
                for k, ids in zip(some, self._merge(rows)):
                    out[k] = ids
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts in a row and how many each text has."""
        words = [self.split(t) if t else [] for t in texts]
        fresh = list(set().union(*words) - self.index.keys())
        if fresh:
            ids = self.encode_pieces([w.encode("utf-8") for w in fresh])
            self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
            count = np.array([len(x) for x in ids], dtype=np.int64)
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, *ids])
        number = np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), dtype=np.int64)
        count = self.count[number]
        ends = np.cumsum(count)
        flat = self.flat[np.repeat(self.begin[number] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.concatenate([[0], ends])[np.cumsum([0, *map(len, words)])]
        if len(self.index) > self.CACHE:  # new pieces are the last
            for w in fresh[max(0, self.CACHE - len(self.index) + len(fresh)):]:
                del self.index[w]
            kept = len(self.index)
            self.begin, self.count = self.begin[:kept].copy(), self.count[:kept].copy()
            self.flat = self.flat[:int(self.begin[-1] + self.count[-1]) if kept else 0].copy()
        return flat, np.diff(edges)

    # ------------------------------------------------------------- decoding

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, ends): the bytes of all ids in a row and where each id's bytes end."""
        size = self.lens[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.blob[np.repeat(self.starts[ids] - (ends - size), size) + np.arange(total)], ends


@functools.lru_cache(maxsize=2)
def codec(rank_file: str, pattern: str) -> ByteBPE:
    """One codec per Python worker and vocabulary."""
    return ByteBPE(rank_file, pattern)


def encode(df: DataFrame, doc_id: str, text: str, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row, without special tokens.

    A null or empty text has no ids. Rows are independent: repeated rows and
    ids give repeated rows, an empty table gives an empty one, other columns are
    not read. ``rank_file`` must lie at the same path on every executor.
    """
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(rank_file, pattern)
        for batch in text_batches(batches, 1 << 20):
            flat, count = bpe.encode(batch.column("text").to_pylist())
            ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(df: DataFrame, doc_id: str, ids: str, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded binary) of every row; null ids decode to no bytes."""
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{ids}`").alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(rank_file, pattern)
        for batch in text_batches(batches, 1 << 19):  # an index of 64 bits for each byte decoded
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            count = np.diff(lists.offsets.to_numpy()) if not lists.null_count else np.array(
                [len(x) if x is not None else 0 for x in lists.to_pylist()])
            raw, ends = bpe.decode(flat)
            edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]
            out = pa.Array.from_buffers(pa.large_binary(), len(lists), [
                None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, out.cast(pa.binary())],
                                             ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def token_digests(docs: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, its ids decoded, both digested."""
    done = decode(encode(docs, doc_id, text, rank_file, pattern), "doc_id", "ids", rank_file, pattern)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
