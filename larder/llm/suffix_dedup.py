"""Removal of repeated byte strings, decided by a column-wise multi-document suffix order.

A string of ``WINDOW`` bytes is repeated when it starts at more than one place
of all texts. Texts are first cut into pieces around content-chosen anchors:
the anchor of a window is its ``GRAM``-byte substring of least hash (the
leftmost of equals), and a piece covers a run of windows with one anchor. Equal
windows have equal anchors, so only pieces with a common anchor need comparing,
and pieces whose anchor occurs once hold no repeats.

Pieces that share an anchor but differ are ordered by building the Burrows-
Wheeler transform and common prefix lengths of the collection column by
column: every round puts one more symbol of each piece, from the right, in front
of its suffix, finds where the longer suffixes go by counting symbols, and
rewrites the transform's and the prefixes' files in one sequential pass. Windows
next to each other whose common prefix has ``WINDOW`` bytes are repeats.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_batches

WINDOW, GRAM = 200, 80
_SPAN = WINDOW - GRAM + 1  # anchors a window can have, and windows an anchor can have
_CHUNK = 1 << 17
SECTION = 16  # windows compared together
_NONE = 255  # no byte of UTF-8

_rng = np.random.default_rng(7)
_SYMBOL = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_B = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_B, _CHUNK + WINDOW + 1)
_INV = _powers(pow(_B, -1, 1 << 64), _CHUNK + WINDOW + 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def pieces(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, windows, anchor's place in the piece, anchor hash, piece hash) of the pieces of one text's bytes."""
    out = [[], [], [], [], []]
    for at in range(0, max(0, len(raw) - WINDOW + 1), _CHUNK):
        part = raw[at:at + _CHUNK + WINDOW - 1]
        n = len(part)
        # sums of symbols times powers; dividing by the first position's power makes them independent of the place
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_SYMBOL[part] * _POW[:n], out=total[1:])
        gram = _mixed((total[GRAM:] - total[:n - GRAM + 1]) * _INV[:n - GRAM + 1])
        least = (gram & ~np.uint64((1 << 24) - 1)) | np.arange(len(gram), dtype=np.uint64)
        width = 1
        while width * 2 <= _SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < _SPAN:
            least = np.minimum(least[:len(least) - (_SPAN - width)], least[_SPAN - width:])
        anchor = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        count = np.diff(np.r_[first, len(anchor)])
        end = first + count - 1 + WINDOW
        whole = _mixed((total[end] - total[first]) * _INV[first] + count.astype(np.uint64) * _MIX)
        for o, v in zip(out, (first + at, count, anchor[first] - first, gram[anchor[first]], whole)):
            o.append(v)
    return tuple(np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)


# ------------------------------------------------------- column-wise construction

class _File:
    """An array in a file that is read and written as a whole, front to back, and never shrinks."""

    def __init__(self, folder: str, name: str, dtype):
        self.file, self.dtype = open(os.path.join(folder, name), "w+b", buffering=0), np.dtype(dtype)

    def read(self) -> np.ndarray:
        out = np.empty(os.fstat(self.file.fileno()).st_size // self.dtype.itemsize, self.dtype)
        self.file.seek(0)
        self.file.readinto(out)
        return out

    def write(self, a: np.ndarray) -> None:
        self.file.seek(0)
        self.file.write(a.astype(self.dtype, copy=False))

    def last(self) -> np.ndarray:
        out = self.read()
        self.file.close()
        return out


def _ragged_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low:high] for each pair (low < high)."""
    size = high - low
    out = np.empty(len(low), values.dtype)
    wide = size > 4096  # rare symbols: one by one
    for k in np.flatnonzero(wide):
        out[k] = values[low[k]:high[k]].min()
    low, size, rest = low[~wide], size[~wide], np.flatnonzero(~wide)
    for i in range(0, len(rest), 1 << 14):
        s = size[i:i + (1 << 14)]
        ends = np.cumsum(s)
        if len(s):
            at = np.repeat(low[i:i + (1 << 14)] - (ends - s), s) + np.arange(ends[-1])
            out[rest[i:i + (1 << 14)]] = np.minimum.reduceat(values[at], ends - s)
    return out


def suffix_order(texts: list[np.ndarray], folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and common prefix lengths of a collection, built column by column.

    The suffixes' order begins with the empty suffix of every text, in the order of
    ``texts``; ``_NONE`` stands where nothing precedes. Prefix lengths are
    with the suffix before.
    """
    m = len(texts)
    size = np.array([len(t) for t in texts])
    rows = np.full((m, size.max(initial=0)), _NONE, np.uint8)  # right-aligned
    for i, t in enumerate(texts):
        rows[i, rows.shape[1] - len(t):] = t
    bwt_file, lcp_file = _File(folder, "bwt", np.uint8), _File(folder, "lcp", np.uint16)
    bwt_file.write(np.full(m, _NONE))
    lcp_file.write(np.zeros(m))
    place = np.arange(m)  # of each text's longest suffix so far
    count = np.zeros(256, np.int64)  # of each symbol in the transform
    for j in range(1, rows.shape[1] + 1):
        act = np.flatnonzero(size >= j)
        bwt, lcp = bwt_file.read(), lcp_file.read()
        symbol = rows[act, rows.shape[1] - j]
        here = place[act]
        bwt[here] = symbol
        # the suffixes that start with a symbol are, in order, those before which it stands
        order = np.argsort(bwt, kind="stable")
        fresh = np.zeros(len(bwt), bool)
        fresh[here] = True
        k = np.flatnonzero(fresh[order])  # ranks of this round's suffixes, by symbol and place
        by_rank = np.lexsort((here, symbol))
        act, here, symbol = act[by_rank], here[by_rank], symbol[by_rank]
        count += np.bincount(symbol, minlength=256)
        ends = np.cumsum(count)
        has_prev = k > (ends - count)[symbol]
        has_next = k + 1 < ends[symbol]
        own = np.zeros(len(act), np.int64)
        own[has_prev] = 1 + _ragged_min(lcp, order[k[has_prev] - 1] + 1, here[has_prev] + 1).astype(np.int64)
        after = 1 + _ragged_min(lcp, here[has_next] + 1, order[k[has_next] + 1] + 1).astype(np.int64)
        # where the longer suffixes go once all are in; the others move up in between
        goes = m + k
        stay = np.ones(len(bwt) + len(act), bool)
        stay[goes] = False
        bwt2, lcp2 = np.full(len(stay), _NONE, np.uint8), np.zeros(len(stay), np.uint16)
        bwt2[stay], lcp2[stay] = bwt, lcp
        lcp2[goes] = own
        lcp2[goes[has_next] + 1] = after
        idle = np.flatnonzero(size < j)  # texts that ended: their longest suffix moved too
        place[idle] += np.searchsorted(goes - np.arange(len(goes)), place[idle], side="right")
        place[act] = goes
        bwt_file.write(bwt2)
        lcp_file.write(lcp2)
    return bwt_file.last(), lcp_file.last()


def repeated_windows(texts: list[np.ndarray], window: int = WINDOW) -> list[np.ndarray]:
    """For each text, which of its windows also start in another place of the collection."""
    with tempfile.TemporaryDirectory(prefix="columns-") as folder:
        bwt, lcp = suffix_order(texts, folder)
    m = len(texts)
    long = np.r_[lcp >= window, False]
    shared = long[:-1] | long[1:]  # as long as the suffix before or after
    order = np.argsort(bwt, kind="stable")
    lead = np.empty(len(bwt), np.int64)
    lead[order] = m + np.arange(len(bwt))
    size = np.array([len(t) for t in texts])
    out = [np.zeros(max(0, n - window + 1), bool) for n in size]
    place = np.arange(m)
    for j in range(1, int(size.max(initial=0)) + 1):
        act = np.flatnonzero(size >= j)
        place[act] = lead[place[act]]
        if j >= window:
            for i in act[shared[place[act]]]:
                out[i][size[i] - j] = True
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and number of each run of true flags."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    first = np.flatnonzero(edge == 1)
    return first, np.flatnonzero(edge == -1) - first


# ---------------------------------------------------------------------- Spark side

_TAG_BITS = 18


def _packed(start: np.ndarray, tag: int, anchor: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Start, text's tag, anchor's place and number of windows in one long."""
    return (start.astype(np.int64) << 32) | np.int64(tag << 14) | (anchor.astype(np.int64) << 7) | count.astype(np.int64)


def _spot(spot: int) -> tuple[int, int, int, int]:
    return spot >> 32, (spot >> 14) & ((1 << _TAG_BITS) - 1), (spot >> 7) & 127, spot & 127


def _occurrences(texts: DataFrame) -> DataFrame:
    """(gram, piece, doc, spot) of each piece; spot packs where it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            raw = batch.column("text").cast(pa.large_binary())
            data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
            ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
            doc, tag = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
            cols = [[], [], [], []]
            for i in range(len(raw)):
                start, count, anchor, gram, piece = pieces(data[ends[i]:ends[i + 1]])
                if len(start):
                    for c, v in zip(cols, (gram.view(np.int64), piece.view(np.int64), np.full(len(start), doc[i]),
                                           _packed(start, int(tag[i]), anchor, count))):
                        c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["gram", "piece", "doc", "spot"])

    return texts.select("doc", "tag", "text").mapInArrow(run, "gram long, piece long, doc long, spot long")


def _packed_texts(texts: DataFrame) -> DataFrame:
    """(doc_id, doc, tag, blob) with compressed texts, for the shuffles by document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in text_batches(batches):
            blob = pa.array([squeeze(t.encode("utf-8")) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "doc", "tag")] + [blob],
                                             ["doc_id", "doc", "tag", "blob"])

    return texts.select("doc_id", "doc", "tag", "text").mapInArrow(run, "doc_id long, doc long, tag long, blob binary")


_TAG = f"(shiftright(spot, 14) & {(1 << _TAG_BITS) - 1})"


def _cut(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(gram, doc, spot, multi, bytes): the bytes of the listed pieces."""
    lists = members.groupBy("doc", F.expr(_TAG).alias("tag")).agg(F.collect_list(F.struct("gram", "spot", "multi")).alias("want"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor().decompress
        for batch in text_batches(batches):
            out = [[], [], [], [], []]
            for doc, blob, want in zip(*(batch.column(c).to_pylist() for c in ("doc", "blob", "want"))):
                raw = grow(blob)
                for w in want:
                    start, _, _, count = _spot(w["spot"])
                    for c, v in zip(out, (w["gram"], doc, w["spot"], w["multi"], raw[start:start + count - 1 + WINDOW])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()))], ["gram", "doc", "spot", "multi", "bytes"])

    return _packed_texts(texts).join(lists, ["doc", "tag"]).select("doc", "blob", "want").mapInArrow(
        run, "gram long, doc long, spot long, multi boolean, bytes binary")


def _sections(rows: list[tuple]) -> list[dict[bytes, list[tuple]]]:
    """The pieces of one anchor cut into sections of up to SECTION windows, grouped by what a section's windows all hold.

    Sections begin at multiples of SECTION before the anchor, so equal windows
    are in sections of one place, and all windows of a section hold the bytes in
    its middle. A section whose middle no other piece has is left out. A group
    maps a section's bytes to its (doc, spot, first window, multi).
    """
    groups: dict[tuple, dict[bytes, list[tuple]]] = {}
    for doc, spot, multi, raw in rows:
        _, _, anchor, count = _spot(spot)
        for k in range((anchor - count + 1) // SECTION, anchor // SECTION + 1):
            high = anchor - k * SECTION
            low = max(0, high - SECTION + 1)
            middle = raw[high:high - SECTION + 1 + WINDOW]
            groups.setdefault((k, middle), {}).setdefault(raw[low:min(high, count - 1) + WINDOW], []).append((doc, spot, low, multi))
    return [g for g in groups.values() if len(g) > 1 or len(next(iter(g.values()))) > 1]


def _compared(cut: DataFrame, batch: int, max_pieces: int) -> DataFrame:
    """(kind, doc, tag, start, length, h1, h2, multi): repeated stretches (kind 0) of pieces that occur once.

    Small anchors are compared together in collections of about ``batch`` pieces,
    one with more in a collection of its own. Pieces of an anchor with more than
    ``max_pieces`` come out window by window with 128-bit hashes (kind 1), to be
    counted by a shuffle on the hash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, here, gram, wide, last = [], [], None, False, None
        out = [[] for _ in range(8)]

        def put(*row):
            for c, v in zip(out, row):
                c.append(v)

        def repeated(doc, spot, first, windows):
            start, tag, _, _ = _spot(spot)
            put(0, doc, tag, start + first, windows - 1 + WINDOW, 0, 0, False)

        def build():
            flags = repeated_windows([np.frombuffer(h[0], np.uint8) for h in held])
            for (_, member), f in zip(held, flags):
                if member is not None:
                    doc, spot, low = member
                    for first, n in zip(*_runs(f)):
                        repeated(doc, spot, low + int(first), int(n))
            held.clear()

        def apart(rows):
            for doc, spot, multi, raw in rows:
                start, tag, _, _ = _spot(spot)
                for k in range(len(raw) - WINDOW + 1):
                    h = xxhash.xxh3_128_intdigest(raw[k:k + WINDOW])
                    put(1, doc, tag, start + k, WINDOW, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), multi)

        def close():
            nonlocal here, wide
            if not wide and len(here) > 1:
                for group in _sections(here):
                    # equal sections repeat whole, and one of them stands for all
                    many = {raw: len(m) > 1 or m[0][3] for raw, m in group.items()}
                    for raw, m in group.items():
                        for doc, spot, low, multi in m:
                            if many[raw] and not multi:
                                repeated(doc, spot, low, len(raw) - WINDOW + 1)
                    if len(group) > 1 and not all(many.values()):
                        if held and len(held) + len(group) > batch:
                            build()
                        held.extend((raw, None if many[raw] else m[0][:3]) for raw, m in group.items())
            here, wide = [], False

        def flush():
            types = (pa.int64(),) * 7 + (pa.bool_(),)
            rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                               ["kind", "doc", "tag", "start", "length", "h1", "h2", "multi"])
            for c in out:
                c.clear()
            return rows

        for part in text_batches(batches):
            for g, doc, spot, multi, raw in zip(*(part.column(c).to_pylist() for c in ("gram", "doc", "spot", "multi", "bytes"))):
                if (g, doc, spot) == last:
                    continue  # a repeated row
                last = (g, doc, spot)
                if g != gram:
                    close()
                    gram = g
                here.append((doc, spot, multi, raw))
                if wide or len(here) > max_pieces:
                    wide = True
                    apart(here)
                    here = []
                if len(out[0]) > 20_000:
                    yield flush()
        close()
        if held:
            build()
        yield flush()

    ordered = cut.repartition("gram").sortWithinPartitions("gram", "doc", "spot")
    return ordered.mapInArrow(run, "kind long, doc long, tag long, start long, length long, h1 long, h2 long, multi boolean")


def repeated_stretches(docs: DataFrame, batch: int = 1024, max_pieces: int = 16384) -> DataFrame:
    """(doc, tag, spans array<long>) of texts (doc_id, doc, tag, text) with repeats; a span packs start and length."""
    # anchors that occur once are told by a count with map-side sums; only rows of others move again
    occ = _occurrences(docs)
    # (kept, so that the join with them can split a hot anchor)
    grams = stored(occ.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("lo"), F.max("piece").alias("hi")).where(
        "n > 1").select("gram", (F.col("lo") != F.col("hi")).alias("differ")))
    common = stored(occ.join(grams, "gram"))
    each = common.groupBy("gram", "piece", "differ").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "spot")).alias("first"))
    members = each.where("differ").select("gram", "first.doc", "first.spot", (F.col("n") > 1).alias("multi"))
    found = stored(_compared(_cut(members, docs), batch, max_pieces))
    copied = common.join(each.where("n > 1").select("gram", "piece"), ["gram", "piece"]).select(
        "doc", F.expr(_TAG).alias("tag"), F.expr("shiftright(spot, 32)").alias("start"),
        F.expr(f"(spot & 127) + {WINDOW - 1}").alias("length"))
    single = found.where("kind = 1")
    twice = single.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("multi").alias("any")).where("n > 1 OR any").select("h1", "h2")
    cols = ["doc", "tag", "start", "length"]
    spans = copied.union(found.where("kind = 0").select(cols)).union(
        single.where("NOT multi").join(twice, ["h1", "h2"]).select(cols))
    return spans.groupBy("doc", "tag").agg(F.collect_list(F.expr("shiftleft(start, 32) | length")).alias("spans"))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows as (doc_id, doc, tag, text): the id, or a hash of the text for null ids, and some bits of the text's hash."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("doc", F.coalesce("doc_id", F.xxhash64("text"))).withColumn("tag", F.expr(f"xxhash64(text, 24) & {(1 << _TAG_BITS) - 1}").cast("long"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_spans, kept binary) of every row.

    Each byte covered by a ``WINDOW``-byte string that also starts anywhere else, in
    the same text included, is removed; all strings are judged on the input.
    Texts are their UTF-8 bytes, null ones empty; texts below ``WINDOW`` bytes lose
    nothing. Rows with equal texts repeat each other whole. ``kept`` may split a
    character. An empty table gives an empty one; other columns are not read.
    """
    rows = _keyed(docs, doc_id, text)
    spans = repeated_stretches(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor().decompress
        for batch in text_batches(batches):
            size, count, kept = [], [], []
            for blob, spans in zip(batch.column("blob").to_pylist(), batch.column("spans").to_pylist()):
                raw = np.frombuffer(grow(blob), np.uint8)
                size.append(len(raw))
                if spans:
                    s = np.array(spans, np.int64)
                    depth = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(depth, s >> 32, 1)
                    np.add.at(depth, (s >> 32) + (s & 0xFFFFFFFF), -1)
                    gone = np.cumsum(depth)[:-1] > 0
                    count.append(len(_runs(gone)[0]))
                    raw = raw[~gone]
                else:
                    count.append(0)
                kept.append(raw.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(count, pa.int64()),
                                              pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_spans", "kept"])

    joined = _packed_texts(rows).join(spans, ["doc", "tag"], "left").select("doc_id", "blob", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_spans long, kept binary")


def removal_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    return remove_repeats(docs).select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                                       "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
