"""Token ids as flat binary files with 64-bit document offsets, read by memory map.

A part is two files. ``part-N.bin`` holds the ids of its documents one after
another as little-endian unsigned integers (16 bits when the vocabulary fits,
else 32). ``part-N.idx`` holds, little-endian: document count n, n+1 int64
offsets into the part (in ids), n int64 document ids and n null flags. Parts
are in ascending document order; the base of a part is the prefix sum of the id
counts of the parts before it.
"""

from __future__ import annotations

import functools
import os
import sys
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_path, stored, text_batches


@functools.cache
def letters_that_end_in_marks() -> tuple[str, ...]:
    """Letters whose composed lower-case form ends in a combining mark, which the library joins with the sentence mark after it."""
    letters = (c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum())
    return tuple(c for c in letters if unicodedata.category(unicodedata.normalize("NFC", c).lower()[-1])[0] not in "LN")


class WordEncoder:
    """The tokenizers library with the ids of words kept.

    The vocabulary's normaliser turns white space into one space and lowers case
    letter by letter, its pre-tokenizer never joins characters across white space,
    nor a letter or digit with a sentence mark after it (normalised: a few letters become a
    letter and a combining mark, which isn't one), and spaces give no ids. So
    the ids of a text are those of its pieces between spaces and line feeds, and
    those of a piece are its word's and its closing marks'.
    """

    CACHE = 500_000  # words kept; later ones are encoded batch by batch
    GROUP = 256  # words in one text for the library
    MARKS = ".,;:!?"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = {k.content: i for i, k in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.ids: dict[str, bytes] = {"": b""}
        self.unsure = f"[{''.join(letters_that_end_in_marks())}]$"

    def _learn(self, pieces: list[str], dtype: str) -> None:
        """Encode new pieces, many in one text.

        A word of letters alone ends with its one token that has the end-of-word mark,
        so such words stand with spaces between them. Others are told apart by a
        special token between them.
        """
        mark, number = next(iter(self.special.items()), (None, None))
        letters, other = [p for p in pieces if p.isalpha()], [p for p in pieces if not p.isalpha()]
        if mark is None:
            self._learn_singly(other, dtype)
        for some, between in ((letters, " "), (other if mark else [], mark)):
            groups = [some[i:i + self.GROUP] for i in range(0, len(some), self.GROUP)]
            for i in range(0, len(groups), 64):
                texts = [between.join(g) for g in groups[i:i + 64]]
                for g, text, e in zip(groups[i:i + 64], texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                    ids = np.array(e.ids, dtype=np.int64)
                    if between == " ":
                        stop = np.flatnonzero(self.word_end[ids]) + 1  # after each word's last token
                        start = np.r_[0, stop[:-1]] if len(stop) else stop
                        sound = len(stop) == len(g)
                    else:
                        at = np.flatnonzero(ids == number)
                        start, stop = np.r_[0, at + 1], np.r_[at, len(ids)]
                        sound = sum(map(text.count, self.special)) == len(g) - 1
                    if not sound:  # a piece holds a special token itself, or isn't one word to the library
                        self._learn_singly(g, dtype)
                        continue
                    raw, width = ids.astype(dtype).tobytes(), np.dtype(dtype).itemsize
                    self.ids.update(zip(g, [raw[x:y] for x, y in zip((start * width).tolist(), (stop * width).tolist())]))

    def _learn_singly(self, pieces: list[str], dtype: str) -> None:
        for p in pieces:
            self.ids[p] = np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, dtype=dtype).tobytes()

    def _parts(self, pieces: pa.Array) -> tuple[pa.Array, list[str]]:
        """(words, closing marks) of pieces; a piece that doesn't end in a word and marks is a word as it is."""
        word = pc.utf8_rtrim(pieces, self.MARKS)
        ends = pc.and_(pc.match_substring_regex(word, r"[\p{L}\p{N}]$"), pc.invert(pc.match_substring_regex(word, self.unsure)))
        word = pc.if_else(ends, word, pieces)
        size = pc.subtract(pc.binary_length(pieces), pc.binary_length(word)).to_numpy()
        marks = [""] * len(pieces)
        ended = np.flatnonzero(size)
        for i, p in zip(ended.tolist(), pieces.take(pa.array(ended)).to_pylist()):
            marks[i] = p[-int(size[i]):]
        # a special token's name in capitals must not become the token
        plain = pc.and_(pc.string_is_ascii(word), pc.invert(pc.match_substring(word, "<")))
        return pc.if_else(plain, pc.ascii_lower(word), word), marks

    def encode(self, texts: pa.Array, end: int, dtype: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts in a row, each text's with the end id, and how many each has."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()  # each distinct piece of the batch is handled once
        words, marks = self._parts(coded.dictionary)
        words = words.dictionary_encode()
        names = words.dictionary.to_pylist() + sorted(set(marks))
        number = {m: len(words.dictionary) + i for i, m in enumerate(names[len(words.dictionary):])}
        fresh = list({p for p in names if p not in self.ids})
        self._learn(fresh, dtype)
        raw = list(map(self.ids.__getitem__, names))
        for p in fresh[max(0, self.CACHE - len(self.ids) + len(fresh)):]:
            del self.ids[p]
        table = np.frombuffer(b"".join(raw), dtype)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // np.dtype(dtype).itemsize
        begin = np.cumsum(size) - size
        # ids of each distinct piece, then of each piece of the texts
        both = np.stack([words.indices.to_numpy(), np.fromiter(map(number.__getitem__, marks), np.int64, len(marks))], axis=1).ravel()
        table, ends = _gather(table, begin[both], size[both])
        ends = np.concatenate([[0], ends[1::2]])
        which = coded.indices.to_numpy()
        flat, ends = _gather(table, ends[which], np.diff(ends)[which])
        edges = np.concatenate([[0], ends])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        out = np.empty(len(flat) + len(texts), dtype)
        last = edges[1:] + np.arange(len(texts))
        body = np.ones(len(out), bool)
        body[last] = False
        out[last], out[body] = end, flat
        return out, np.diff(edges) + 1


def _gather(table: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``table`` in a row, and where each ends."""
    ends = np.cumsum(size)
    return table[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], ends


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _write(store: fs.FileSystem, path: str, chunks: list[bytes]) -> None:
    """Write under another name first, so that a lost or repeated task leaves whole files only."""
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(own) as f:
        for c in chunks:
            f.write(c)
    store.move(own, path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end: int = 1,
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, append ``end`` and write the parts; (part, path, dtype, n_docs, n_ids) of each part.

    ``folder`` is a URI every executor can write. Documents are range-partitioned
    and sorted by id, null ids first; rows with equal ids are ordered by a
    hash of their text. A null or empty text is the end id alone; an empty table writes no
    part. A part's ids are gathered in one task, so its size is that of a
    shuffle partition. The integer width follows from the vocabulary's size.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(tokenizer)
        dtype = "<u2" if max(enc.size - 1, end) < 1 << 16 else "<u4"
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        own, counts, ids, nulls = f"{base}/part-{part:06d}.bin.{uuid.uuid4().hex}.tmp", [], [], []
        with store.open_output_stream(own) as f:
            for batch in text_batches(batches, 8 << 20):
                flat, count = enc.encode(batch.column("text"), end, dtype)
                f.write(flat.tobytes())
                counts.append(count.astype("<i8"))
                ids.append(batch.column("doc_id").fill_null(0).to_numpy().astype("<i8"))
                nulls.append(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype("u1"))
        if not counts:
            store.delete_file(own)
            return
        store.move(own, f"{base}/part-{part:06d}.bin")
        count = np.concatenate(counts)
        offsets = np.concatenate([[0], np.cumsum(count)]).astype("<i8")
        _write(store, f"{base}/part-{part:06d}.idx", [np.array([len(count)], "<i8").tobytes(), offsets.tobytes(),
                                                     np.concatenate(ids).tobytes(), np.concatenate(nulls).tobytes()])
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [f"{folder}/part-{part:06d}"], "dtype": [dtype],
                                          "n_docs": [len(count)], "n_ids": [int(offsets[-1])]})

    return stored(ordered.mapInArrow(run, "part long, path string, dtype string, n_docs long, n_ids long"))


def part_bases(parts: DataFrame) -> DataFrame:
    """Parts with ``base``, the ids in all parts before; one row per part, so the window is small."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _map(store: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped where it has a local path, else read whole."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def read_token_files(parts: DataFrame, batch_docs: int = 2000) -> DataFrame:
    """(doc_id, start, ids binary) of each document from the files.

    ``start`` counts the ids of all documents before it; ``ids`` are the
    document's raw integers as unsigned 32-bit little-endian.
    """
    rows = part_bases(parts).select("path", "dtype", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["path"])
                index = _map(store, f"{path}.idx", "u1")
                n = int(index[:8].view("<i8")[0])
                offsets = index[8:16 + 8 * n].view("<i8")
                ids = index[16 + 8 * n:16 + 16 * n].view("<i8")
                nulls = index[16 + 16 * n:16 + 17 * n].view("u1")
                tokens = _map(store, f"{path}.bin", row["dtype"])
                for i in range(0, n, batch_docs):
                    j = min(n, i + batch_docs)
                    some = np.array(tokens[offsets[i]:offsets[j]], dtype="<u4")
                    cut = np.asarray(offsets[i:j + 1] - offsets[i], dtype=np.int64) * 4
                    raw = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(cut), pa.py_buffer(some)])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.asarray(ids[i:j]), mask=np.asarray(nulls[i:j]).astype(bool)),
                        pa.array(np.asarray(offsets[i:j]) + row["base"]), raw.cast(pa.binary())], ["doc_id", "start", "ids"])

    spread = rows.repartition(max(1, parts.count()), "path")  # each part by itself
    return spread.mapInArrow(run, "doc_id long, start long, ids binary")


def file_digests(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int = 1) -> DataFrame:
    """Write the files and read them back: (doc_id, start, n_tokens, ids_crc32) of every row."""
    spark: SparkSession = docs.sparkSession
    parts = write_token_files(docs, folder or shared_path(spark, "tokens"), tokenizer, end)
    back = read_token_files(parts)
    return back.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def crc_of_ids(ids: list[int]) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
