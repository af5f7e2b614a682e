"""Operators 4 and 5 against the public tokenizer libraries."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm import bpe, queries, token_files

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
ODD = ["", " ", "a", "it's 'S we'll", "x\x1cy\x85z", "naïve café ÀÉ", "日本語のテキスト", "😀👩‍👩‍👧", "1234567 ½²", "\n\n \t a  b", "a" * 700,
       "ab " * 300, "<|endoftext|> a<|startoftext|>b", "ΑΣ. Σ,", "İstanbul!", "á. é", "don't...", "ǅ.", "|<|", "!!!??", " x y."]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=6))
def test_matrix_merges_equal_library(texts):
    ranks = test_matrix_merges_equal_library.__dict__.setdefault("lib", None) or tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}, special_tokens={})
    test_matrix_merges_equal_library.lib = ranks
    codec = bpe.codec(RANKS, P.PATTERN)
    flat, count = codec.encode(texts + ODD)
    parts = np.split(flat, np.cumsum(count)[:-1])
    for text, ids in zip(texts + ODD, parts):
        assert ids.tolist() == ranks.encode_ordinary(text)
        raw, _ = codec.decode(ids)
        assert raw.tobytes() == text.encode()


def test_long_pieces_merge_alike(reference):
    codec = bpe.codec(RANKS, P.PATTERN)
    rng = np.random.default_rng(0)
    for n in (257, 1000, 5000):
        text = "".join(rng.choice(list("etaoinshr"), n))
        assert codec.encode([text])[0].tolist() == reference.encode_ordinary(text)


@pytest.mark.parametrize("kept", [0, 3, 40])
def test_pieces_that_are_not_kept_change_nothing(reference, kept):
    codec = bpe.ByteBPE(RANKS, P.PATTERN)
    codec.CACHE = kept
    for text in ODD * 2:
        assert codec.encode([text, text])[0].tolist() == reference.encode_ordinary(text) * 2


def test_digests(docs_of, reference):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (3, "again"), (3, "again"), (50, "long words " * 20000)]
    got = sorted(map(tuple, bpe.token_digests(docs_of(rows), RANKS, P.PATTERN).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe.token_digests(docs_of([]), RANKS, P.PATTERN).count() == 0


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(1, [72, 73]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, "doc_id", "ids", RANKS, P.PATTERN).collect()}
    assert got[2] == b"" and got[3] == b"" and len(got[1]) >= 2


def test_word_pieces_equal_library():
    enc, lib = token_files.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    enc.CACHE = 50  # later pieces aren't kept
    for t in ODD + ["Word, word. WORD! word; x:y 3.5, (a) 'q' <|ENDOFTEXT|>. ...! é!? É. _. a_. ½! ². DON'T. it'S!", None]:
        want = lib.encode(t or "", add_special_tokens=False).ids + [1]
        flat, count = enc.encode(pa.array([t, None, t], pa.string()), 1, "<u2")
        assert flat.tolist() == [*want, 1, *want] and count.tolist() == [len(want), 1, len(want)]


def test_files_read_back(docs_of, tmp_path):
    lib = Tokenizer.from_file(WORDS)
    rows = [(10 - i, t) for i, t in enumerate(ODD[:11])] + [(500, None), (7_000_000_000, "far away"), (30, "long text " * 5000)]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.file_digests(docs_of(rows), WORDS, f"file://{tmp_path}/t").collect()}
    start = 0
    for i, t in sorted(rows):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        assert got[i] == (start, len(ids), token_files.crc_of_ids(ids))
        start += len(ids)
    flat = b"".join(p.read_bytes() for p in sorted((tmp_path / "t").glob("*.bin")))
    assert len(flat) == 2 * start and zlib.crc32(flat) is not None


def test_repeated_and_null_ids_in_files(docs_of):
    got = token_files.file_digests(docs_of([(None, "b"), (2, "x"), (2, "x"), (2, "y z")]), WORDS).collect()
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == [None, 2, 2, 2]
    assert [r.start for r in by_start[1:]] == list(np.cumsum([r.n_tokens for r in by_start])[:-1])
    assert token_files.file_digests(docs_of([]), WORDS).count() == 0


def test_registered(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert queries.QUERIES["op4_byte_bpe"](spark, sf_dir).count() == n
    assert queries.QUERIES["op5_token_files"](spark, sf_dir).count() == n


def test_letters_that_normalise_to_a_mark_stay_with_the_sentence_mark():
    """Every letter, digit and mark before a sentence mark, against the library; 60 letters end in a mark once normalised."""
    import unicodedata
    assert len(token_files.letters_that_end_in_marks()) == 60
    encoder, library = token_files.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    chars = [c for c in map(chr, range(0x110000)) if unicodedata.category(c)[0] in "LNM"]
    texts = [f"a{c}." for c in chars] + [f"{c}{m}" for c in token_files.letters_that_end_in_marks() for m in ".,;:!?"] + ["İKİ.", "BELEDİYESİ:", "হয়,", "क़."]
    ids, counts = encoder.encode(pa.array(texts), 1, "uint32")
    got = [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids + [1] for e in library.encode_batch(texts, add_special_tokens=False)]
