"""Operators 1, 6, 8 and 9 against brute force."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from larder.llm import line_dedup, ngram_join, nn_descent, queries, suffix_dedup


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---------------------------------------------------------------- vectors

def vectors(spark, rows, extra=True):
    schema = "vec_id long, embedding array<float>, label int" + (", node long, vec string, links long, dim int" if extra else "")
    return spark.createDataFrame([(*r, *((7, "z", 9, 1) if extra else ())) for r in rows], schema)


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 16))
    tight = rng.standard_normal(16) + 0.02 * rng.standard_normal((150, 16))  # fuller than a list, in more than one block
    pairs = base[:60] + 0.05 * rng.standard_normal((60, 16))
    x = np.concatenate([base, tight, pairs, base[:20]]).astype(np.float32)
    label = np.r_[np.arange(300) % 3, np.zeros(150, int), np.arange(60) % 3, np.arange(20) % 3]
    got = {r.vec_id: r for r in nn_descent.near_duplicates(
        vectors(spark, [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))]), block=64).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    hit = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(hit, False)
    comp = components(range(len(x)), np.argwhere(hit).tolist())
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (hit[i].sum(), comp[i], comp[i] == i)
        assert got[i].recall >= 0.995


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, v, None), (4, None, 1), (5, [], 1), (6, [0.0] * 3, 1), (7, [float("nan"), 1.0, 1.0], 1),
            (8, [float("inf"), 1.0, 1.0], 1), (9, [1.0, None, 1.0], 1), (10, [1.0, 2.0], 1), (11, [2.0, 4.0, 6.0], 1), (12, v, 2), (None, v, 2)]
    got = nn_descent.near_duplicates(vectors(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[11] == (3, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert by[i] == (0, i, True)
    assert by[12] == (1, 12, True) and by[None] == (1, 12, False)


def test_no_vectors(spark):
    assert nn_descent.near_duplicates(vectors(spark, [])).count() == 0


def test_full_lists_do_not_hide_links_across_groups(spark):
    rng = np.random.default_rng(8)
    dim, groups, size = 64, 6, 30
    basis = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    x = []
    for g in range(groups):  # cosine about 0.985 across groups, 0.9997 inside
        centre = basis[0] + 0.1225 * basis[1 + g]
        x += [centre + 0.002 * rng.standard_normal(dim) for _ in range(size)]
    x = np.array(x, np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    hit = u @ u.T >= 0.98
    assert hit.all()
    got = nn_descent.near_duplicates(vectors(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)])).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(groups * size - 1, 0)}


def test_missed_pairs_are_not_outweighed(spark, monkeypatch):
    """A forest that only joins a large group: its links must not hide the pairs that are missed."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((80, 32)).astype(np.float32)
    x[:40] = x[0] + 0.001 * rng.standard_normal((40, 32))
    x[61:80:2] = x[60:80:2] + 0.01 * rng.standard_normal((10, 32))
    leaves = nn_descent._leaves
    monkeypatch.setattr(nn_descent, "_leaves", lambda nodes, dtype, trees, k: leaves(
        nodes.join(group, ["vec"], "left_semi"), dtype, trees, k))
    group = spark.createDataFrame([(bytearray(v.tobytes()),) for v in x[:40]], "vec binary")
    rows = vectors(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)])
    got = {r.vec_id: r for r in nn_descent.near_duplicates(rows, attempts=1).collect()}
    for i in range(80):
        low = 0 if i < 40 else i - i % 2 if i >= 60 else i
        assert (got[i].n_links, got[i].component_id) == (39 if i < 40 else 1 if i >= 60 else 0, low)
        assert got[i].recall == 1


def test_trees_follow_the_label_size():
    assert nn_descent.trees_for(0.98, 50, 0.995) == 1
    assert nn_descent.trees_for(0.98, 1_000_000, 0.995) > 6


# ---------------------------------------------------------------- n-gram join

def shingles(text, n=5):
    w = text.split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def test_join_equals_brute_force(docs_of):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(400)]
    base = [list(rng.choice(vocab, rng.integers(1, 120))) for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for _ in range(rng.integers(0, 6)):
            c = list(b)
            for _ in range(rng.integers(0, 1 + len(c) // 25 + 1)):
                c[rng.integers(len(c))] = "new" + str(rng.integers(1000))
            texts.append(" ".join(c))
    big = list(rng.choice(vocab, 150))
    for i in range(90):  # more than a block of near copies
        c = list(big)
        c[rng.integers(150)] = f"v{i}"
        texts.append(" ".join(c))
    texts += texts[:10] + ["", None, "  ", "  ", "one two"]
    got = {r.doc_id: r for r in ngram_join.document_classes(docs_of(list(enumerate(texts))), block=32).collect()}
    sets = [shingles(t or "") for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(len(texts)) if i != j and texts[i] and texts[j] and (
        texts[i] == texts[j] or (sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])))]
    count, comp = Counter(i for i, _ in links), components(range(len(texts)), links)
    for i in range(len(texts)):
        assert (got[i].n_links, got[i].class_id, got[i].kept) == (count[i], comp[i], comp[i] == i), (i, texts[i])


def test_keep_one_row_of_each_class(docs_of):
    t = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(5, t), (3, t), (3, t), (None, t), (9, t + " end"), (1, None), (1, None), (2, ""), (4, "other words here"), (4, "more of other words")]
    docs = docs_of(rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(3, t), (4, "more of other words"), (4, "other words here")]
    assert kept.where("text IS NULL").count() == 2 and kept.where("text = ''").count() == 1
    assert ngram_join.keep_one(docs_of([])).count() == 0


def test_prefixes_shorten_until_the_recall_is_met(spark, docs_of):
    rng = np.random.default_rng(0)
    vocab = [f"w{i}" for i in range(500)]
    base = list(rng.choice(vocab, 200))
    near, far = [], []
    for i in range(40):
        c = list(base)
        c[5] = f"x{i}"
        near.append(" ".join(c))
        b = list(rng.choice(vocab, 100))
        d = list(b)
        for k in (20, 50):
            d[k] = "y"
        far += [" ".join(b), " ".join(d)]
    depth = {}
    for name, texts in (("near", near), ("far", far)):
        rows = docs_of(list(enumerate(texts)), False).selectExpr("text", "unhex(md5(text)) AS key")
        depth[name] = ngram_join.candidate_groups(ngram_join._signed(rows, 5), 0.8, 0.999)[1]
    assert depth["near"] > depth["far"] >= 4


def test_close_texts_do_not_lengthen_the_prefix_of_far_ones(docs_of):
    rng = np.random.default_rng(0)
    vocab = [f"w{i}" for i in range(500)]
    base = list(rng.choice(vocab, 200))
    texts = []
    for i in range(2000):
        c = list(base)
        c[i % 200] = f"x{i}"
        texts.append(" ".join(c))
    for i in range(10):
        b = list(rng.choice(vocab, 100))
        d = list(b)
        d[20] = d[50] = "y"
        texts += [" ".join(b), " ".join(d)]
    rows = docs_of(list(enumerate(texts)), False).selectExpr("text", "unhex(md5(text)) AS key")
    depth = ngram_join.candidate_groups(ngram_join._signed(rows, 5), 0.8, 0.999)[1]
    assert ngram_join.collision(0.8, depth) >= 0.999


# ---------------------------------------------------------------- lines

def test_lines_equal_sql(spark, docs_of, tmp_path):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(200):
        lines = [f"line {rng.integers(3000)}" for _ in range(rng.integers(0, 6))] + (["menu"] if i % 4 == 0 else []) + ([" menu "] if i % 9 == 0 else [])
        rows.append((i, "\n".join(rng.permutation(lines)) if lines else "", [None, "a", "b"][i % 3]))
    rows += [(None, None, "a"), (7, "menu\n\nmenu\nend", "a"), (7, "menu\n\nmenu\nend", "a"), (900, "alone\nalone", "single")]
    docs = docs_of(rows)
    docs.write.parquet(f"{tmp_path}/d.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet/*.parquet'")
    got = sorted(map(tuple, line_dedup.line_report(docs).collect()), key=repr)
    assert got == sorted(con.sql(line_dedup.line_report_sql()).fetchall(), key=repr)
    assert any(r[3] for r in got) and (900, "alone\nalone", 2, 0) in got


def test_line_cut_keeps_other_columns(docs_of):
    docs = docs_of([(i, f"top\nown {i}\n\nlast {i}", "s") for i in range(20)])
    cut = line_dedup.drop_boilerplate(docs)
    assert cut.columns == docs.columns
    assert {r.text for r in cut.collect()} == {f"own {i}\n\nlast {i}" for i in range(20)}
    assert line_dedup.drop_boilerplate(docs_of([])).count() == 0


def test_line_cut_is_native(docs_of):
    plan = line_dedup.line_report(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ---------------------------------------------------------------- byte strings

def repeats(texts, w=suffix_dedup.WINDOW):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + w] for r in raws for i in range(len(r) - w + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - w + 1):
            if seen[r[i:i + w]] > 1:
                gone[i:i + w] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((len(r), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def byte_cases():
    rng = np.random.default_rng(2)
    word = lambda n: " ".join("".join(rng.choice(list("abcdeéß"), rng.integers(1, 9))) for _ in range(n))
    shared = word(90)
    texts = [word(60) + shared + word(40) for _ in range(12)]
    texts += [word(30) + shared[50:400] + word(30) for _ in range(6)]
    edited = word(200)
    for i in range(30):
        k = rng.integers(len(edited))
        texts.append(edited[:k] + "#" + str(i) + edited[k + 1:])
    texts += [texts[0], texts[0], "ab" * 500, "x" * 199, "x" * 200, "x" * 201, word(3), "", None, word(100) + "same start" + word(100)]
    return texts + [texts[-1][:700], word(200)]


@pytest.mark.parametrize("most", [16384, 8])
def test_repeats_equal_brute_force(docs_of, most, monkeypatch):
    texts = byte_cases()
    plain = suffix_dedup.repeated_stretches
    monkeypatch.setattr(suffix_dedup, "repeated_stretches", lambda d: plain(d, batch=64, max_pieces=most))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_report(docs_of(list(enumerate(texts)))).collect()}
    for i, want in enumerate(repeats(texts)):
        assert got[i] == want, i


def test_repeated_rows_and_null_ids(docs_of):
    t, u = "words of one text " * 30 + "q", "other words in here, " * 3 + "unlike the rest of them all " * 9
    rows = [(1, t), (1, t), (None, u), (None, u + "!"), (None, "short")]
    got = sorted((tuple(r) for r in suffix_dedup.removal_report(docs_of(rows)).collect()), key=repr)
    assert got == sorted(((i, *w) for (i, _), w in zip(rows, repeats([t for _, t in rows]))), key=repr)
    assert suffix_dedup.removal_report(docs_of([])).count() == 0


def test_column_order_equals_sorted_suffixes(tmp_path):
    rng = np.random.default_rng(1)
    for n in range(20):
        texts = [rng.integers(97, 98 + n % 4, rng.integers(1, 30)).astype(np.uint8) for _ in range(rng.integers(1, 9))]
        bwt, lcp = suffix_dedup.suffix_order(texts, str(tmp_path))
        order = sorted(([*t[k:].tolist(), i - len(texts)], i, k) for i, t in enumerate(texts) for k in range(len(t) + 1))
        assert bwt.tolist() == [255 if k == 0 else texts[i][k - 1] for _, i, k in order]
        same = lambda a, b: next((x for x in range(min(len(a), len(b))) if a[x] != b[x]), min(len(a), len(b)))
        assert lcp.tolist() == [0] + [same(order[x - 1][0], order[x][0]) for x in range(1, len(order))]


def test_registered(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for q in ("op6_ngram_jaccard", "op8_line_dedup", "op9_suffix_dedup"):
        assert queries.QUERIES[q](spark, sf_dir).count() == n
