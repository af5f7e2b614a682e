"""Operators 2, 3, 7, 10 and the pipeline."""

import html
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest

from larder.llm import hilbert, html_text, quality, queries, tiling


# ---------------------------------------------------------------- shards

def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims), -1).reshape(-1, dims)
        index = hilbert.hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(side**dims))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_shards(rows, got, shards=8):
    assert len(got) == len(rows)
    count = Counter(r.shard for r in got)
    assert max(count.values()) - min([count[s] for s in range(shards)]) <= 1
    for s, n in count.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    sizes = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == sizes


def test_shards(docs_of):
    rows = [(i, "é" * (i % 50), f"s{i % 3}") for i in range(203)] + [(None, None, None), (5, "same", "s"), (5, "same", "s")]
    check_shards(rows, hilbert.document_shards(docs_of(rows)).collect())
    few = [(1, "a"), (2, None)]
    check_shards(few, hilbert.document_shards(docs_of(few)).collect())
    assert hilbert.document_shards(docs_of([])).count() == 0


def slow_index(point, bits):
    """Hilbert index of one point, by walking the curve's quadrants (two dimensions at a time can't do three: bit by bit)."""
    x, n = list(point), len(point)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0], x[i] = x[0] ^ t, x[i] ^ t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = 0
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        if x[-1] & q:
            t ^= q - 1
    x = [v ^ t for v in x]
    return int("".join(str(v >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def slow_shards(rows, shards):
    """(doc_id, shard, slot) from sorting all rows by the index of exact cells."""
    def cells(values):
        ordered = sorted(v for v in values if v is not None)
        first = {}
        for i, v in enumerate(ordered):
            first.setdefault(v, i)
        return lambda v: 0 if v is None else first[v] * 256 // len(ordered)

    lang, source = cells([r[1] for r in rows]), cells([r[2] for r in rows])
    order = sorted((slow_index((lang(r[1]), source(r[2])), 8), r[0]) for r in rows)
    out, total = set(), len(order)
    for pos, (_, doc) in enumerate(order):
        s = pos * shards // total
        out.add((doc, s, pos - -(-s * total // shards)))
    return out


def test_shards_equal_a_slow_sort(spark):
    rows = [(i, f"lang{(i * i) % 5}" if i % 9 else None, f"https://site{(i * 7) % 16}.org") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, lang string, source string").repartition(3)
    got = hilbert.shard_rows(df, ["lang", "source"], ["id"], 8).collect()
    assert {(r.id, r.shard, r.slot) for r in got} == slow_shards(rows, 8)


def test_strings_with_a_common_start_shard_like_short_ones(spark):
    """Sources are told apart by their whole names: a shard holds few of them, whatever the names begin with."""
    of = {}
    for form in ("{:02d}", "https://www.a-very-long-common-name.example.org/site{:02d}"):
        rows = [(i, form.format(i % 16), i * 37 % 1600) for i in range(1600)]
        df = spark.createDataFrame(rows, "id long, source string, n long")
        of[form] = {(r.id, r.shard) for r in hilbert.shard_rows(df, ["source", "n"], ["id"], 8).select("id", "shard").collect()}
        held = Counter(s for s, _ in {(s, i % 16) for i, s in of[form]})
        assert max(held.values()) <= 8
    assert len(set(map(frozenset, of.values()))) == 1


def test_shards_prune(spark, sf_dir):
    placed = queries.QUERIES["op2_hilbert_shards"](spark, sf_dir)
    ranges = hilbert.shard_ranges(placed, ["lang", "n_chars"]).collect()
    # a shard holds part of the languages or of the lengths
    full = max(r.max_n_chars for r in ranges) - min(r.min_n_chars for r in ranges)
    assert any(r.min_lang == r.max_lang or r.max_n_chars - r.min_n_chars < full / 2 for r in ranges)


# ---------------------------------------------------------------- pages

def test_main_text_of_pages(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.QUERIES["op3_html_main_text"](spark, sf_dir).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"<(?:p|h1|br|/p|/h1)>", body)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("<script>var a='<p>x</p>'</script>", ""),
    ("<body><header><h1>Site</h1></header><main><p>One &amp;lt; two&nbsp;&eacute;.</p><!-- <p>no</p> --><p>A\n\t b</p></main>"
     "<aside><p>Side words</p></aside><section class='comments'><p>I like it very much indeed.</p></section><footer>c</footer></body>",
     "One &lt; two é.\nA b"),
    ("<article><p>Open <b>bold<br><p>Next</article><footer>foot", "Open bold\nNext"),
    ("<div class='cookie-banner'>We set cookies here.</div><article><p>Text <a href='#'>link</a> end.</p><form>Name <input></form>"
     "<div class=advert>Buy this</div><ul><li>Item</li></ul></article>", "Text link end.\nItem"),
    ("<article><p>a</p><article class='comment'><p>hello there</p></article><p>b</p></article>", "a\nb"),
    ("<article><p title=\"x>y\">q</p></div></span><p>r</p>", "q\nr"),
    ("<body class='has-sidebar'><article class='post with-comments'><p>Kept.</p></article></body>", "Kept."),
])
def test_odd_pages(page, text):
    assert html_text.main_texts([page]) == [text]


def test_raw_elements_without_an_end_keep_the_page():
    rest = "The river rose in the night and the fields stood under water until noon that day."
    for odd in ('<svg class="i" viewBox="0 0 1 1"/>', "<svg />", "<noscript>", "<template>", "<iframe src='x'/>", "<iframe src='x'>"):
        page = f"<body><article><p>{rest}</p>{odd}<p>{rest} Again.</p><p>{rest} End.</p></article></body>"
        assert html_text.main_texts([page]) == [f"{rest}\n{rest} Again.\n{rest} End."], odd
    page = f"<body><article><p>{rest}</p><svg/><p>{rest} Again.</p><svg><text>No</text></svg><p>{rest} End.</p></article></body>"
    assert html_text.main_texts([page]) == [f"{rest}\n{rest} Again.\n{rest} End."]
    assert html_text.main_texts([f"<article><p>{rest}</p><script>var x = 1;"]) == [rest]


def labelled(seed, number=120):
    """(blocks, marks) of labelled pages, the marks taken off the texts."""
    for page in html_text.labelled_pages(number, seed):
        found = html_text.blocks(page)
        marks = [b.text[0] == "+" for b in found]
        for b in found:
            b.text = b.text[1:]
        yield found, marks


def test_tree_tells_pages_it_was_not_grown_on():
    tree, wrong, total = html_text.trained_tree(), 0, 0
    for found, marks in labelled(99):
        share = html_text.classify(tree, html_text.features(found))
        wrong, total = wrong + int(((share >= 0.5) != np.array(marks)).sum()), total + len(marks)
    assert total > 1000 and wrong <= 0.01 * total

    def used(t):
        return {html_text.FEATURES[t[0]]} | used(t[2]) | used(t[3]) if len(t) > 1 else set()

    assert {"density", "around", "talk", "article"} <= used(tree)


def some_words(n):
    return " ".join(f"word{i}" for i in range(n))


@pytest.mark.parametrize("page, lines", [
    # no element or class around the article: short and last paragraphs stay, link lists and closing formulas go
    (f"<body><p>Yes.</p><p>{some_words(21)}.</p><p>No.</p>", 3),
    ("<body>" + "".join(f"<p>{some_words(n)}</p>" for n in (30, 5, 45, 3, 80)), 5),
    (f"<body><p>{some_words(30)}</p><p>{some_words(12)}</p>", 2),
    ("<body><ul>" + "".join(f"<li><a href=x>All of our news from the year {1990 + i}</a></li>" for i in range(24)) + f"</ul><p>{some_words(40)}</p><p>Copyright 2001</p>", 1),
    # names of layouts, of places in the text, and words that hold a hint
    (f'<body><div class="layout sidebar-right"><p>{some_words(40)}</p><p>{some_words(50)}</p></div>', 2),
    (f'<body><div class="has-header side-nav-layout"><p>{some_words(40)}</p><p>{some_words(50)}</p></div>', 2),
    (f'<article><p>{some_words(20)}</p><p id="tags">{some_words(8)}</p><p class="share-price">{some_words(9)}</p>'
     f'<figure><figcaption>A caption</figcaption></figure><h2 id="search-and-rescue">Head</h2><p>{some_words(30)}</p></article>', 6),
    (f'<article><div class="post-header"><h1>Title</h1></div><p>{some_words(30)}</p></article>', 2),
    # attributes: words inside values, quotes inside unquoted ones
    (f'<article><p title="the hidden valley">{some_words(30)}</p><p title=don\'t>It\'s {some_words(20)}</p><p>It\'s</p></article>', 3),
    (f'<article><p title="open>{some_words(9)}</p><p>{some_words(4)}</p></article>', 2),
    # notices and forms around and inside the article go
    (f'<body><div class="cookie-notice">{some_words(9)}</div><p>{some_words(40)}</p><form>{some_words(5)}</form><div class="related-posts"><p>{some_words(8)}</p></div>', 1),
])
def test_pages_of_other_sites(page, lines):
    assert len(html_text.main_texts([page])[0].split("\n")) == lines


def test_extract_rows(spark):
    rows = [(1, "u", "<article><p>" + "word " * 50000 + "</p></article>", 1), (None, None, None, 2), (1, "u", "", 3), (1, "u", "", 3)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 0, 249999]
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---------------------------------------------------------------- quality

def test_held_out_accuracy(spark, sf_dir):
    got = {r.doc_id: r for r in queries.QUERIES["op7_quality_pu"](spark, sf_dir.replace("sf0.001", "sf0.01")).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    test = [(got[i].predicted, y) for i, y in labels.items() if i in got and got[i].held_out]
    assert np.mean([p == y for p, y in test]) >= 0.95
    assert np.mean([p for p, y in test if y == 1]) >= 0.98  # clean documents stay


def test_held_out_labels_are_not_read(spark, docs_of):
    docs = docs_of([(i, ("Some plain words, one by one. " if i % 4 else "x | y | $$$ %%% ") * 5 + str(i)) for i in range(60)] + [(None, None), (3, ""), (3, "")])
    labels = lambda flip: spark.createDataFrame(
        [(i, int(bool(i % 4)) ^ (flip and zlib.crc32(str(i).encode()) % 5 == 0)) for i in range(60)] + [(None, 1), (5, None), (7, 0)], "doc_id long, quality int")
    a, b = (sorted(((r.doc_id, r.score) for r in quality.scored(docs, labels(f)).collect()), key=repr) for f in (False, True))
    assert a == b and len(a) == 63


def test_quality_without_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.scored(docs_of([(1, "a b"), (2, None)]), none).collect()
    assert len({r.score for r in got}) == 1 and {r.predicted for r in got} == {1}
    assert quality.scored(docs_of([]), none).count() == 0
    docs = docs_of([(1, "a"), (1, "a")])
    assert quality.keep_good(docs, none).columns == docs.columns


def test_risk_stays_non_negative():
    rng = np.random.default_rng(0)
    pos, unl = rng.normal(1, 1, (300, 4)), np.r_[rng.normal(1, 1, (400, 4)), rng.normal(-2, 1, (200, 4))]
    model = quality.fit(pos, unl, 0.66)
    assert model.score(rng.normal(1, 1, (500, 4))).mean() > 0.8 and model.score(rng.normal(-2, 1, (500, 4))).mean() < 0.2


# ---------------------------------------------------------------- decontamination

def slow_tiles(item, doc, least):
    least, free_i, free_d, out = min(least, len(item)), [True] * len(item), [True] * len(doc), []
    while least:
        best = None
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and free_i[i + n] and free_d[d + n]:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (i, d, n)
        if best is None:
            break
        out.append(best)
        for k in range(best[2]):
            free_i[best[0] + k] = free_d[best[1] + k] = False
    return out


def test_tiles_equal_slow_tiling():
    rng = np.random.default_rng(4)
    for n in range(150):
        item, doc = (rng.integers(0, 2 + n % 4, rng.integers(0, size)).astype(np.uint64) for size in (14, 30))
        assert tiling.tile(item, doc, 3) == slow_tiles(item.tolist(), doc.tolist(), 3)


def test_contamination_equals_brute_force(spark, docs_of):
    rng = np.random.default_rng(6)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 60, n)]
    items = [word(n) for n in (2, 4, 5, 12, 20, 30, 30)] + [[]]
    docs = []
    for i in range(60):
        d, x = word(rng.integers(0, 80)), items[i % 7]
        if i % 3 == 0:
            half = len(x) // 2
            d = d[:10] + x[half:] + d[10:15] + x[:half] + d[15:]  # reordered
        docs.append((i, " ".join(d).upper() if i % 2 else ", ".join(d)))
    docs += [(None, " ".join(items[4])), (3, " ".join(items[5])), (3, " ".join(items[5])), (99, None), (98, ""), (97, "x " * 30000 + " ".join(items[6]))]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(4, " ".join(items[4])), (50, None), (51, "")], "item_id long, text string")
    number = lambda t: [int.from_bytes(w.encode(), "big") for w in re.findall(r"\w+", (t or "").lower())]
    want = []
    for i, t in docs:
        d, hit = number(t)[-200:], []
        for j, x in enumerate(items):
            x = number(" ".join(x))
            if x and sum(n for *_, n in slow_tiles(x, d, 5)) / len(x) >= 0.6:
                hit.append(j)
        want.append((i, hit))
    for options in ({}, {"max_filter_slots": 0}):  # with the seed filter and beyond its size
        got = tiling.document_report(docs_of(docs), bench, **options).collect()
        assert sorted(((r.doc_id, r.item_ids) for r in got), key=repr) == sorted(want, key=repr)
    table = docs_of(docs)
    kept = tiling.drop_contaminated(table, bench)
    assert kept.columns == table.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, h in want if not h), key=repr)


def test_no_documents_or_items(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in tiling.document_report(docs_of([(1, "a b c d e f")]), none).collect()] == [False]
    assert tiling.document_report(docs_of([]), none).count() == 0


def test_benchmark_items_without_an_id_count(spark, docs_of):
    passage, other = "the cat sat on the mat and looked at the moon", "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(None, passage), (None, other), (4, passage), (None, None)], "item_id long, text string")
    docs = docs_of([(1, f"so {passage} again"), (2, f"count {other}"), (3, "nothing of it in here at all"), (None, other)])
    got = {r.doc_id: (r.contaminated, r.n_items, r.max_coverage, r.item_ids) for r in tiling.document_report(docs, bench).collect()}
    assert got == {1: (True, 2, 1.0, [None, 4]), 2: (True, 1, 1.0, [None]), 3: (False, 0, 0.0, []), None: (True, 1, 1.0, [None])}
    assert [r.doc_id for r in tiling.drop_contaminated(docs, bench).collect()] == [3]


def test_leaks_in_the_documents(spark, sf_dir):
    d = sf_dir.replace("sf0.001", "sf0.01")
    plain = lambda t: f" {' '.join(re.findall(r'\w+', (t or '').lower()))} "
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()}
    docs = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in queries.QUERIES["op10_benchmark_tiling"](spark, d).collect():
        assert {j for j, t in items.items() if t in docs[r.doc_id]} <= set(r.item_ids)


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "tokens"]
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
    final = corpus_pipeline.run(spark, sf_dir).collect()
    assert 0 < len(final) < len(ids) and {r.doc_id for r in final} <= ids
    assert all(r.n_tokens == len(r.ids) for r in final)


def test_pipeline_stages_take_empty_tables(spark, tmp_path, docs_of):
    docs_of([], False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_contamination_with_text_ids(spark):
    passage = "the quick brown fox jumps over the lazy dog near the quiet river bank"
    docs = spark.createDataFrame([("doc-1", f"intro {passage} outro"), ("doc-2", "nothing of the kind here"), (None, passage)], "doc_id string, text string")
    items = spark.createDataFrame([("gsm8k-1", passage), ("gsm8k-2", "another text that no document has in it")], "item_id string, text string")
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in tiling.document_report(docs, items).collect()}
    assert got == {"doc-1": (True, ["gsm8k-1"]), "doc-2": (False, []), None: (True, ["gsm8k-1"])}
    assert [r.doc_id for r in tiling.drop_contaminated(docs, items).collect()] == ["doc-2"]


def test_quality_of_repeated_ids_does_not_depend_on_partitions(spark):
    rows = [(i, f"{'good clean prose with many different words' if i % 2 else 'zz zz zz ## ## zz'} {i} " * 5) for i in range(300)]
    rows += [(7, "zz"), (8, "another text of the same id with words")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 300, 3)], "doc_id long, quality int")
    scores = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, "text")
        model = quality.train(docs, labels)
        scores.append(model.score(quality.feature_matrix(["good clean prose", "zz ##", ""])))
    assert np.allclose(*scores, atol=1e-12)
