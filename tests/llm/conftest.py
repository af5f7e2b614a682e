import pytest

#: Names the operators use for columns of their own.
CLASHES = ["id", "key", "node", "comp", "component", "host", "bad", "pages", "line", "hilbert", "shard", "slot", "_pos", "_total",
           "seed", "item", "n", "text_key", "doc", "tag", "gram", "h1", "y", "x", "sig", "label", "ids", "repeats", "__page", "__doc"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """(doc_id, text[, source]) tuples -> a table like ``documents``, with further columns of clashing names."""
    def make(rows, clash=True):
        names = CLASHES if clash else []
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in names)
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1]), *["z"] * len(names)) for r in rows]
        return spark.createDataFrame(full, schema)
    return make
