"""Operator 13 against a loop over documents and orders."""

import re
from itertools import permutations

import numpy as np

from larder.llm import filter_audit as fa

LABELS = "doc_id long, quality int, toxic int"
COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(rows, labels):
    texts = {}
    for d, x, s in rows:
        if d is not None:
            texts[x or ""] = min(d, texts.get(x or "", d))
    good, toxic = ({d for d, *v in labels if v[i] == 1 and d is not None} for i in (0, 1))
    docs = {}
    for d, x, s in rows:
        x, words = x or "", re.findall(r"[^\x20\x09-\x0D]+", x or "")
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", x)) > 2 * len(x),
                 "D": bool(re.search(r"[#$%&*|]", x)), "E": d is not None and texts[x] < d}
        docs.setdefault(s or "", []).append((d, {f for f, bad in fails.items() if bad}))
    out = set()
    for part, held in docs.items():
        removed, rows_ = {}, []
        for order in permutations("ABCDE"):
            left = held
            for i, f in enumerate(order):
                gone = [(d, b) for d, b in left if f in b]
                earlier = sum(f in b for _, b in held) - len(gone)
                left = [(d, b) for d, b in left if f not in b]
                removed[f] = removed.get(f, 0) + len(gone)
                rows_.append((part, "".join(order), i + 1, len(left), len(gone), earlier, sum(b == {f} for _, b in held),
                              sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), f))
        out |= {(*r[:-1], removed[r[-1]]) for r in rows_}
    return out


def audit(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "z", 1, "m") for r in rows], "doc_id long, text string, source string, words string, n int, mask string")
    marks = spark.createDataFrame([(*r, "z") for r in labels], LABELS + ", part string")
    return {tuple(r) for r in fa.filter_interactions(docs.repartition(3), marks).select(*COLS).collect()}


def test_equals_brute_force(spark):
    long = " ".join(f"w{i}" for i in range(250))
    texts = [long, long, long + " # x", long.upper(), "AB cd", "a a a a", "", None, "x " * 300, "Ä|", long, " ", "w" * 100_000]
    rows = [(i, x, ["a", "b", None, ""][i % 4]) for i, x in enumerate(texts * 4)] + [(None, long, "a"), (3, long.upper(), ""), (3, long.upper(), "")]
    labels = [(0, 1, 0), (1, 0, 1), (2, 1, 1), (4, None, None), (4, 1, 0), (None, 1, 1), (5, 0, 1), (7, 1, 1), (999, 1, 1), (3, 1, 0), (3, 1, 0)]
    got = audit(spark, rows, labels)
    assert got == brute(rows, labels)
    assert len(got) == 3 * 600


def test_empty_tables(spark):
    assert audit(spark, [], [(1, 1, 1)]) == set()
    assert audit(spark, [(1, "A", "s")], []) == brute([(1, "A", "s")], [])


def test_removal_steps_are_the_first_failing_position():
    orders = np.array(list(permutations(range(4))))
    fails = (np.arange(16)[:, None] >> np.arange(4)) & 1 == 1
    got = fa.removal_steps(fails, orders)
    for m in range(16):
        for o, order in enumerate(orders):
            assert got[m, o] == next((i + 1 for i, f in enumerate(order) if fails[m, f]), 5)
