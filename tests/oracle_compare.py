"""Spark result vs DuckDB oracle: row count, column names/types, values.

Mirrors the driver's check (order-insensitive, columns sorted by name) but
compares exact values so any rounding drift shows up.
Run directly: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _spark_type(dt) -> str:
    s = dt.simpleString()
    return {"int": "int32", "bigint": "int64", "double": "float64", "string": "string",
            "boolean": "bool", "date": "date", "timestamp_ntz": "timestamp", "timestamp": "timestamp",
            "smallint": "int16", "tinyint": "int8", "float": "float32"}.get(s, s)


def _duck_type(t: str) -> str:
    t = str(t).upper()
    return {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "string",
            "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp", "SMALLINT": "int16",
            "TINYINT": "int8", "FLOAT": "float32"}.get(t, t.lower())


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (1, repr([_norm(x) for x in v]))
    return (1, repr(v))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_schema = {f.name: _spark_type(f.dataType) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = [f.name for f in sdf.schema.fields]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_types = {d[0]: _duck_type(d[1]) for d in rel.description}
    d_rows = rel.fetchall()
    t2 = time.time()
    msgs = []
    if sorted(s_cols) != sorted(d_cols):
        msgs.append(f"columns differ: spark-only {sorted(set(s_cols)-set(d_cols))} "
                    f"oracle-only {sorted(set(d_cols)-set(s_cols))}")
        return False, "; ".join(msgs)
    bad_types = {c: (s_schema[c], d_types[c]) for c in s_cols if s_schema[c] != d_types[c]}
    if bad_types:
        msgs.append(f"types differ: {bad_types}")
    if len(s_rows) != len(d_rows):
        msgs.append(f"rows differ: spark {len(s_rows)} oracle {len(d_rows)}")
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sk = sorted(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dk = sorted(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if sk != dk:
        diffs = 0
        example = None
        sset, dset = set(sk), set(dk)
        for r in sk:
            if r not in dset:
                diffs += 1
                if example is None:
                    example = r
        col_diff = []
        if example is not None:
            # closest oracle row by shared columns, to name the differing columns
            best = max(dk, key=lambda d: sum(a == b for a, b in zip(example, d)), default=None)
            if best is not None:
                col_diff = [(order[i], example[i][1], best[i][1]) for i in range(len(order))
                            if example[i] != best[i]][:6]
        msgs.append(f"values differ in {diffs} spark rows; e.g. {col_diff}")
    ok = not msgs
    return ok, (f"{len(s_rows)} rows spark {t1-t0:.1f}s duck {t2-t1:.1f}s" if ok else "; ".join(msgs))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from larder.session import local_session
    import __spark_entry__ as E
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    failed = []
    for name in (names or list(qs)):
        if name not in sqls:
            try:
                n = qs[name](spark, sf_dir).count()
                print(f"[rows-only] {name}: {n} rows")
            except Exception as e:  # noqa: BLE001
                failed.append(name)
                print(f"[FAIL] {name}: {type(e).__name__}: {str(e)[:300]}")
            continue
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        print(f"[{'ok' if ok else 'FAIL'}] {name}: {msg}", flush=True)
        if not ok:
            failed.append(name)
    print(f"\n{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
