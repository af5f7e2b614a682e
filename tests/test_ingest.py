"""By-name CSV ingest, rescue and inferred types on hand-made files."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql.types import _parse_datatype_string

from larder.streaming import by_name as B
from larder.streaming.infer import BELOW, WRITTEN_AS, infer_types, join

SCHEMA = "id string, name string, amount double"


@pytest.fixture
def landing(tmp_path):
    src = tmp_path / "src"
    src.mkdir()

    def put(name, text):
        (src / name).write_text(text, encoding="utf-8")

    def take(spark, schema=SCHEMA, **how):
        table = B.ingest_csv(spark, str(src), str(tmp_path / "table"), str(tmp_path / "ck"),
                             _parse_datatype_string(schema) if schema else None, **how)
        return table
    return put, take, tmp_path


def by_id(table, key="id"):
    return {r[key]: r for r in table.collect()}


def test_reordered_and_surplus_columns(spark, landing):
    put, take, _ = landing
    put("a.csv", "id,name,amount\nx,1,1.5\n")
    put("b.csv", "name,id,amount,extra\n2,y,3.5,z\n")
    put("c.csv", "amount,name\n7,n\n")
    got = take(spark, with_file_name=True)
    rows = {r.source_file: r for r in got.collect()}
    assert (rows["a.csv"].id, rows["a.csv"].name, rows["a.csv"].amount, rows["a.csv"]._rescued_data) == ("x", "1", 1.5, None)
    assert (rows["b.csv"].id, rows["b.csv"].name, rows["b.csv"].amount) == ("y", "2", 3.5)
    assert json.loads(rows["b.csv"]._rescued_data) == {"extra": "z"}
    assert (rows["c.csv"].id, rows["c.csv"].name, rows["c.csv"].amount) == (None, "n", 7.0)
    assert json.loads(rows["c.csv"]._rescued_data) == {"id": None}


def test_records_longer_and_shorter_than_their_header(spark, landing):
    put, take, _ = landing
    many = ",".join(str(i) for i in range(40))
    put("a.csv", f"id,name,amount\na,1,2\nb,1,2,more,,again\nc,1\nd,1,2,{many}\n\ne,1,x\n")
    got = {k: r._rescued_data and json.loads(r._rescued_data) for k, r in by_id(take(spark)).items()}
    assert got == {"a": None, "b": {"_c3": "more", "_c5": "again"}, "c": {"_record": "c,1"},
                   "d": {"_record": f"d,1,2,{many}"}, "e": {"amount": "x"}}


def test_odd_headers(spark, landing):
    put, take, _ = landing
    put("a.csv", "﻿id, name ,ID,id,,amount\nx,n,up,again,blank,4\n")
    put("empty.csv", "")
    put("header[1].csv", "id,name,amount\n")
    put("q{1}.csv", 'amount,"na\nme",id,name\n1,2,y,"a,\nb"\n')
    got = by_id(take(spark, options={"multiLine": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false"}))
    assert (got["x"].name, got["x"].amount) == ("n", 4.0)
    assert json.loads(got["x"]._rescued_data) == {"ID": "up", "id_2": "again", "_c4": "blank"}
    assert (got["y"].name, json.loads(got["y"]._rescued_data)) == ("a,\nb", {"na\nme": "2"})
    assert set(got) == {"x", "y"}


def test_every_file_is_taken_once_in_batches(spark, landing):
    put, take, tmp = landing
    for i in range(7):
        put(f"f{i}.csv", f"id,name,amount\n{i},n,{i}\n" if i % 2 else f"amount,id,name\n{i},{i},n\n")
    assert take(spark, files_at_once=3).count() == 7
    put("late.csv", "id,name,amount\n99,n,9\n")
    table = take(spark, files_at_once=3)
    assert sorted(int(r.id) for r in table.collect()) == [*range(7), 99]
    assert take(spark).count() == 8
    assert B.read_ingested(spark, str(tmp / "table"), 3).select("id").collect()[0].id == "99"


def test_a_batch_run_again_replaces_its_rows(spark, landing, monkeypatch):
    put, take, tmp = landing
    put("a.csv", "id,name,amount\n1,n,1\n")
    real, fails = B.read_group, [True]

    def broken(*args, **kw):
        if fails:
            fails.pop()
            raise OSError("lost")
        return real(*args, **kw)

    monkeypatch.setattr(B, "read_group", broken)
    with pytest.raises(Exception, match="lost"):
        take(spark)
    assert take(spark).count() == 1


def test_inferred_types_are_stored_and_used_again(spark, landing):
    put, take, tmp = landing
    put("a.csv", "n,d,day,at,code,flag,none\n1,1,2024-01-02,2024-01-02 10:00:00,007,true,\n-2,2.5,2024-02-30,2024-01-02,8,FALSE,\n")
    put("b.csv", "day,n,more\n2024-03-01,3,x\n")
    table = take(spark, schema=None)
    assert dict(table.dtypes) == {"n": "bigint", "d": "double", "day": "string", "at": "timestamp_ntz", "code": "string",
                                  "flag": "boolean", "none": "string", "more": "string", "_rescued_data": "string"}
    put("c.csv", "n,d,new\nfour,1e3,1\n")     # a restart: types are those of the first batch
    table = take(spark, schema=None)
    assert dict(table.dtypes)["n"] == "bigint"
    late = table.where("d = 1000").first()
    assert late.n is None and json.loads(late._rescued_data)["n"] == "four" and json.loads(late._rescued_data)["new"] == "1"
    assert B.stored_schema(spark, str(tmp / "ck-schema")).names == ["n", "d", "day", "at", "code", "flag", "none", "more"]


@pytest.mark.parametrize("values,kind", [
    (["1", "+2", "-3"], "bigint"), (["1", "9223372036854775808"], "double"), (["1", ".5", "2."], "double"), (["1e5"], "double"),
    (["007"], "string"), (["1", "2024-01-01"], "string"), (["2024-01-01"], "date"), (["2024-02-30"], "string"),
    (["2024-01-01", "2024-01-01T10:00"], "timestamp_ntz"), (["2024-01-01T10:00:00.123Z", "2024-01-01"], "timestamp"),
    (["true", "False"], "boolean"), (["true", "1"], "string"), ([None, None], "null"), ([None, "4"], "bigint"), (["", "4"], "string"),
    (["NaN"], "string"), (["1f"], "string"), ([" 1"], "string"),
])
def test_inferred_type(spark, values, kind):
    assert infer_types(spark.createDataFrame([(v,) for v in values], "`a b.c` string")) == {"a b.c": kind}


def test_types_form_a_lattice(spark):
    kinds = ["null", *WRITTEN_AS, "string"]
    for a in kinds:
        assert join(a, a) == a and join("null", a) == a and join(a, "string") == "string"
        for b in kinds:
            assert join(a, b) == join(b, a)
            for c in kinds:
                assert join(join(a, b), c) == join(a, join(b, c))
    assert set(BELOW) == set(WRITTEN_AS)
    # the type of values together is the join of their types
    words = {"bigint": "12", "double": "1.5", "date": "2024-01-01", "timestamp_ntz": "2024-01-01 10:00:00", "boolean": "true", "string": "x",
             "timestamp": "2024-01-01 10:00:00Z"}
    rng = random.Random(1)
    cases = [rng.sample(sorted(words), 2) for _ in range(12)]
    wide = spark.createDataFrame([tuple(words[c[i]] for c in cases) for i in (0, 1)], ", ".join(f"c{i} string" for i in range(len(cases))))
    assert list(infer_types(wide).values()) == [join(a, b) for a, b in cases]


def test_no_rows_no_table_rows(spark, landing):
    put, take, _ = landing
    put("a.csv", "id,name,amount\n")
    assert take(spark).count() == 0


def test_dates_keep_their_day(spark, landing):
    put, take, _ = landing
    put("a.csv", "id,day\n1,2024-01-02\n")
    assert take(spark, schema="id long, day date").first().day == dt.date(2024, 1, 2)
