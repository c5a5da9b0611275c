"""Readers and writers: round trips, files cut in byte ranges, and what does not fit."""

import json
import os
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from bibliospark.schemas import AUTHORS
from bibliospark.sources import (
    MalformedFile,
    append_conformed,
    append_rejects,
    load_csv,
    load_indexed_json,
    load_jsonl,
    load_staging,
    load_staging_rejects,
    read_csv_table,
    read_indexed_json,
    read_jsonl,
    staging_ddl,
    write_csv_table,
    write_documents,
    write_indexed_json,
)
from bibliospark.sources.files import CSV_OPTIONS
from bibliospark.sources.splits import CsvEnds, records

FAILS = (PySparkException, Py4JJavaError)  # readers raise the latter
NOTE = "id bigint, name string, n int, tags array<string>, inner struct<a:string,b:array<struct<c:int>>>"


@pytest.fixture()
def tiny_splits(spark):
    """Byte ranges of a few dozen bytes, so that everything reaches over their ends."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]

    def use(n):
        for name in names:
            spark.conf.set(name, str(n))

    yield use
    for name in names:
        spark.conf.unset(name)


def schema_of(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_keeps_blanks(spark, tmp_dir):
    df = spark.createDataFrame([(0, "Smith", "John "), (1, "Brown", " "), (2, "Garcia", None)], AUTHORS)
    path = os.path.join(tmp_dir, "authors_csv")
    write_csv_table(df, path)
    same(read_csv_table(spark, path, AUTHORS), df)


def test_json_csv_parquet_round_trip(spark, tmp_dir):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    for fmt in ("json", "parquet", "csv"):
        path = os.path.join(tmp_dir, f"part_{fmt}")
        if fmt == "csv":
            write_csv_table(part, path)
            back = read_csv_table(spark, path, part.schema)
        else:
            write_documents(part, path, fmt=fmt)
            back = read_jsonl(spark, path, part.schema) if fmt == "json" else spark.read.parquet(path)
        same(back, part)


def test_staging_ddl(spark):
    df = spark.createDataFrame([(1, "a")], "author_id bigint, Surname string")
    assert staging_ddl(df, "t") == "CREATE TABLE t (`author_id` BIGINT, `Surname` STRING)"


# --- index-keyed JSON ---


def notes(rng, n):
    """Entries whose strings hold braces, quotes, backslashes and line breaks."""
    bits = ["{", "}", "}}", '"', "\\", '\\"', "\n", ",", ":", "[", "]", "é", "日本", " ", "word", " "]
    word = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
    out = {}
    for i in rng.sample(range(10 * n), n):
        inner = None if rng.random() < 0.2 else {"a": word(), "b": [{"c": rng.randrange(9)} for _ in range(rng.randrange(3))]}
        out[str(i)] = {"id": "own", "name": word() or None, "n": rng.randrange(99), "tags": [word() for _ in range(rng.randrange(3))], "inner": inner}
    return out


def plain_read(spark, path, schema):
    """One task per file: what the split reader must equal."""
    fields = [f for f in schema.fields if f.name != "id"]
    kind = schema_of(spark, "x int")
    kind.fields, kind.names = fields, [f.name for f in fields]
    m = F.from_json("value", MapType(StringType(), kind))
    raw = spark.read.text(path, wholetext=True).select(F.explode(m).alias("k", "v"))
    return raw.select(F.col("k").cast("bigint").alias("id"), *[F.col("v")[f.name].alias(f.name) for f in fields])


@pytest.mark.parametrize("size", [7, 64, 1000])
@pytest.mark.parametrize("indent", [None, 2])
def test_indexed_json_is_split(spark, tmp_dir, tiny_splits, size, indent):
    rng = random.Random(size)
    schema = schema_of(spark, NOTE)
    os.mkdir(folder := os.path.join(tmp_dir, "json"))
    put(folder, "a.json", json.dumps(notes(rng, 12), indent=indent, ensure_ascii=False))
    put(folder, "b.json", " \n" + json.dumps(notes(rng, 5), indent=indent) + "\n \n")
    put(folder, "c.json", "{}")
    put(folder, "d.json", "{ }\n")
    want = plain_read(spark, folder, schema)
    tiny_splits(size)
    got = read_indexed_json(spark, folder, schema)
    assert got.count() == 17
    same(got, want)


def test_indexed_json_is_many_tasks(spark, tmp_dir, tiny_splits):
    path = put(tmp_dir, "one.json", json.dumps({str(i): {"name": "x" * 50} for i in range(2000)}))
    tiny_splits(20_000)
    df = read_indexed_json(spark, path, schema_of(spark, "id bigint, name string"))
    assert df.count() == 2000 and df.agg(F.sum("id")).first()[0] == 1999 * 1000
    assert df.select(F.spark_partition_id()).distinct().count() > 5


@pytest.mark.parametrize("size", [16, 100_000])
def test_truncated_json_raises(spark, tmp_dir, tiny_splits, size):
    tiny_splits(size)
    whole = json.dumps({"0": {"name": "a}b"}, "1": {"name": 'c"d'}})
    schema = schema_of(spark, "id bigint, name string")
    assert read_indexed_json(spark, put(tmp_dir, "whole.json", whole), schema).count() == 2
    for cut in [1, 5, 12, len(whole) // 2, len(whole) - 3, len(whole) - 2, len(whole) - 1]:
        path = put(tmp_dir, f"cut{cut}-{size}.json", whole[:cut])
        with pytest.raises((MalformedFile, PySparkException)):
            read_indexed_json(spark, path, schema).collect()
    for i, bad in enumerate([whole + "}", whole + "x", "[1, 2]", '"text"', "{'a': 1}"]):
        with pytest.raises((MalformedFile, PySparkException)):
            read_indexed_json(spark, put(tmp_dir, f"bad{i}-{size}.json", bad), schema).collect()


def test_json_entries_that_do_not_fit(spark, tmp_dir):
    text = '{"0": {"name": "a", "n": 1}, "x": {"name": "b", "n": 2}, "2": {"name": "c", "n": "many"}, "3": null, "4": 5, "5": {"n": 6}}'
    schema = schema_of(spark, "id bigint, name string, n int")
    path = put(tmp_dir, "odd.json", text)
    with pytest.raises(PySparkException, match="bad record"):
        read_indexed_json(spark, path, schema).count()
    rows, rejects = load_indexed_json(spark, path, schema)
    assert sorted((r.id, r.name, r.n) for r in rows.collect()) == [(0, "a", 1), (3, None, None), (5, None, 6)]
    assert sorted(r._corrupt_record for r in rejects.collect()) == ["5", 'x: {"name":"b","n":2}', '{"name":"c","n":"many"}']


def test_write_indexed_json(spark, tmp_dir, tiny_splits):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumnRenamed("doc_id", "id")
    path = os.path.join(tmp_dir, "docs")
    write_indexed_json(docs.repartition(3), path)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 3 and all(isinstance(json.load(open(os.path.join(path, f), encoding="utf-8")), dict) for f in parts)
    tiny_splits(30_000)
    same(read_indexed_json(spark, path, docs.schema), docs.select("id", *[c for c in docs.columns if c != "id"]))


def test_jsonl_that_does_not_fit(spark, tmp_dir):
    schema = schema_of(spark, "id bigint, name string")
    path = put(tmp_dir, "x.jsonl", '{"id": 1, "name": "a"}\n{"id": 2, "na\n{"id": "three", "name": "c"}\n')
    with pytest.raises(FAILS):
        read_jsonl(spark, path, schema).collect()
    rows, rejects = load_jsonl(spark, path, schema)
    assert [tuple(r) for r in rows.collect()] == [(1, "a")] and rejects.count() == 2


# --- CSV ---


@pytest.mark.parametrize("size", [11, 90, 100_000])
@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_csv_with_line_breaks_is_split(spark, tmp_dir, tiny_splits, size, eol):
    rng = random.Random(size)
    bits = ['""', "\n", ",", "a", " ", "é", "日", "\n\n"]
    quoted = lambda: '"' + "".join(rng.choice(bits) for _ in range(rng.randrange(8))) + '"'
    os.mkdir(folder := os.path.join(tmp_dir, "csv"))
    for name in ("a.csv", "b.csv"):
        lines = ["id,text,more"] + [f"{i},{rng.choice([quoted(), 'plain', ''])},{quoted()}" for i in range(40)]
        put(folder, name, eol.join(lines) + (eol if name == "a.csv" else ""))
    schema = schema_of(spark, "id bigint, text string, more string")
    want = spark.read.options(**CSV_OPTIONS, multiLine=True).schema(schema).csv(folder)
    assert want.count() == 80
    tiny_splits(size)
    got = read_csv_table(spark, folder, schema, multi_line=True)
    same(got, want)
    if size < 100:
        assert records(spark, folder, CsvEnds).rdd.getNumPartitions() > 8


def test_open_quote_raises(spark, tmp_dir):
    path = put(tmp_dir, "open.csv", 'id,text\n1,"a\n2,b\n')
    with pytest.raises(MalformedFile, match="in quotes"):
        read_csv_table(spark, path, schema_of(spark, "id int, text string"), multi_line=True)


@pytest.mark.parametrize("multi_line", [False, True])
def test_header_order_counts(spark, tmp_dir, multi_line):
    schema = schema_of(spark, "id int, name string")
    read = lambda p, s=schema: [tuple(r) for r in read_csv_table(spark, p, s, multi_line).collect()]
    assert read(put(tmp_dir, "swapped.csv", "name,id\nanna,7\n")) == [(7, "anna")]
    assert read(put(tmp_dir, "extra.csv", 'name,"note",id\nanna,x,7\n')) == [(7, "anna")]
    with pytest.raises(ValueError, match="lacks"):
        read(put(tmp_dir, "other.csv", "nam,id\nanna,7\n"))
    os.mkdir(folder := os.path.join(tmp_dir, "two"))
    put(folder, "a.csv", "name,id\nanna,7\n")
    put(folder, "b.csv", "id,name\n8,bert\n")
    with pytest.raises(FAILS):
        read(folder)


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_rejects(spark, tmp_dir, multi_line):
    schema = schema_of(spark, "id int, name string")
    path = put(tmp_dir, "bad.csv", "id,name\n1,a\n3000000000,b\nabc,c\n4\n5,e,f\n,g\n6,\n")
    with pytest.raises(FAILS):
        read_csv_table(spark, path, schema, multi_line).collect()
    loaded = load_csv(spark, path, schema, multi_line)
    assert loaded.counts() == (3, 4)
    assert {tuple(r) for r in loaded.rows.collect()} == {(1, "a"), (None, "g"), (6, None)}
    assert {r._corrupt_record for r in loaded.rejects.collect()} == {"3000000000,b", "abc,c", "4", "5,e,f"}
    staged = load_staging_rejects(spark, "bad_import", path, schema, multi_line)
    assert spark.table("bad_import").count() == 3 and spark.table("bad_import_rejects").count() == 4 == staged.rejects.count()
    with pytest.raises(FAILS):
        load_staging(spark, "bad_import", path, schema, multi_line).collect()


def test_append_that_does_not_fit(spark, tmp_dir):
    spark.sql(f"CREATE TABLE append_t (id INT, name STRING) USING parquet LOCATION '{os.path.join(tmp_dir, 'append_t')}'")
    try:
        schema = schema_of(spark, "id int, name string")
        df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("3000000000", "d")], "id string, name string")
        with pytest.raises(PySparkException, match="does not fit"):
            append_conformed(df, "append_t", schema)
        left = append_rejects(df, "append_t", schema)
        assert {(r.id, r.name, tuple(r.misfit_columns)) for r in left.collect()} == {("x", "b", ("id",)), ("3000000000", "d", ("id",))}
        assert {tuple(r) for r in spark.table("append_t").collect()} == {(1, "a"), (None, "c")}
    finally:
        spark.sql("DROP TABLE append_t")


def test_a_write_audits_and_profiles_itself(spark, tmp_dir):
    from bibliospark.operators import audit_column, profile
    from bibliospark.sources import save_observed
    df = spark.createDataFrame([(1.5, "abc", None), (None, None, "é👩z"), (4.0, "toolong", "x"), (-2.0, "", None)], "v double, s string, t string")
    path = os.path.join(tmp_dir, "seen")
    seen = save_observed(df, path, {"s": (True, 3), "t": (False, 2)}, ["v"])
    for name, not_null, most in (("s", True, 3), ("t", False, 2)):
        assert seen.violations[name] == sum(audit_column(df, name, not_null, most).first())
    want = profile(df, ["v"]).first()
    assert all(seen.moments["v"][k] == pytest.approx(want[k]) for k in ("count", "mean", "std", "min", "max"))
    same(spark.read.parquet(path), df)
    empty = save_observed(df.limit(0), os.path.join(tmp_dir, "none"), {"s": (True, 3)}, ["v"])
    assert empty.violations == {"s": 0} and empty.moments["v"]["count"] == 0 and empty.moments["v"]["mean"] is None
