"""Cleaning, dedupe, ids, joins, audits, graph and date operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bibliospark.functions import first_last, first_token, join_tail, last_token, parse_rfc1123
from bibliospark.operators import (
    assign_first_position_ids,
    audit_column,
    audit_reference,
    audit_unique,
    co_neighbours,
    date_dimension,
    dim_distinct,
    dim_first_seen,
    dim_per_row,
    distinct_on,
    drop_all_duplicates,
    drop_columns,
    enrich_by_lookup,
    flatten_authors,
    graph_edges,
    graph_nodes,
    left_join_null_safe,
    nullify,
    profile,
    relations,
    row_not_in,
)
from bibliospark.operators.audit import IntegrityError


def test_tokens_and_tail(spark):
    df = spark.createDataFrame([("  J. Smith  ",), ("Solo",), ("",)], "s string")
    r = df.select(first_token("s").alias("f"), last_token("s").alias("l")).collect()
    assert [(x.f, x.l) for x in r] == [("J.", "Smith"), ("Solo", "Solo"), ("", "")]
    arr = spark.createDataFrame([(["S", "G", ""],), (["S"],), (["S", "", ""],), ([],)], "a array<string>")
    assert [x[0] for x in arr.select(join_tail("a")).collect()] == ["G ", "", " ", ""]


def test_first_last_and_rfc1123(spark):
    df = spark.createDataFrame([([("Tue, 2 Jan 2007 09:30:00 GMT",), ("Mon, 15 Jan 2007 10:00:00 GMT",)],), ([],)],
                               "v array<struct<created:string>>")
    f, l = first_last("v", "created")
    r = df.select(parse_rfc1123(f).alias("f"), parse_rfc1123(l).alias("l")).collect()
    assert r[0].f == dt.datetime(2007, 1, 2, 9, 30) and r[0].l == dt.datetime(2007, 1, 15, 10, 0)
    assert r[1].f is None and r[1].l is None
    bad = spark.createDataFrame([("Someday, 99 Foo 2007 00:00:00 GMT",)], "s string")
    assert bad.select(parse_rfc1123("s")).first()[0] is None


def test_drop_columns_modes(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert drop_columns(df, ["a", "zz"]).columns == ["b"]
    assert drop_columns(df, ["a", "zz"], all_or_none=True).columns == ["a", "b"]


def test_nullify(spark):
    df = spark.createDataFrame([("None", "x", 1)], "a string, b string, n int")
    assert tuple(nullify(df).first()) == (None, "x", 1)


def test_drop_all_duplicates_nulls_equal(spark):
    rows = [(1, "t", None, [1]), (2, "t", None, [2]), (3, "u", "c", [3]), (4, "t", "c", [4])]
    df = spark.createDataFrame(rows, "id int, title string, comments string, v array<int>")
    assert sorted(r.id for r in drop_all_duplicates(df, exclude=["id", "v"]).collect()) == [3, 4]


def test_distinct_on_and_not_in(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b"), (2, 2, "a")], "k int, o int, x string")
    got = sorted(tuple(r) for r in distinct_on(df, ["k"], ["o", "x"]).collect())
    assert got == [(1, 1, "a"), (2, 2, "a")]
    sub = spark.createDataFrame([(1, 1), (None, 2)], "k int, o int")
    kept = row_not_in(spark.createDataFrame([(1, 1), (None, 2), (None, 3)], "k int, o int"), sub, ["k", "o"])
    assert [tuple(r) for r in kept.collect()] == [(None, 3)]


def test_first_position_ids(spark):
    df = spark.createDataFrame([(10, [["A", "x"], ["B", "y"]]), (20, [["A", "x"], ["C", "z"]])],
                               "id long, authors_parsed array<array<string>>")
    ids = assign_first_position_ids(flatten_authors(df), ["Surname", "Names"], ["id", "pos"])
    assert sorted(tuple(r) for r in ids.collect()) == [(0, "A", "x"), (1, "B", "y"), (3, "C", "z")]


def test_dimensions(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "id long, name string")
    assert [tuple(r) for r in dim_distinct(df, "name", "i", "n").orderBy("i").collect()] == [(1, "a"), (2, "b")]
    assert [tuple(r) for r in dim_per_row(df, "name", ["id"], "i", "n").orderBy("i").collect()] == \
        [(1, "a"), (2, "b"), (3, "b"), (4, None)]
    first = [tuple(r) for r in dim_first_seen(df, "name", "id", "i", "n").orderBy("i").collect()]
    assert first == [(0, "b"), (1, "a"), (2, None)]
    rel = relations(df, "id", [("name", dim_first_seen(df, "name", "id", "i", "n"), "n", "i")])
    assert sorted(tuple(r) for r in rel.collect()) == [(1, 0), (2, 1), (3, 2), (4, 0)]


def test_lookup_joins(spark):
    df = spark.createDataFrame([("d1",), ("d2",), (None,)], "doi string")
    lk = spark.createDataFrame([("d1", 5), ("d1", 3), (None, 9)], "doi string, rc int")
    got = sorted(enrich_by_lookup(df, lk, "doi").collect(), key=lambda r: (r.doi or "", r.rc or 0))
    assert [tuple(r) for r in got] == [(None, None), ("d1", 3), ("d2", None)]
    a = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    b = spark.createDataFrame([(None, 7), ("x", 8)], "k string, v int")
    assert sorted(tuple(r) for r in left_join_null_safe(a, b, ["k"]).select("id", "v").collect()) == [(1, 7), (2, 8)]


def test_audits(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, name string")
    bad = {(r.id, r.reason) for r in audit_unique(dim, ["id"]).collect()}
    assert bad == {(1, "duplicate"), (None, "null_key")}
    with pytest.raises(IntegrityError):
        audit_unique(dim, ["id"], strict=True)
    child = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    assert [r.id for r in audit_reference(child, dim, ["id"]).collect()] == [2]
    with pytest.raises(IntegrityError):
        audit_reference(child, dim, ["id"], strict=True)
    col = spark.createDataFrame([("x" * 51,), (None,), ("ok",)], "j string")
    r = audit_column(col, "j", not_null=True, max_len=50).first()
    assert (r.null_rows, r.too_long_rows) == (1, 1)


def test_graph_ops(spark):
    people = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "pid long, name string")
    pubs = spark.createDataFrame([(10,), (11,)], "pub long")
    nodes = graph_nodes({"author": (people, "pid", ["name"]), "publication": (pubs, "pub", [])})
    rel = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (3, 11), (4, 11)], "a long, p long")
    edges = graph_edges([(rel, "author", "a", "CREATE", "publication", "p")], nodes)
    assert edges.count() == 4                        # parallel kept, dangling (4) dropped
    co = co_neighbours(rel, "a", "p", 1)
    assert [r.a for r in co.collect()] == [2]


def test_date_dimension(spark):
    d = date_dimension(spark)
    assert d.count() == 29220
    last = d.orderBy(F.col("date_actual").desc()).first()
    assert last.date_actual == dt.date(2049, 12, 31) and last.date_dim_id == 20491231
    r = d.filter(F.col("date_actual") == dt.date(2021, 1, 3)).first()   # a Sunday in ISO week 53 of 2020
    assert (r.day_of_week, r.week_of_year, r.week_of_year_iso, r.week_of_month) == (7, 53, "2020-W53-7", 1)
    assert r.epoch == 1609632000


def test_profile(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "x double")
    r = profile(df, ["x"]).first()
    assert (r["count"], r["mean"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]) == \
        (5, 4.0, 1.0, 2.0, 3.0, 4.0, 10.0)
    both = profile(df.selectExpr("x", "-x AS y", "cast(null AS double) AS z"), ["y", "z", "x"]).collect()
    assert [(r["column"], r["count"], r["q25"], r["max"]) for r in both] == [("y", 5, -4.0, -1.0), ("z", 0, None, None), ("x", 5, 2.0, 10.0)]


def test_author_ids_equals_occurrence_numbering(spark):
    import random
    rng = random.Random(5)
    names = ["A", "B", "C", "D"]
    rows = [(i * 3 + 1, [[rng.choice(names), rng.choice(["x", "y", ""])] for _ in range(rng.randint(0, 4))])
            for i in range(200)]
    rows.append((9999, None))
    df = spark.createDataFrame(rows, "id long, authors_parsed array<array<string>>")
    from bibliospark.operators import author_ids
    a = author_ids(df)
    b = assign_first_position_ids(flatten_authors(df), ["Surname", "Names"], ["id", "pos"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_drop_all_duplicates_prefilter_equals_exact(spark):
    import random
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", None, "c" * 40]), rng.choice([None, 1, 2]), rng.choice(["x", "y"]))
            for i in range(400)]
    rows += [(1000 + i, "hot", 1, "x") for i in range(150)]          # a hot duplicate group
    df = spark.createDataFrame(rows, "id int, t string, n int, v string")
    a = drop_all_duplicates(df, exclude=["id", "v"])
    m = df.withColumn("t", F.create_map(F.lit("k"), "t"))              # maps: grouped on full values
    b = drop_all_duplicates(m, exclude=["id", "v"])
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())
    from collections import Counter
    cnt = Counter((t, n) for _, t, n, _ in rows)
    assert sorted(r.id for r in a.collect()) == sorted(i for i, t, n, _ in rows if cnt[(t, n)] == 1)


def test_tokens_follow_python_split_whitespace(spark):
    samples = [" Jean　Dupont ", "\x1cAnna\x0bMaria\x85", "Li Wei", " ", "plain name"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [(r.f, r.l) for r in df.select(first_token("s").alias("f"), last_token("s").alias("l")).collect()]
    want = [(s.split()[0], s.split()[-1]) if s.split() else ("", "") for s in samples]
    assert got == want


def test_drop_all_duplicates_with_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (2, {"a": 1}), (3, {"b": 2})], "id int, m map<string,int>")
    assert sorted(r.id for r in drop_all_duplicates(df, exclude=["id"]).collect()) == [3]


def test_lookup_variants(spark):
    from bibliospark.operators import enrich_by_lookup, lookup_exact
    pubs = spark.createDataFrame([(1, "d1"), (2, "d2"), (3, None)], "id int, doi string")
    meta = spark.createDataFrame([("d1", 7, "P"), ("d1", 5, "Q"), ("d3", 1, "R")],
                                 "key string, is_referenced_by_count int, publisher string")
    out = enrich_by_lookup(pubs, meta, "doi", mapping={"is_referenced_by_count": "reference_count",
                                                       "publisher": "journal"}, lookup_key="key")
    got = sorted((r.id, r.reference_count, r.journal) for r in out.collect())
    assert got == [(1, 5, "Q"), (2, None, None), (3, None, None)]   # least row per key; misses give nulls
    names = spark.createDataFrame([("Ann",), ("Bob",), ("Cy",)], "firstname string")
    genders = spark.createDataFrame([("Ann", "female"), ("Bob", None)], "firstname string, gender string")
    inner = sorted((r.firstname, r.gender) for r in lookup_exact(names, genders, "firstname", "firstname").collect())
    left = sorted((r.firstname, r.gender) for r in lookup_exact(names, genders, "firstname", "firstname",
                                                                how="left").collect())
    assert inner == [("Ann", "female"), ("Bob", None)]
    assert left == [("Ann", "female"), ("Bob", None), ("Cy", None)]


def test_stable_ids_never_change(spark):
    from bibliospark.operators import stable_ids
    kind = "a string, b long"
    first = stable_ids(spark.createDataFrame([("x", 1), ("x", None), ("b", 2), ("x", 1)], kind), ["a", "b"], "id")
    assert sorted(map(tuple, first.collect())) == [(1, "b", 2), (2, "x", None), (3, "x", 1)]
    more = spark.createDataFrame([("a", 0), (None, None), ("x", None), ("b", 2), ("zz", 9)], kind)
    second = stable_ids(more, ["a", "b"], "id", first)
    assert set(map(tuple, first.collect())) < set(map(tuple, second.collect()))
    assert sorted(map(tuple, second.collect()))[3:] == [(4, None, None), (5, "a", 0), (6, "zz", 9)]
    assert stable_ids(more.limit(0), ["a", "b"], "id", second).count() == 6
    assert [r.id for r in stable_ids(more, ["a", "b"], "id", first.limit(0)).orderBy("id").collect()] == [1, 2, 3, 4, 5]


def test_distinct_bitmaps_roll_up(spark):
    from bibliospark.operators import distinct_bitmaps, distinct_rollup
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.choice([None, "u", "v"]), rng.choice([None, 0, 1, 32767, 32768, 32769, 70_000, 10**9])) for _ in range(300)]
    df = spark.createDataFrame([*rows, ("only nulls", "u", None)], "g string, h string, id long")
    bits = distinct_bitmaps(df, ["g", "h"], "id", {"n": F.lit(1)})
    assert "Expand" not in bits._jdf.queryExecution().executedPlan().toString()
    for keys in (["g", "h"], ["g"], ["h"], []):
        want = df.groupBy(*keys).agg(F.countDistinct("id").alias("d"), F.count(F.lit(1)).alias("n"))
        got = distinct_rollup(bits, keys, "d", ["n"])
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_key_space_counts_like_single_audits(spark):
    from bibliospark.operators import audit_key_space, audit_reference, audit_unique
    parent = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,), (None,)], "p long")
    other = spark.createDataFrame([(2,), (9,)], "q long")
    child = spark.createDataFrame([(1, 2), (5, 9), (5, None), (None, 7), (2, 7)], "c long, d long")
    got = dict(map(tuple, audit_key_space(
        {"p_pk": (parent, "p"), "q_pk": (other, "q")},
        {"c_fk": (child, "c", "p_pk"), "d_fk": (child, "d", "q_pk"), "q_fk": (other, "q", "p_pk")}).collect()))
    assert got == {
        "p_pk": audit_unique(parent, ["p"]).count(), "q_pk": 0, "c_fk": audit_reference(child, parent, ["c"], ["p"]).count(),
        "d_fk": audit_reference(child, other, ["d"], ["q"]).count(), "q_fk": audit_reference(other, parent, ["q"], ["p"]).count()}
    assert got["p_pk"] == 2 and got["c_fk"] == 2 and got["d_fk"] == 2
    empty = audit_key_space({"p_pk": (parent.limit(0), "p")}, {"c_fk": (child.limit(0), "c", "p_pk")})
    assert dict(map(tuple, empty.collect())) == {"p_pk": 0, "c_fk": 0}
