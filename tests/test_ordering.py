"""Distributed global order operators equal Spark's single-partition windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from bibliospark.operators import exact_quantiles, global_prefix_sum, global_rank, global_row_number, sample_n, top_k


def _df(spark, n=3000, hot=True, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        v = 42 if hot and rng.random() < 0.34 else rng.choice([None, *range(50)])  # a third on one value
        rows.append((k, v, rng.randint(0, 9)))
    return spark.createDataFrame(rows, "k long, v long, w long")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_row_number(spark):
    df = _df(spark)
    a = global_row_number(df, [("v", "desc_nulls_first"), "k"], "rn")
    b = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("v").desc_nulls_first(), "k")).cast("bigint"))
    assert _same(a, b)


def test_rank_and_dense_rank(spark):
    df = _df(spark)
    a = global_rank(df, [("v", "desc_nulls_first")], "r")
    b = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())).cast("bigint"))
    assert _same(a, b)
    a = global_rank(df, [("v", "asc_nulls_last")], "r", dense=True)
    b = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").asc_nulls_last())).cast("bigint"))
    assert _same(a, b)


def test_prefix_sum(spark):
    df = _df(spark, hot=False)
    a = global_prefix_sum(df, ["k"], "w", "p")
    win = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    b = df.withColumn("p", F.coalesce(F.sum("w").over(win), F.lit(0)).cast("bigint"))
    assert _same(a, b)


def test_exact_quantiles(spark):
    df = _df(spark)
    got = exact_quantiles(df, "v", [0, 0.25, 0.5, 0.75, 1])
    want = df.select(F.percentile(F.col("v").cast("double"), [0.0, 0.25, 0.5, 0.75, 1.0])).first()[0]
    assert [round(x, 9) for x in got] == [round(x, 9) for x in want]
    assert exact_quantiles(df.filter("v is null"), "v", [0.5]) == [None]


def test_top_k_and_sample(spark):
    df = _df(spark)
    got = [r["k"] for r in top_k(df, [("w", "desc"), "k"], 7).collect()]
    want = [r["k"] for r in df.orderBy(F.col("w").desc(), "k").limit(7).collect()]
    assert got == want
    s1 = [r["k"] for r in sample_n(df, 25, 42, ["k"]).collect()]
    s2 = [r["k"] for r in sample_n(df, 25, 42, ["k"]).collect()]
    assert s1 == s2 and len(set(s1)) == 25
    assert sample_n(df, 10_000, 1, ["k"]).count() == df.count()


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=60),
       desc=st.booleans(), nulls_first=st.booleans())
def test_rank_property(spark, values, desc, nulls_first):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k long, v long")
    how = ("desc" if desc else "asc") + ("_nulls_first" if nulls_first else "_nulls_last")
    col = getattr(F.col("v"), how)()
    got = {r.k: r.r for r in global_rank(df, [("v", how)], "r").collect()}
    want = {r.k: r.r for r in df.withColumn("r", F.rank().over(Window.orderBy(col))).collect()}
    assert got == want
    got = {r.k: r.rn for r in global_row_number(df, [("v", how), "k"], "rn").collect()}
    want = {r.k: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy(col, "k"))).collect()}
    assert got == want
