import numpy as np
import pytest
from pyspark.sql import functions as F

from bibliospark.llm import ann

VECTORS = "vec_id long, embedding array<float>, label int"
COLUMNS = ("query_id", "rank", "vec_id", "score")


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in vectors], VECTORS)


def brute(vectors, asks, k):
    """query -> the k nearest (vec_id, score), all by one formula."""
    ok = {}
    for i, v in vectors:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in filter(asks, ok):
        scores = [(-(ok[i] * ok[q]).sum() / (np.sqrt((ok[i] ** 2).sum()) * np.sqrt((ok[q] ** 2).sum())), i) for i in ok if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.select(*COLUMNS).collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def random_vectors(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, rng.standard_normal(dims).astype(np.float32)) for i in range(n)]


@pytest.mark.parametrize(("n", "dims"), [(3000, 64), (900, 7), (40, 3)])
def test_recall(spark, n, dims):
    vectors = random_vectors(n, dims)
    got = found(ann.nearest(frame(spark, vectors), ann.F.col("vec_id") % 20 == 0))
    want = brute(vectors, lambda i: i % 20 == 0, 5)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = dict(vectors)
    for q, near in got.items():
        for i, score in near:
            a, b = exact[i].astype(float), exact[q].astype(float)
            assert np.isclose(score, a @ b / np.linalg.norm(a) / np.linalg.norm(b), rtol=0, atol=1e-12)


def test_all_lists_give_all_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 50)  # many chunks and blocks of queries
    monkeypatch.setattr(ann, "BLOCK", 7)
    vectors = random_vectors(700, 32, 1)
    got = found(ann.nearest(frame(spark, vectors), ann.F.col("vec_id") % 10 == 0, share=1.0))
    want = brute(vectors, lambda i: i % 10 == 0, 5)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.995 * 5 * len(want)  # only the hypothesis test can miss one


def test_equal_vectors_and_ties(spark):
    vectors = random_vectors(60, 8, 2)
    hot = vectors[0][1]
    vectors += [(1000 + i, hot) for i in range(200)]
    got = found(ann.nearest(frame(spark, vectors), ann.F.col("vec_id") % 50 == 0, share=1.0))
    assert [i for i, _ in got[0]] == [1000, 1001, 1002, 1003, 1004]
    assert [i for i, _ in got[1000]] == [0, 1001, 1002, 1003, 1004]
    assert [i for i, _ in got[1100]] == [0, 1000, 1001, 1002, 1003]
    want = brute(vectors, lambda i: i == 50, 5)
    assert [i for i, _ in got[50]] == [i for i, _ in want[50]]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0, 1.0]),
        (None, [1.0, 0.0]), (50, [2.0, 0.0]), (50, [2.0, 0.0]), (100, [1.0, 2.0, 3.0]), (150, [0.0, 0.0]), (8, [1e-30, 2e-30]), (9, [1e30, -3e30]),
    ]
    got = found(ann.nearest(frame(spark, vectors), ann.F.col("vec_id") % 50 == 0, share=1.0))
    assert got.keys() == {0, 50}
    assert [i for i, _ in got[0]] == [50, 7, 8, 9] and [i for i, _ in got[50]] == [0, 7, 8, 9]


def test_few_rows_and_clashing_columns(spark):
    asks = ann.F.col("vec_id") % 50 == 0
    df = frame(spark, [(0, [1.0, 2.0])]).selectExpr("*", "1 AS v", "2 AS list", "3 AS asks")
    assert ann.nearest(df, asks).count() == 0
    assert ann.nearest(df.limit(0), asks).count() == 0
    two = frame(spark, [(0, [1.0, 2.0]), (1, [3.0, 1.0])]).selectExpr("*", "1 AS h1", "2 AS chunk", "3 AS rank", "4 AS score")
    assert [i for i, _ in found(ann.nearest(two, asks))[0]] == [1]


def test_scan_abandons_without_losing_the_nearest():
    rng = np.random.default_rng(4)
    x = ann._unit(rng.standard_normal((4000, 64))) @ ann.rotation(64)
    stored = np.ascontiguousarray(x.T.astype(np.float32))
    kept = missed = 0
    for i in range(50):
        at = ann.scan(stored, stored[:, i].copy(), 6)
        nearest = np.argsort(-(x @ x[i]))[:6]
        kept += len(at)
        missed += len(set(nearest) - set(at))
    assert missed <= 3 and kept < 50 * 40


@pytest.mark.parametrize("n", [3, 4, 7, 10])
def test_few_rows_are_all_found_at_the_production_share(spark, n):
    rng = np.random.default_rng(n)
    rows_ = [(i, rng.normal(size=16).tolist()) for i in range(n)]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.lit(True), k=5).groupBy("query_id").count().collect()
    assert {r[0]: r[1] for r in got} == {i: min(5, n - 1) for i in range(n)}


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e-308])
def test_vectors_of_the_double_range(spark, size):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((30, 8))
    vectors = [(2 * i, v * size) for i, v in enumerate(base)] + [(2 * i + 1, (v + 0.01 * rng.standard_normal(8)) * size * 3) for i, v in enumerate(base)]
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in vectors], VECTORS.replace("float", "double"))
    got = found(ann.nearest(df, F.col("vec_id") % 2 == 0, k=1, share=1.0))
    assert {q: near[0][0] for q, near in got.items()} == {2 * i: 2 * i + 1 for i in range(30)}
    assert all(0.99 < near[0][1] <= 1 + 1e-12 for near in got.values())
