"""Approximate nearest neighbours by adaptive dimension scan (operator 5).

Vectors are scaled to length one, rotated by one random orthogonal matrix and
put into inverted lists.  A query scans its ``share`` of the lists, nearest
first, in blocks of columns: after each block a hypothesis test on the partial
distance abandons candidates that are too far with high probability, so most
of them are never read to the end.  Survivors are scored exactly, in double
precision, on the original vectors.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors); every vector is
indexed.  Long lists are cut into chunks and many queries into blocks, so a
task holds one chunk and one block whatever the sizes of lists and tables.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, hash_share, saved

SAMPLE = 20_000  # vectors that the centroids are fitted on, at most
LIST_ROWS = 800  # vectors of a list on average; 16 lists at least, and at most one per vector of the sample
SHARE = 0.65  # of the lists that a query scans: recall 0.93 even for directions without any clusters
CHUNK, BLOCK = 8192, 2048  # vectors and queries in one task's cell
COLUMNS = 16  # dimensions scanned between two tests
EPSILON = 2.1  # of the test: how many deviations a partial distance must be off


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or zero, every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1: no digit changes, and squares stay finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = _scaled(x)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def rotation(dims: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int, rounds: int = 6, seed: int = 5) -> np.ndarray:
    """Spherical k-means on unit vectors; an emptied cluster starts again at a random vector."""
    rng = np.random.default_rng(seed)
    lists = min(lists, len(sample))
    centers = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(sample[i : i + 2048] @ centers.T).argmax(axis=1) for i in range(0, len(sample), 2048)])
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, sample)
        empty = (sums * sums).sum(axis=1) < 1e-12
        sums[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
        centers = sums / np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return centers


def scan(x: np.ndarray, q: np.ndarray, k: int, columns: int = COLUMNS, epsilon: float = EPSILON) -> np.ndarray:
    """Rows of ``x`` (rotated unit vectors, stored by column) that may be among the ``k`` nearest to ``q``.

    The k-th best distance so far comes from rows read to the end; the rows
    are read in batches that double, so the first few set a limit for the rest.
    """
    dims, rows = x.shape
    best = np.empty(0, x.dtype)
    kept, limits, start, size = [], [], 0, max(64, 4 * k)
    while start < rows:
        alive = np.arange(start, min(rows, start + size))
        limit = best[k - 1] if len(best) >= k else np.inf
        distance = np.zeros(len(alive), x.dtype)
        for d in range(0, dims, columns):
            part = x[d : d + columns, alive] - q[d : d + columns, None]
            distance += (part * part).sum(axis=0)
            seen = min(d + columns, dims)
            if np.isfinite(limit):
                bound = limit * (1.0 + epsilon / np.sqrt(seen)) ** 2 * seen / dims if seen < dims else limit + 1e-5
                near = distance <= bound
                alive, distance = alive[near], distance[near]
                if not len(alive):
                    break
        kept.append(alive)
        limits.append(distance)
        best = np.sort(np.concatenate([best, distance]))[:k]
        start, size = start + size, 2 * size
    found, distance = np.concatenate(kept), np.concatenate(limits)
    return found[distance <= best[-1] + 1e-5] if len(best) >= k else found


def _array(column: pa.Array) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    share: float = SHARE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row that ``queries`` selects.

    Nearest is the largest cosine; ties go to the smaller vec_id; a row is not
    its own neighbour.  Null, zero and non-finite vectors, rows without a
    vec_id, and vectors of another length than most take no part.  Repeated
    rows count once; of equal vectors every one is found, though only the
    k + 1 smallest ids of each are searched, as no others can rank.
    """
    spark = vectors.sparkSession
    named = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("asks")
    )
    valid = named.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    lengths = Counter({r[0]: r[1] for r in valid.groupBy(F.size("v")).count().collect()})  # a row per length
    out = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], out)
    dims, total = max(lengths.items(), key=lambda x: (x[1], -x[0]))
    valid = valid.filter(F.size("v") == dims).withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    equal = Window.partitionBy("h1", "h2").orderBy("vec_id")
    searched = saved(
        valid.withColumn("copy", F.dense_rank().over(equal)).filter(F.col("copy") <= k + 1).select("vec_id", "v", "h1", "h2")
        .dropDuplicates(["vec_id", "h1", "h2"]),
        "ann-searched",
    )
    asking = valid.filter("asks").select("vec_id", "h1", "h2").distinct()

    # the quantizer: a bounded sample, a matrix and at most as many centroids as the sample has vectors
    likely = searched.filter(hash_share(F.col("h1"), 2.0 * SAMPLE / searched.count()))
    sample = likely.orderBy("h1", "vec_id").limit(SAMPLE).select("v")
    rows = np.array([r[0] for r in sample.toLocalIterator()], np.float64)
    lists = int(max(16, total // LIST_ROWS))
    matrix = rotation(dims)
    centers = centroids(_unit(rows) @ matrix, lists).astype(np.float64)
    probes = max(1, int(np.ceil(share * len(centers))))
    model = spark.sparkContext.broadcast((matrix, centers))

    def assign(batches):
        matrix, centers = model.value
        for batch in batches:
            at = (_unit(_array(batch.column(1))) @ matrix @ centers.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at.astype(np.int32))], names=["vec_id", "v", "list"])

    index = saved(arrow_map(searched.select("vec_id", "v"), assign, "vec_id long, v array<double>, list int"), "ann-index")
    sizes = {r[0]: r[1] for r in index.groupBy("list").count().collect()}  # a row per list
    held_rows = np.array([sizes.get(i, 0) for i in range(len(centers))])
    chunks = [-(-sizes.get(i, 0) // CHUNK) for i in range(len(centers))]
    first = asking.groupBy("h1", "h2").agg(F.min("vec_id").alias("vec_id"))
    distinct = saved(first.join(searched.select("vec_id", "h1", "h2", "v"), ["vec_id", "h1", "h2"]), "ann-queries")
    blocks = max(1, -(-distinct.count() // BLOCK))

    def probe(batches):
        matrix, centers = model.value
        for batch in batches:
            order = np.argsort(-(_unit(_array(batch.column(1))) @ matrix @ centers.T), axis=1, kind="stable")
            # further lists where these hold too few rows
            taken = np.maximum(probes, (held_rows[order].cumsum(axis=1) < k + 1).sum(axis=1) + 1)
            cells = [(i, int(a), c) for i, row in enumerate(order) for a in row[: taken[i]] for c in range(chunks[a])]
            at = pa.array([i for i, _, _ in cells], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array([a for _, a, _ in cells], pa.int32()),
                    pa.array([c for _, _, c in cells], pa.int32()),
                ],
                names=["query_id", "q", "list", "chunk"],
            )

    cell = ["list", "chunk", "block"]
    asked = arrow_map(distinct.select("vec_id", "v"), probe, "query_id long, q array<double>, list int, chunk int")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    per_list = F.element_at(F.array(*[F.lit(max(1, c)) for c in chunks]), F.col("list") + 1)
    held = index.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), per_list).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )

    def search(here: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        made = {"query_id": [], "vec_id": [], "score": []}
        if len(here) and len(asked):
            ids, x = here["vec_id"].to_numpy(), np.stack(here["v"].to_list())
            unit = np.ascontiguousarray((_unit(x) @ matrix).T.astype(np.float32))
            q = np.stack(asked["q"].to_list())
            turned = (_unit(q) @ matrix).astype(np.float32)
            x, q = _scaled(x), _scaled(q)
            norms = np.sqrt((x * x).sum(axis=1))
            for i, query in enumerate(asked["query_id"].to_numpy()):
                at = scan(unit, turned[i], k + 1)
                score = (x[at] * q[i]).sum(axis=1) / (norms[at] * np.sqrt((q[i] * q[i]).sum()))
                top = np.lexsort((ids[at], -score))[: k + 1]
                made["query_id"] += [query] * len(top)
                made["vec_id"] += ids[at][top].tolist()
                made["score"] += score[top].tolist()
        return pd.DataFrame(made)

    found = held.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = [F.desc("score"), F.asc("vec_id")]
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("n") <= k + 1)
    # every asking row has its class's neighbours but itself
    classes = distinct.select(F.col("vec_id").alias("class"), "h1", "h2")
    mine = asking.withColumnRenamed("vec_id", "asker").join(classes, ["h1", "h2"])
    pairs = mine.join(best.withColumnRenamed("query_id", "class"), "class").filter("asker <> vec_id")
    rank = F.row_number().over(Window.partitionBy("asker").orderBy(*order))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("asker").alias("query_id"), "rank", "vec_id", "score"
    )
