"""Ranked lexical search with norm buckets, after LEMP (operator 12).

A document is a vector of term impacts, an item (query) a vector of term
weights, and a score their inner product.  ``index_documents`` keeps every
document's terms and counts; a search then

1. takes the items' terms, their document frequencies and weights;
2. keeps of each document the impacts of those terms alone (all other
   coordinates meet a zero), orders these vectors by length over the whole
   table (a range sort) and writes them;
3. goes through buckets of descending length, the longest vectors in a round
   of their own, so that every item enters the second round with the k-th best
   score of the first as its threshold.  An item skips a bucket, or the tail
   of it, whose greatest length times its own (Cauchy-Schwarz) can't reach the
   threshold; inside, the inner product over the item's heaviest coordinates
   plus the lengths of what remains bounds each vector; what survives is
   rescored exactly in 64-bit integers.

Bounds are doubles and get a relative margin far above their rounding error,
so nothing is pruned that could rank.  Items come in blocks of a bounded number
of terms: a block is what travels by broadcast, whatever the number of items.

Terms are told apart by 64-bit hashes; a false match needs an item's term and
another term of the corpus to collide (about 10^-6 for 10,000 item terms and
10^9 distinct terms).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibliospark.operators.ordering import global_prefix_sum, range_partitions

from .common import LOWER, UPPER, arrow_map, as_binary, hash_words, saved

# Fixed values of the contract: bytes between terms, and the numbers of the weighting.
_BETWEEN = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
SCALE, WEIGHT, SLOPE, LENGTH_SHARE = 10**9, 1000, 20, 50

_TABLE = bytes.maketrans(bytes(_BETWEEN) + UPPER.encode(), b" " * len(_BETWEEN) + LOWER.encode())
ROWS = 500  # texts handled together
ITEM_TERMS = 200_000  # terms of a block of items (a larger item is a block of its own)
FIRST_BUCKET, BUCKET = 256, 4096  # vectors of a task's first and of its later buckets
FOCUS = 0.5  # heaviest coordinates are looked at until what remains of an item has this share of its length
LONGEST = 1 / 16  # share of vectors in the first round
MARGIN = 1 + 1e-9


def term_counts(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(id, n, terms, tfs): number of terms of each text, its distinct terms (hashed) and their counts."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                n, terms, tfs = [], [], []
                for t in as_binary(batch, "text"):
                    words = t.translate(_TABLE).split() if t else []
                    distinct, counts = np.unique(hash_words(words).view(np.int64), return_counts=True)
                    n.append(len(words))
                    terms.append(distinct)
                    tfs.append(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), _lists(terms, np.int64), _lists(tfs, np.int64)],
                    names=["id", "n", "terms", "tfs"],
                )

    named = df.select(F.col(row_id).cast("long").alias("id"), F.col(text).alias("text"))
    return arrow_map(named, run, "id long, n long, terms array<long>, tfs array<long>")


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, kind), *arrays]).astype(kind)))


def index_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written index: (id, n, terms, tfs) of every document with a term."""
    return saved(term_counts(docs, doc_id, text).filter("n > 0"), "terms")


def _item_blocks(items: DataFrame, index: DataFrame, n_docs: int, item_id: str, text: str) -> tuple[DataFrame, int]:
    """(block, item, term, w) of the items' terms that carry weight, and the number of blocks."""
    own = saved(
        term_counts(items, item_id, text).filter("id is not null").select(F.col("id").alias("item"), F.explode("terms").alias("term")).distinct(),
        "item-terms",
    )
    vocabulary = saved(own.select("term").distinct(), "vocabulary")
    df = index.select(F.explode("terms").alias("term")).join(vocabulary, "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    odds = F.lit(2.0 * n_docs + 2.0) / (F.col("df") * 2 + 1).cast("double")
    weights = df.select("term", F.floor(F.log(odds) * F.lit(float(WEIGHT))).cast("long").alias("w")).filter("w > 0")
    weighed = saved(own.join(weights, "term"), "weights")
    sizes = weighed.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
    before = global_prefix_sum(sizes, ["item"], "size", "before")
    blocked = weighed.join(before.select("item", F.floor(F.col("before") / ITEM_TERMS).cast("int").alias("block")), "item")
    blocked = saved(blocked, "item-blocks")
    return blocked, (blocked.agg(F.max("block")).first()[0] or 0) + 1


class Queries:
    """A block of items as sparse weight vectors over its own terms."""

    def __init__(self, rows: list[tuple[int, int, int]]) -> None:
        """``rows``: (item, term, weight)."""
        item, term, w = (np.array(x, np.int64) for x in zip(*rows))
        self.items, item = np.unique(item, return_inverse=True)
        self.terms, term = np.unique(term, return_inverse=True)
        order = np.lexsort((term, -w, item))  # an item's heaviest terms first
        self.term, self.w = term[order], w[order]
        self.start = np.searchsorted(item[order], np.arange(len(self.items) + 1))
        squares = [self.w[a:b].astype(float) ** 2 for a, b in zip(self.start, self.start[1:])]
        self.norm = np.sqrt([s.sum() for s in squares])
        rest = [np.sqrt(np.maximum(s.sum() - np.append(0, np.cumsum(s)), 0)) for s in squares]
        self.focus = np.array([int(np.argmax(r <= FOCUS * r[0])) for r in rest])
        self.rest = np.array([r[f] for r, f in zip(rest, self.focus)])


def _vectors(index: DataFrame, queries, n_docs: int, n_terms: int) -> DataFrame:
    """(id, norm, coords, impacts) of the documents with a term of these queries, by descending length."""

    def run(batches):
        vocabulary = queries.value.terms
        for batch in batches:
            terms = batch.column(2).flatten().to_numpy()
            tf = batch.column(3).flatten().to_numpy()
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
            hit = vocabulary[at] == terms
            # Python integers: the product may pass 64 bits before it is divided
            m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
            at, row, tf = at[hit], row[hit], tf[hit]
            impact = SCALE * tf // (WEIGHT * tf + SLOPE * m[row])
            norm = np.sqrt(np.bincount(row, impact.astype(float) ** 2, batch.num_rows))
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(norm),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(impact.astype(np.int32))),
                ],
                names=["id", "norm", "coords", "impacts"],
            )

    kind = "id long, norm double, coords array<int>, impacts array<int>"
    found = arrow_map(index.select("id", "n", "terms", "tfs"), run, kind).filter("norm > 0")
    # equal lengths (copies) are dealt out by a row number of their own
    order = [F.col("norm").desc(), F.col("salt")]
    ordered = found.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(range_partitions(index), *order)
    return saved(ordered.sortWithinPartitions(*order).drop("salt"), "vectors")


class _Best:
    """The k best (score, id) of one query so far."""

    def __init__(self, k: int, least: int) -> None:
        self.k, self.least = k, max(least, 1)  # scores below ``least`` can't rank
        self.score, self.id, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def offer(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        fit = score >= self.least
        self.score = np.concatenate([self.score, score[fit]])
        self.id, self.null = np.concatenate([self.id, ids[fit]]), np.concatenate([self.null, null[fit]])
        if len(self.score) > self.k:
            best = np.lexsort((self.id, self.null, -self.score))[: self.k]
            self.score, self.id, self.null = self.score[best], self.id[best], self.null[best]
        if len(self.score) == self.k:
            self.least = max(self.least, int(self.score.min()))


def search_bucket(q: Queries, best: list[_Best], ids, null, norm, start, coords, impacts) -> None:
    """One bucket of vectors, longest first, against all queries."""
    n = len(norm)
    row = np.repeat(np.arange(n), np.diff(start))
    by_term = np.argsort(coords, kind="stable")  # inverted lists of the bucket
    lists = np.searchsorted(coords[by_term], np.arange(len(q.terms) + 1))
    square = norm**2
    weight = np.zeros(len(q.terms), np.int64)
    for i in range(len(q.items)):
        least = best[i].least
        reach = int(np.searchsorted(-norm, -least / (q.norm[i] * MARGIN), "right"))
        if not reach:
            continue
        a, b = q.start[i], q.start[i + 1]
        f = a + q.focus[i]
        at = np.concatenate([by_term[lists[t] : lists[t + 1]] for t in q.term[a:f]]) if f > a else by_term[:0]
        heavy = np.repeat(q.w[a:f], [lists[t + 1] - lists[t] for t in q.term[a:f]])
        seen = impacts[at].astype(float)
        partial = np.bincount(row[at], heavy * seen, n)
        left = np.maximum(square - np.bincount(row[at], seen**2, n), 0)
        bound = (partial + q.rest[i] * np.sqrt(left)) * MARGIN
        chosen = np.flatnonzero(bound[:reach] >= least)
        if not len(chosen):
            continue
        weight[q.term[a:b]] = q.w[a:b]
        sizes = start[chosen + 1] - start[chosen]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(start[chosen] - (ends - sizes), sizes)
        exact = np.add.reduceat(weight[coords[places]] * impacts[places], ends - sizes)
        weight[q.term[a:b]] = 0
        best[i].offer(exact, ids[chosen], null[chosen])


def _buckets(batches) -> Iterator[tuple]:
    """The rows of a partition, which come by descending length, as buckets of bounded size."""
    size = FIRST_BUCKET
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size)
            at, size = at + size, min(BUCKET, 2 * size)
            lists = part.column(2)
            start = lists.offsets.to_numpy().astype(np.int64)
            yield (
                part.column(0).fill_null(0).to_numpy(),
                part.column(0).is_null().to_numpy(zero_copy_only=False),
                part.column(1).to_numpy(),
                start - start[0],
                lists.flatten().to_numpy(),
                part.column(3).flatten().to_numpy().astype(np.int64),
            )


def _round(vectors: DataFrame, queries, least: dict[int, int], k: int) -> DataFrame:
    """(item_id, doc_id, score): each task's k best per item among those that reach the thresholds."""
    floors = vectors.sparkSession.sparkContext.broadcast(least)

    def run(batches):
        q = queries.value
        best = [_Best(k, floors.value.get(int(i), 0)) for i in q.items]
        for bucket in _buckets(batches):
            search_bucket(q, best, *bucket)
        for i, b in zip(q.items, best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(b.score), i)), pa.array(b.id, mask=b.null), pa.array(b.score)],
                names=["item_id", "doc_id", "score"],
            )

    return saved(arrow_map(vectors, run, "item_id long, doc_id long, score long"), "found")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_block(index: DataFrame, rows: list[tuple[int, int, int]], n_docs: int, n_terms: int, k: int) -> DataFrame:
    q = Queries(rows)
    queries = index.sparkSession.sparkContext.broadcast(q)
    vectors = _vectors(index, queries, n_docs, n_terms)
    cut = vectors.agg(F.percentile_approx("norm", 1 - LONGEST, 1000)).first()[0]
    if cut is None:
        return vectors.selectExpr("0L as item_id", "id as doc_id", "0L as score").limit(0)
    first = _round(vectors.filter(F.col("norm") >= cut), queries, {}, k)
    kth = _ranked(first, k).filter(F.col("rank") == k).select("item_id", "score").collect()  # an item each, at most
    least = {r.item_id: r.score for r in kth}
    reach = min(least.get(int(i), 0) / (n * MARGIN) for i, n in zip(q.items, q.norm))
    rest = _round(vectors.filter((F.col("norm") < cut) & (F.col("norm") >= reach)), queries, least, k)
    return first.unionByName(rest)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Null and empty texts have no terms; a document without terms ranks
    nowhere.  Rows of one item_id are one item; rows without one are none.
    Every row of ``docs`` is a document of its own, so a repeated doc_id can
    rank repeatedly; equal scores go by doc_id, null last.  Items without a
    document above 0 have no rows, nor has an empty table.  Other columns do
    not matter.
    """
    index = index_documents(docs, doc_id, text)
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    empty = index.selectExpr("id as item_id", "0 as rank", "id as doc_id", "n as score").limit(0)
    if not n_docs:
        return empty
    blocks, number = _item_blocks(items, index, n_docs, item_id, text)
    found = []
    for b in range(number):
        rows = [tuple(r) for r in blocks.filter(F.col("block") == b).select("item", "term", "w").collect()]
        if rows:
            found.append(_search_block(index, rows, n_docs, n_terms, k))
    return _ranked(reduce(DataFrame.unionByName, found), k) if found else empty
