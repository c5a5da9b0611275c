"""Ranked lexical search against scoring every pair."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from bibliospark.llm import lexical_search
from bibliospark.llm.lexical_search import Queries, search

from .helpers import docs_frame, rows

ITEMS = "item_id long, text string"
NAMES = ("item_id", "rank", "doc_id", "score")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    """docs: (doc_id, text), items: (item_id, text)."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, b.total()) for d, b in bags if b]
    n_docs, length = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted: dict = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in wanted.items():
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in ts if t in df}
        scored = []
        for d, b, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // length
            scored.append((-sum(w[t] * (10**9 * b[t] // (1000 * b[t] + 20 * m)) for t in w if t in b), d is None, d))
        best = sorted(s for s in scored if s[0] < 0)[:k]
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(best, 1)]
    return sorted(out)


def check(spark, docs, items, k=5):
    got = rows(search(docs_frame(spark, docs), spark.createDataFrame(items, ITEMS), k), *NAMES)
    assert got == brute([d if isinstance(d, tuple) else (i, d) for i, d in enumerate(docs)], items, k)
    return got


def corpus(seed, n_docs, n_items):
    """Frequent and rare words, and passages of items planted in documents."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.4)) % 3000}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 40)))) for i in range(n_items)]
    docs = []
    for _ in range(n_docs):
        text = [word() for _ in range(rng.choice([0, 1, 5, 30, 200]))]
        if rng.random() < 0.2:
            text += rng.choice(items)[1].split()[: rng.randrange(1, 40)]
        docs.append(" ".join(text))
    return docs, items


def test_random_corpus(spark):
    docs, items = corpus(1, 1200, 30)
    assert len(check(spark, docs + docs[:100], items, 10)) > 250


def test_blocks_and_small_buckets(spark, monkeypatch):
    for name, value in [("ITEM_TERMS", 60), ("FIRST_BUCKET", 4), ("BUCKET", 16), ("LONGEST", 1 / 3)]:
        monkeypatch.setattr(lexical_search, name, value)
    check(spark, *corpus(2, 300, 12))


def test_copies_and_ties(spark):
    docs = ["the cat sat"] * 40 + ["a cat", "THE Cat; sat!", "dog"] + ["the the the"] * 20
    got = check(spark, docs, [(1, "the cat sat sat"), (2, "DOG"), (3, "bird"), (1, "dog")], 50)
    assert [r[2] for r in got if r[0] == 1][:3] == [42, 0, 1]


def test_edges(spark):
    docs = [None, "", " ;,", "é É ı", "Ab9 ab9\x00x", (None, "ab9 é"), (4, "ab9"), (4, "ab9"), "word " * 5000 + "ab9"]
    items = [(7, "AB9 é"), (8, None), (9, ""), (None, "ab9"), (10, "É"), (7, "AB9 é")]
    check(spark, docs, items, 50)
    check(spark, docs, [(8, None)])
    check(spark, [None, ""], items)
    check(spark, [], items)
    check(spark, docs, [])
    df = docs_frame(spark, ["ab9 x", "y ab9 x"]).selectExpr("*", "lang as id", "lang as norm", "lang as terms", "lang as score")
    it = spark.createDataFrame([(7, "x", "n")], ITEMS + ", n string").withColumnRenamed("n", "doc_id")
    assert rows(search(df, it, 50), *NAMES) == brute([(0, "ab9 x"), (1, "y ab9 x")], [(7, "x")], 50)


def test_a_term_of_every_document_scores_nothing(spark):
    check(spark, ["all one", "all two", "all three"], [(1, "all"), (2, "all two")])


@pytest.mark.parametrize("k", [1, 3])
def test_bounds_keep_all_that_rank(k):
    """Random vectors, bucket by bucket, against full products; most are pruned before they are rescored."""
    rng = np.random.default_rng(k)
    n, width = 3000, 80
    q = Queries([(i, int(t), int(rng.pareto(1) * 50) + 1) for i in range(10) for t in rng.choice(width, 12, replace=False)])
    dense = (rng.random((n, len(q.terms))) < 0.1) * rng.integers(1, 900_000, (n, len(q.terms)))
    dense = dense[dense.any(axis=1)]
    dense = dense[np.argsort(-np.sqrt((dense.astype(float) ** 2).sum(axis=1)))]
    norm = np.sqrt((dense.astype(float) ** 2).sum(axis=1))
    best, offered = [lexical_search._Best(k, 0) for _ in q.items], 0
    for at in range(0, len(dense), 100):
        part = dense[at : at + 100]
        r, c = np.nonzero(part)
        start = np.searchsorted(r, np.arange(len(part) + 1))
        ids = np.arange(at, at + len(part))
        before = [b.offer for b in best]
        for b, f in zip(best, before):
            b.offer = lambda s, i, z, f=f: (globals().__setitem__("_seen", globals().get("_seen", 0) + len(s)), f(s, i, z))
        lexical_search.search_bucket(q, best, ids, np.zeros(len(part), bool), norm[at : at + 100], start, c, part[r, c])
        for b, f in zip(best, before):
            b.offer = f
    offered = globals().pop("_seen")
    for i, b in enumerate(best):
        w = np.zeros(len(q.terms), np.int64)
        w[q.term[q.start[i] : q.start[i + 1]]] = q.w[q.start[i] : q.start[i + 1]]
        full = dense @ w
        order = np.lexsort((np.arange(len(full)), -full))[:k]
        assert sorted(zip(-b.score, b.id)) == sorted(zip(-full[order], order))
    assert offered < len(dense) * len(q.items) / 2
