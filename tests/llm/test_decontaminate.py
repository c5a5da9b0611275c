import hashlib
import random
import re

import pytest

from bibliospark.llm import decontaminate as dc

from .helpers import docs_frame, rows, words

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def split(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ)) if w]


def brute(text, items):
    w, hit, named = split(text), set(), set()
    for item, t in items:
        b = split(t)
        n = min(13, len(b))
        spans = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in spans:
                hit |= set(range(i, i + n))
                named.add(str(item))
    digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
    return len(w), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(w)


COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def check(spark, texts, items):
    got = rows(dc.contamination(docs_frame(spark, texts), spark.createDataFrame(items, ITEMS)), "doc_id", *COLUMNS)
    want = [(t[0] if isinstance(t, tuple) else i, *brute(t[1] if isinstance(t, tuple) else t, items)) for i, t in enumerate(texts)]
    assert got == sorted(want, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("span", [1, 2, 3, 4, 5, 8, 13])
def test_every_shared_span_shares_a_fingerprint(spark, span):
    rng = random.Random(span)
    item = words(rng, span, 50)
    texts = [" ".join(words(rng, a, 50) + item + words(rng, 9 - a, 50)) for a in range(10)]
    df = docs_frame(spark, texts).select(dc.span_fingerprints(dc.words(dc.F.col("text")), span).alias("p"))
    own = spark.createDataFrame([(0, " ".join(item))], ITEMS).select(dc.span_fingerprints(dc.words(dc.F.col("text")), span).alias("p"))
    (print_,) = own.first().p
    assert all(print_ in r.p for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_like_brute_force(spark, seed):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, rng.choice([1, 2, 3, 5, 8, 12, 13, 14, 20, 45]), 300))) for i in range(25)]
    items += [(100, None), (101, ""), (102, " .,; "), (103, items[3][1]), (9, items[20][1] + " " + items[3][1])]
    texts = []
    for _ in range(60):
        out = words(rng, rng.randrange(40), 300)
        for _ in range(rng.randrange(3)):
            b = split(rng.choice(items)[1])
            a = rng.randrange(len(b) + 1)
            out += b[a : a + rng.choice([5, 12, 13, 14, 40])] + words(rng, rng.randrange(5), 300)
        text = "".join(rng.choice([w, w.upper()]) + rng.choice([" ", ", ", "\n", "--", "\x00"]) for w in out)
        texts.append(text)
    check(spark, texts, items)


def test_edge_rows(spark):
    rng = random.Random(5)
    item = " ".join(words(rng, 20))
    long_text = " ".join(words(rng, 30_000)) + " " + item
    texts = [None, "", "...", item, (3, item), (None, item), (None, "another text"), (7, "İstanbul ÉCOLE " + item.upper()), (8, long_text), (9, "a a a a a a a a a a a a a a a a")]
    check(spark, texts, [(1, item), (2, "a a a a a a a a a a a a a a"), (1, item), (3, "istanbul école")])


def test_empty_tables(spark):
    df = docs_frame(spark, ["some text of a few words", None])
    none = spark.createDataFrame([], ITEMS)
    assert rows(dc.contamination(df, none), "doc_id", "n_words", "n_hit", "contaminated") == [(0, 6, 0, False), (1, 0, 0, False)]
    assert dc.contamination(df.limit(0), spark.createDataFrame([(1, "x")], ITEMS)).count() == 0


def test_rows_that_stay(spark):
    rng = random.Random(6)
    item = " ".join(words(rng, 30))
    df = docs_frame(spark, ["clean text", item, None, (1, item), (5, "clean text")]).selectExpr("*", "'k' AS key", "1 AS prints", "2 AS n_words")
    kept = dc.drop_contaminated(df, spark.createDataFrame([(1, item)], ITEMS))
    assert kept.columns == df.columns
    assert rows(kept, "doc_id", "key", "prints") == [(0, "k", 1), (2, "k", 1), (5, "k", 1)]


def test_no_python_in_the_plan(spark):
    df = dc.contamination(docs_frame(spark, ["a b c"]), spark.createDataFrame([(1, "a b")], ITEMS))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
