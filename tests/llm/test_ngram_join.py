import random

import pytest

from bibliospark.llm import ngram_join as nj

from .helpers import docs_frame, rows, words


def brute(texts, n, percent):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    label = {d: d for d in texts}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in texts}


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        at = rng.randrange(len(out)) if out else 0
        out[at : at + 1] = rng.choice([[], [f"x{rng.random()}"], [*out[at : at + 1], f"y{rng.random()}"]])
    return out


def found(spark, texts, **options):
    got = nj.near_duplicates(docs_frame(spark, list(texts.items())), **options).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
@pytest.mark.parametrize("seed", [1, 2])
def test_like_all_pairs(spark, n, percent, seed):
    rng = random.Random(seed)
    texts = {}
    for _ in range(12):  # families of copies, from near to far
        base = words(rng, rng.choice([3, 6, 30, 120, 300]))
        for _ in range(rng.choice([1, 3, 25])):
            texts[rng.randrange(10**6)] = " ".join(edited(rng, base, rng.choice([0, 0, 1, 2, 4, 8, len(base) // 10])))
    passage = words(rng, 40)  # shared by texts that are otherwise different
    for _ in range(30):
        texts[rng.randrange(10**6)] = " ".join(words(rng, rng.choice([5, 20, 60])) + passage)
    for _ in range(20):
        texts[rng.randrange(10**6)] = " ".join(words(rng, 8, vocabulary=3))
    texts |= {10**7: None, 10**7 + 1: "", 10**7 + 2: " \n\t", 10**7 + 3: "One", 10**7 + 4: "one ", 10**7 + 5: "one two", 10**7 + 6: "é", 10**7 + 7: "É"}
    assert found(spark, texts, n=n, percent=percent) == brute(texts, n, percent)


def test_one_large_family_without_a_centre(spark):
    rng = random.Random(9)
    base = words(rng, 100)
    texts = {i: " ".join(edited(rng, base, rng.choice([2, 3, 4, 5]))) for i in range(250)}
    assert found(spark, texts, n=4, percent=85) == brute(texts, 4, 85)


@pytest.fixture()
def written(monkeypatch):
    """Names and row counts of all intermediates."""
    counts = []

    def saved(df, name):
        out = common_saved(df, name)
        counts.append((name, out.count()))
        return out

    common_saved = nj.saved
    monkeypatch.setattr(nj, "saved", saved)
    return counts


def families(rng, m, edits):
    """m texts each of two families that share most of their text and differ in one block."""
    base, one, two = words(rng, 150), words(rng, 40), words(rng, 40)
    return {f * 10_000 + i: " ".join(edited(rng, base, edits) + block) for f, block in enumerate((one, two)) for i in range(m)}


def test_two_families_grow_linearly(spark, written):
    for m in (40, 160):  # 160 have 12,720 pairs a family
        written.clear()
        texts = families(random.Random(5), m, 1)
        assert found(spark, texts, n=4, percent=85) == brute(texts, 4, 85)
        assert sum(n for name, n in written if name in ("ngram-met", "ngram-pairs")) <= 4 * len(texts)
        assert max(n for _, n in written) <= 4 * nj.FRAGMENTS * len(texts), written


def test_template_just_too_far_apart(spark, written):
    """Pages of one template that differ by a little more than a link allows: no pair links, few rounds are taken."""
    rng = random.Random(6)
    base = words(rng, 120)
    texts = {i: " ".join(base + words(rng, 13)) for i in range(120)}
    assert found(spark, texts, n=4, percent=85) == brute(texts, 4, 85)
    assert [name for name, _ in written].count("ngram-compared") <= 4
    assert sum(n for name, n in written if name in ("ngram-met", "ngram-pairs")) <= 10 * len(texts)


def test_mixed_families(spark):
    """Families around several centres, with members between them."""
    for seed in range(3):
        rng = random.Random(seed)
        base = words(rng, 120)
        centres = [edited(rng, base, rng.choice([2, 4, 8])) for _ in range(5)]
        texts = {rng.randrange(10**6): " ".join(edited(rng, rng.choice(centres), rng.choice([0, 1, 1, 2, 3]))) for _ in range(150)}
        assert found(spark, texts, n=4, percent=85) == brute(texts, 4, 85)


def test_one_id_with_several_texts(spark):
    long, short = "a b c d e f g h", "x y z"
    df = docs_frame(spark, [(1, long), (2, long), (2, short), (3, short), (4, short), (2, None)])
    got = rows(nj.near_duplicates(df, 4, 85), "doc_id", "n_shingles", "component_id")
    assert got == [(1, 5, 1), (2, 0, 1), (2, 1, 1), (2, 5, 1), (3, 1, 3), (4, 1, 3)]


def test_chain_of_links(spark):
    rng = random.Random(4)
    chain = [words(rng, 200)]
    for _ in range(30):
        chain.append(edited(rng, chain[-1], 3))
    texts = {1000 - i: " ".join(x) for i, x in enumerate(chain)}
    got = found(spark, texts, n=4, percent=85)
    assert got == brute(texts, 4, 85) and len({c for _, c in got.values()}) < 5


def test_exact_bounds(spark):
    # 17 of 20 n-grams in common is 85 %
    a = [f"a{i}" for i in range(17 + 3)]
    texts = {1: " ".join(a[:18] + ["b", "c"]), 2: " ".join(a[:17])}
    for percent in (85, 90):
        assert found(spark, texts, n=1, percent=percent) == brute(texts, 1, percent)


def test_edge_rows(spark):
    df = docs_frame(spark, [(3, "one two three four five six"), (3, "one two three four five six"), (None, "one two three four five six"), (2, "One two three four five six"), (9, "w " * 100_000)])
    assert rows(nj.near_duplicates(df), "doc_id", "n_shingles", "component_id") == [(None, 2, None), (2, 2, 2), (3, 2, 2), (3, 2, 2), (9, 1, 9)]
    extra = df.selectExpr("*", "doc_id AS id", "'g' AS gone", "1 AS size", "2 AS grams")
    kept = nj.keep_one(extra)
    assert kept.columns == extra.columns
    assert rows(kept, "doc_id") == [(None,), (2,), (9,)]
    assert nj.near_duplicates(df.limit(0)).count() == 0
    assert nj.near_duplicates(docs_frame(spark, [None, ""])).count() == 2


def test_components_of_long_paths(spark):
    rng = random.Random(3)
    ids = rng.sample(range(10**6), 400)
    links = list(zip(ids[:-1], ids[1:]))
    del links[150]
    got = {r.id: r.component for r in nj.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: min(ids[:151]) for i in ids[:151]} | {i: min(ids[151:]) for i in ids[151:]}
