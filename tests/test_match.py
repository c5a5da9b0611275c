"""Gram-blocked contains joins against a brute-force nested loop."""

import random

import pytest
from pyspark.sql import functions as F

from bibliospark.operators import contains_pairs, first_match_contains, match, min_contained, rejected_patterns
from bibliospark.session import written_once

ALPHABET = "ab cé\U0001F600"   # includes a 2-byte and a 4-byte character


def rand_text(rng, lo, hi):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(lo, hi)))


def test_contains_pairs_random(spark):
    rng = random.Random(7)
    hays = [(i, rand_text(rng, 0, 120)) for i in range(60)] + [(60, None)]
    needles = [(j, rand_text(rng, 0, 30)) for j in range(80)] + [(80, None)]
    # plant some long needles so the sparse tier is exercised with true hits
    for j in range(81, 101):
        h = hays[rng.randrange(60)][1]
        if len(h) > 40:
            p = rng.randrange(len(h) - 30)
            needles.append((j, h[p:p + rng.randint(15, 30)]))
    want = sorted((j, i) for j, n in needles for i, h in hays if n and h is not None and n in h)
    hd = spark.createDataFrame(hays, "hid long, h string")
    nd = spark.createDataFrame(needles, "nid long, n string")
    got = sorted(tuple(r) for r in contains_pairs(nd, ["nid"], "n", hd, ["hid"], "h").collect())
    assert got == want


def test_min_contained_with_empty_needle(spark):
    hays = [(1, "hello world"), (2, "abc"), (3, None), (4, "another hello world example text")]
    needles = [(10, "hello world"), (5, "another hello world exam"), (7, "")]
    hd = spark.createDataFrame(hays, "doc long, text string")
    nd = spark.createDataFrame(needles, "item long, text string")
    got = sorted(tuple(r) for r in min_contained(hd, "doc", "text", nd, "item", "text").collect())
    assert got == [(1, 7), (2, 7), (4, 5)]


def test_first_match_contains_two_pairs(spark):
    rng = random.Random(3)
    surnames = ["Liu", "Li", "Lim", "Smith", "Smithers", "O'Neil", "M\\\"uller", ""]
    given = ["Wei", "W.", "John ", " ", "", "Anna Maria", "J"]
    build = [(i, rng.choice(surnames), rng.choice(given)) for i in range(50)]
    probe = [(k, rng.choice(surnames), rng.choice(given)) for k in range(80)]
    want = {}
    for k, s, g in probe:
        m = [i for i, bs, bg in build if s in bs and g in bg]
        if m:
            want[k] = min(m)
    pd_ = spark.createDataFrame(probe, "k long, Surname string, Names string")
    bd = spark.createDataFrame(build, "author_id long, Surname string, Names string")
    out = first_match_contains(pd_, bd, [("Names", "Names"), ("Surname", "Surname")], "author_id")
    assert {r["k"]: r["author_id"] for r in out.collect()} == want
    left = first_match_contains(pd_, bd, [("Names", "Names"), ("Surname", "Surname")], "author_id", how="left")
    assert left.count() == len(probe)


def test_first_match_exact(spark):
    bd = spark.createDataFrame([(1, "Liu", "Wei"), (2, "Li", "Wei"), (3, "Li", "Wei")], "author_id long, Surname string, Names string")
    pd_ = spark.createDataFrame([(0, "Li", "Wei"), (1, "Lu", "Wei")], "k long, Surname string, Names string")
    out = first_match_contains(pd_, bd, [("Names", "Names"), ("Surname", "Surname")], "author_id", match="exact")
    assert [(r["k"], r["author_id"]) for r in out.collect()] == [(0, 2)]
    contains = first_match_contains(pd_, bd, [("Names", "Names"), ("Surname", "Surname")], "author_id")
    assert [(r["k"], r["author_id"]) for r in contains.collect()] == [(0, 1)]   # "Li" is in "Liu"


def test_contains_pairs_without_needles(spark):
    hd = spark.createDataFrame([(1, "abc")], "hid long, h string")
    nd = spark.createDataFrame([(1, ""), (2, None)], "nid long, n string")
    out = contains_pairs(nd, ["nid"], "n", hd, ["hid"], "h")
    assert out.columns == ["nid", "hid"] and out.count() == 0


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_chars = st.sampled_from(list("aab \n") + ["é", "\U0001F600", " "])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(hays=st.lists(st.text(_chars, max_size=60), min_size=1, max_size=8),
       needles=st.lists(st.text(_chars, max_size=24), min_size=1, max_size=8))
def test_contains_pairs_property(spark, hays, needles):
    hd = spark.createDataFrame(list(enumerate(hays)), "hid long, h string")
    nd = spark.createDataFrame(list(enumerate(needles)), "nid long, n string")
    got = sorted(tuple(r) for r in contains_pairs(nd, ["nid"], "n", hd, ["hid"], "h").collect())
    want = sorted((j, i) for j, n in enumerate(needles) for i, h in enumerate(hays) if n and n in h)
    assert got == want


import re

_UNITS = ["a", "b", "é", " ", ".", "\\.", "{", "}", "\\'", "\U0001F600"]
_HAY = list("ab é.{}'\n") + ["\U0001F600"]


def _literal_runs(pattern):
    units = re.findall(r"\\.|.", pattern, flags=re.S)
    return "".join("\0" if u == "." else u[-1] for u in units).split("\0")


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(pats=st.lists(st.tuples(st.lists(st.sampled_from(_UNITS), max_size=4).map("".join),
                               st.lists(st.sampled_from(_UNITS), min_size=1, max_size=4).map("".join)),
                     min_size=1, max_size=8),
       hays=st.lists(st.tuples(st.text(st.sampled_from(_HAY), max_size=10), st.text(st.sampled_from(_HAY), max_size=10)),
                     min_size=1, max_size=12))
def test_regex_match_property(spark, pats, hays):
    probe = spark.createDataFrame([(k, n, s) for k, (n, s) in enumerate(pats)], "k long, n string, s string")
    build = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(hays)], "author_id long, bn string, bs string")
    got = {r.k: r.author_id for r in first_match_contains(probe, build, [("n", "bn"), ("s", "bs")], "author_id",
                                                          match="regex").collect()}
    want = {}
    for k, (n, s) in enumerate(pats):
        m = [i for i, (bn, bs) in enumerate(hays) if re.search(n, bn) and re.search(s, bs)]
        if m:
            want[k] = min(m)
    assert got == want


def test_regex_match_cases(spark):
    build = spark.createDataFrame([(1, "Jo ", "Smith"), (2, "J. ", "Smith"), (3, 'M{"u}ller', "X"), (4, "Anna", "O'Neil")],
                                  "author_id long, bn string, bs string")
    probe = spark.createDataFrame([(0, "J. ", "Smith"), (1, 'M{\\"u}ller', "X"), (4, "J\\. ", "Smith"), (5, ".", "Neil")],
                                  "k long, n string, s string")
    got = {r.k: r.author_id for r in first_match_contains(probe, build, [("n", "bn"), ("s", "bs")], "author_id",
                                                          match="regex").collect()}
    # "J. " is a wildcard pattern (matches "Jo "); escapes and braces are literal
    assert got == {0: 1, 1: 3, 4: 2, 5: 4}
    wild = spark.createDataFrame([(0, "....", "."), (1, ".", ""), (2, ".....", ".")], "k long, n string, s string")
    got = {r.k: r.author_id for r in first_match_contains(wild, build, [("n", "bn"), ("s", "bs")], "author_id",
                                                          match="regex").collect()}
    assert got == {0: 3, 1: 1, 2: 3}   # 4+ chars: 'M{"u}ller' (id 3) is the first


PATTERNS = ["A (X)", "A+", "An+a", "(An|Be)+na", "[AB]n*a", "A.{2,3}a", "x{0}Anna", "^Ann", "Be?n(na)?", "A[^b]n", "O'N?e", "a{1}",
            "(A(n|m)){1,2}", "M{u}", "B\\(b\\)", "An{2}a b", "-", "A{x"]
NAMES = ["A X", "A (X)", "Anna", "Ana", "AnnAnna", "Benna", "B(b)", "A xya", "O'Neil", "Bnna", "M{u}", "Anna b", "-", "A{x", "", "AmAn"]


def test_regex_groups_classes_and_quantifiers(spark):
    build = spark.createDataFrame([(i, n, "S" + n) for i, n in enumerate(NAMES)], "author_id long, bn string, bs string")
    probe = spark.createDataFrame([(k, p, "S") for k, p in enumerate(PATTERNS)], "k long, n string, s string")
    got = {r.k: r.author_id for r in first_match_contains(probe, build, [("n", "bn"), ("s", "bs")], "author_id",
                                                          match="regex").collect()}
    want = {k: m[0] for k, p in enumerate(PATTERNS) if (m := [i for i, n in enumerate(NAMES) if re.search(p, n)])}
    assert got == want


BAD = ["\\c{c}", "\\d", "a$", "a|b", "(a", "a)", "(?i)a", "*a", "a**", "[a", "[[a]", "a\\", "x^", "a{,3}", "[a&&b]", "()|", "a+*"]


def test_rejected_patterns_are_told(spark):
    build = spark.createDataFrame([(1, "a", "S")], "author_id long, bn string, bs string")
    probe = spark.createDataFrame([(k, p, "S") for k, p in enumerate([*BAD, "a"])], "k long, n string, s string")
    pairs = [("n", "bn"), ("s", "bs")]
    assert {r.n for r in rejected_patterns(probe, ["n", "s"]).collect()} == set(BAD)
    with pytest.raises(ValueError, match=f"{len(BAD)} pattern tuples"):
        first_match_contains(probe, build, pairs, "author_id", match="regex")
    got = first_match_contains(probe, build, pairs, "author_id", match="regex", on_reject="skip")
    assert [(r.k, r.author_id) for r in got.collect()] == [(len(BAD), 1)]
    bare = spark.createDataFrame([("[a-z]+", "x*"), ("..", "."), ("a", "x*")], "n string, s string")
    assert [tuple(r) for r in rejected_patterns(bare, ["n", "s"]).collect()] == [("[a-z]+", "x*")]


def test_shared_opening_makes_no_candidates(spark, monkeypatch):
    """A phrase that opens all needles and all texts must not pair them."""
    opening = "permission is hereby granted to any person obtaining a copy "
    hays = [(i, f"{opening}text number {i * 7919 % 10007} of the collection") for i in range(400)]
    needles = [(1000 + j, f"{opening}needle {j} that no text has") for j in range(50)]
    needles += [(2000 + j, hays[j * 5][1]) for j in range(20)]
    counts = {}

    def counted(df, name):
        out = written_once(df, name)
        if name == "contains-candidates":
            counts[name] = out.count()
        return out

    monkeypatch.setattr(match, "written_once", counted)
    got = contains_pairs(spark.createDataFrame(needles, "nid long, n string"), ["nid"], "n",
                         spark.createDataFrame(hays, "hid long, h string"), ["hid"], "h")
    assert sorted(tuple(r) for r in got.collect()) == [(2000 + j, j * 5) for j in range(20)]
    assert counts["contains-candidates"] <= 2 * len(hays)


def test_name_key_lengths(spark):
    """Needles of every length from empty to longer than a key, in both columns."""
    rng = random.Random(21)
    sur = ["", "L", "Li", "Lin", "Lind", "Lindberg", "berg", "Wei"]
    giv = ["", "J", "J.", "Jun", "June", "Jun Wei", "n W"]
    build = [(i * 7, rng.choice(sur), rng.choice(giv)) for i in range(200)] + [(5, None, "Jun"), (6, "Lin", None)]
    probe = [(k, s, g) for k, (s, g) in enumerate((s, g) for s in sur for g in giv)]
    pd_ = spark.createDataFrame(probe, "k long, Surname string, Names string")
    bd = spark.createDataFrame(build, "author_id long, Surname string, Names string")
    for mode, options in (("contains", {}), ("regex", {})):
        out = first_match_contains(pd_, bd, [("Names", "Names"), ("Surname", "Surname")], "author_id", match=mode, **options)
        hit = (lambda n, h: n in h) if mode == "contains" else (lambda n, h: re.search(n, h) is not None)
        want = {}
        for k, s, g in probe:
            m = [i for i, bs, bg in build if bs is not None and bg is not None and hit(s, bs) and hit(g, bg)]
            if m:
                want[k] = min(m)
        assert {r["k"]: r["author_id"] for r in out.collect()} == want


def _rows_per_name(spark, names):
    """Keyed rows that build rows of these names emit, by the plan's own explode."""
    from bibliospark.operators.match import NAME_GRAM, _gram_array
    df = spark.createDataFrame(names, "a string, b string")
    grams = [_gram_array(F.col(c), k) for c in ("a", "b") for k in range(1, NAME_GRAM + 1)]
    return df.select(F.explode(F.concat(*grams))).count() / len(names)


def test_rows_are_linear_in_name_length(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    ten, forty = (_rows_per_name(spark, [(word(n), word(n)) for _ in range(50)]) for n in (10, 40))
    assert forty <= 4 * 80 and forty <= 5 * ten


def test_id_ranges_find_the_least_id(spark, monkeypatch):
    """Many small ranges give what one gives; a tuple leaves with its first match."""
    from bibliospark.operators import match
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(0, 7)))
    build = [(i * 3, word(), word()) for i in range(400)]
    probe = [(word(), word()) for _ in range(150)] + [("", ""), ("a", ""), ("", "cab"), ("zz", "a")]
    monkeypatch.setattr(match, "FIRST_IDS", 5)
    monkeypatch.setattr(match, "ID_GROWTH", 3)
    b, p = spark.createDataFrame(build, "id long, x string, y string"), spark.createDataFrame(probe, "m string, n string")
    assert len(match._id_ranges(b, "id")) == 5
    got = {(r.m, r.n): r.id for r in match.first_match_contains(p, b, [("m", "x"), ("n", "y")], "id").collect()}
    want = {(m, n): min((i for i, x, y in build if m in x and n in y), default=None) for m, n in probe}
    assert got == {k: v for k, v in want.items() if v is not None}
