"""Exact substring ("contains") joins without a nested loop.

Long texts (``contains_pairs``, ``min_contained``): pairs with
``instr(haystack, needle) > 0`` are found by an equi join on character grams
and then verified.

* A haystack emits its ``GRAM``-character grams at every ``STRIDE``-th
  position; those that occur in no needle are dropped at once.
* If a long needle (at least ``WINDOW`` characters) occurs, each of its
  windows of ``WINDOW`` characters covers a sampled position, so one of the
  window's ``STRIDE`` grams is among the haystack's.  Any one window is
  enough: each needle joins by its *rarest* window, by counts over all
  haystacks, and is done when a window occurs nowhere.  A phrase that opens
  every needle and every haystack thus makes no candidates.
* A shorter needle joins by its rarest gram of min(length, GRAM) characters
  against the haystacks' grams at all positions.

Names (``first_match_contains``): per distinct needle tuple, the least build
id whose columns contain (or, in regex mode, match) every needle.

* A build row emits the grams of each of its columns, at most ``NAME_GRAM`` per
  character, so rows grow with a name's length and not with products of
  lengths; only grams that some needle chose are shuffled.
* A needle tuple joins by its rarest gram in any of its columns, by counts over
  all build rows, and is done when a gram occurs nowhere.  The match is
  verified inside that join.
* Build rows come in ascending ranges of ids, each ``ID_GROWTH`` times the one
  before.  A tuple that finds its match leaves, as no later id is less.  So a
  common short name meets the first rows alone, and what reaches the last,
  largest range is rare there.

There is one path at every size, and no limit on candidates.  An empty
needle, which everything contains, is resolved as an aggregate instead of
emitting all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from bibliospark.session import written_once

GRAM = 8
STRIDE = 8
WINDOW = GRAM + STRIDE - 1
# Characters of a name's grams; build rows of the first range of ids, and the growth of the next ones.
NAME_GRAM = 4
FIRST_IDS, ID_GROWTH = 1 << 16, 16


def _gram_array(col: Column, k: int, step: int = 1) -> Column:
    """Distinct k-grams at positions 0, step, 2*step, ... (while p + k <= length).

    One linear regex scan: the lookahead captures k characters, the match
    then consumes ``step`` (``step <= k``, so a captured gram always leaves
    room for the step).  Per-position ``substr`` would be quadratic on long
    texts: UTF-8 code point offsets are found by scanning from the start."""
    assert 1 <= step <= k
    if step == k:   # back-to-back grams: a plain consuming match is cheaper than a lookahead
        return F.array_distinct(F.regexp_extract_all(col, F.lit(f"(?s).{{{k}}}"), F.lit(0)))
    return F.array_distinct(F.regexp_extract_all(col, F.lit(f"(?s)(?=(.{{{k}}})).{{{step}}}"), F.lit(1)))


def _candidates(grams: DataFrame, nk: Sequence[str], hay_grams: DataFrame, hk: Sequence[str], window: int) -> DataFrame:
    """(nk..., hk...) of the haystacks that have a gram of the needle's rarest window.

    ``grams`` is (nk..., at, g): every gram of each needle; a window is
    ``window`` consecutive ones."""
    # written, so that the planner knows whether it is small enough to broadcast
    wanted = written_once(grams.select("g").distinct(), "needle-grams")
    hits = written_once(hay_grams.join(wanted, "g", "left_semi"), "gram-hits")
    seen = hits.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    counted = grams.join(seen, "g", "left").select(*nk, F.struct("at", "g", F.coalesce("n", F.lit(0)).alias("n")).alias("x"))
    ordered = counted.groupBy(*nk).agg(F.array_sort(F.collect_list("x")).alias("x"))
    cost = F.transform(
        F.sequence(F.lit(1), F.size("x") - window + 1),
        lambda i: F.struct(
            F.aggregate(F.slice("x", i, window), F.lit(0).cast("bigint"), lambda a, y: a + y["n"]).alias("n"), i.alias("i")
        ),
    )
    rarest = ordered.withColumn("w", F.array_min(cost)).filter("w.n > 0")
    keys = rarest.select(*nk, F.explode(F.array_distinct(F.slice("x", F.col("w.i"), window)["g"])).alias("g"))
    return keys.join(hits, "g").select(*nk, *hk).distinct()


def contains_pairs(needles: DataFrame, nk: Sequence[str], ncol: str, hays: DataFrame, hk: Sequence[str],
                   hcol: str) -> DataFrame:
    """Verified (nk..., hk...) pairs with ``hcol`` containing the non-empty
    needle ``ncol`` (empty needles are excluded; see module docstring).
    ``nk`` and ``hk`` identify the rows of either side."""
    assert not set(nk) & set(hk), "needle and haystack keys must have distinct names"
    n = needles.select(*nk, F.col(ncol).alias("needle")).filter(F.char_length("needle") > 0)
    h = hays.select(*hk, F.col(hcol).alias("hay")).dropna(subset=["hay"])
    m = F.char_length("needle")

    every = F.transform(F.sequence(F.lit(0), m - GRAM), lambda o: F.struct(o.alias("at"), F.substr(F.col("needle"), o + 1, F.lit(GRAM)).alias("g")))
    long_grams = n.filter(m >= WINDOW).select(*nk, F.explode(every).alias("e")).select(*nk, "e.*")
    sparse = h.select(*hk, F.explode(_gram_array(F.col("hay"), GRAM, STRIDE)).alias("g"))
    parts = [_candidates(long_grams, nk, sparse, hk, STRIDE)]

    # shorter needles: the few gram lengths in use, all in one explode (a
    # gram's length is part of its value, so one join serves every length)
    short = n.filter(m < WINDOW).withColumn("k", F.least(m, F.lit(GRAM)))
    lengths = sorted(r[0] for r in short.select("k").distinct().collect())   # GRAM values at most
    if lengths:
        every = F.transform(F.sequence(F.lit(0), m - F.col("k")), lambda o: F.struct(o.alias("at"), F.substr(F.col("needle"), o + 1, F.col("k")).alias("g")))
        short_grams = short.select(*nk, F.explode(every).alias("e")).select(*nk, "e.*")
        dense = h.select(*hk, F.explode(F.concat(*[_gram_array(F.col("hay"), k) for k in lengths])).alias("g"))
        parts.append(_candidates(short_grams, nk, dense, hk, 1))
    found = written_once(reduce(DataFrame.unionByName, parts), "contains-candidates")
    return h.join(found, list(hk)).join(n, list(nk)).filter(F.col("hay").contains(F.col("needle"))).select(*nk, *hk)


def min_contained(hays: DataFrame, hay_id: str, hcol: str, needles: DataFrame, needle_id: str, ncol: str,
                  out: str | None = None) -> DataFrame:
    """Per haystack row: the least ``needle_id`` whose text it contains
    (haystacks with no contained needle are absent)."""
    out = out or needle_id
    # identical needle texts match identically: keep the least id per text
    needles = needles.groupBy(ncol).agg(F.min(needle_id).alias(needle_id))
    best = contains_pairs(needles, [needle_id], ncol, hays, [hay_id], hcol).groupBy(hay_id).agg(
        F.min(needle_id).alias(out))
    empty = needles.filter(F.col(ncol) == "").agg(F.min(needle_id)).first()[0]
    if empty is None:
        return best
    # an empty needle is in every non-null haystack: a literal, not a join
    # that would pair it with every haystack row
    every = hays.filter(F.col(hcol).isNotNull()).select(hay_id, F.lit(empty).alias(out))
    return every.unionByName(best).groupBy(hay_id).agg(F.min(out).alias(out))


# Regex mode.  Names become regular expressions in the reference (a substring
# search).  Supported are the constructs that Java and Python read alike:
# literal characters, ".", a backslash before a non-alphanumeric character,
# plain character classes, groups, "^" at the start, the quantifiers * + ?
# {m} {m,} {m,n} (lazy too) and braces that form none (literal, as in
# Python).  What a match must contain is blocked on: the longest run of
# literals outside groups, classes and optional characters.  Everything
# else (letter and digit escapes, "$", top-level or unbalanced alternatives
# and groups, "(?", nested classes, a quantifier after nothing) is rejected by
# name: see ``rejected_patterns``.
_UNITS = r"(?s)\\.|\[\^?[^\[\]\\&]+\]|\{[0-9]+(?:,[0-9]*)?\}[?]?|[*+?][?]?|."
_GAP = "\u0000"


class _Pattern(NamedTuple):
    ok: Column        # whether Java and Python read it alike
    literal: Column   # the longest run of characters that every match contains
    java: Column      # the pattern for Spark


def _pattern(col: str) -> _Pattern:
    c = F.col(col)
    units = F.regexp_extract_all(c, F.lit(_UNITS), F.lit(0))

    def step(s: Column, u: Column) -> Column:
        counted = u.rlike(r"^(?:[*+?]\??|\{[0-9]+(?:,[0-9]*)?\}\??)$")
        once = u.rlike(r"^(?:\+|\{0*[1-9])")   # the character itself must occur
        gap = (u == ".") | ((F.char_length(u) > 1) & u.startswith("["))
        escaped = u.rlike(r"(?s)^\\[^A-Za-z0-9]$")
        plain = (F.char_length(u) == 1) & ~u.isin("\\", "[", "]", "(", ")", "|", "$", "^", ".")
        first = (s["n"] == 0) & (u == "^")
        depth = s["depth"] + F.when(u == "(", 1).when(u == ")", -1).otherwise(0)
        ok = s["ok"] & (depth >= 0) & (
            (counted & s["can"]) | (~counted & (gap | escaped | plain | first | u.isin("(", ")") | ((u == "|") & (s["depth"] > 0))))
        )
        text = (
            F.when(once, F.concat(s["text"], F.lit(_GAP)))
            .when(counted, F.concat(F.substr(s["text"], F.lit(1), F.greatest(F.char_length(s["text"]) - 1, F.lit(0))), F.lit(_GAP)))
            .when((s["depth"] > 0) | u.isin("(", ")", "^", ".", "|") | gap, F.concat(s["text"], F.lit(_GAP)))
            .otherwise(F.concat(s["text"], F.when(escaped, F.substr(u, F.lit(2), F.lit(1))).otherwise(u)))
        )
        can = ~counted & ~u.isin("(", "|", "^")
        java = F.concat(s["java"], F.when(~counted & u.isin("{", "}"), F.concat(F.lit("\\"), u)).otherwise(u))
        return F.struct(ok.alias("ok"), (s["n"] + 1).alias("n"), depth.alias("depth"), can.alias("can"), text.alias("text"), java.alias("java"))

    start = F.struct(F.lit(True).alias("ok"), F.lit(0).alias("n"), F.lit(0).alias("depth"), F.lit(False).alias("can"),
                     F.lit("").alias("text"), F.lit("").alias("java"))
    read = F.aggregate(units, start, step)
    ok = read["ok"] & (read["depth"] == 0) & ~c.contains("(?") & ~c.rlike(r"\{,[0-9]") & (F.array_join(units, "") == c)
    runs = F.split(read["text"], _GAP)
    longest = F.element_at(F.array_sort(F.transform(
        runs, lambda r: F.struct((-F.char_length(r)).alias("n"), r.alias("r")))), 1).getField("r")
    return _Pattern(ok, longest, read["java"])


def _without_literal(cols: Sequence[str]) -> Column:
    """Whether none of the patterns has a literal, though not all are mere dots."""
    bare = reduce(lambda a, b: a & b, [_pattern(c).literal == "" for c in cols])
    dots = reduce(lambda a, b: a & b, [F.col(c).rlike(r"^\.*$") for c in cols])
    return bare & ~dots


def rejected_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct tuples of patterns that regex mode does not search for (see
    the comment above), among them those without any literal to search by."""
    readable = reduce(lambda a, b: a & b, [_pattern(c).ok for c in cols])
    return df.select(*cols).dropna().distinct().filter(~readable | _without_literal(cols))


def _wildcard_only_best(wild: DataFrame, ncols: Sequence[str], bcols: DataFrame, build_id: str,
                        hcols: Sequence[str], out: str) -> DataFrame:
    """Least build id for regex tuples whose patterns are only dots.

    A pattern of d dots matches a value iff some newline-free segment has at
    least d characters (``.`` excludes only the newline, as in Python).  Each
    build row is reduced to its longest segment per column, no longer than
    the longest pattern in use; every cell (tiny by construction) emits the
    threshold tuples it satisfies, and the least id per threshold tuple is
    joined to the patterns: exact, and no pattern ever meets a build row."""
    ds = [f"d{i}" for i in range(len(hcols))]
    wild = wild.select(*ncols, *[F.char_length(F.col(c)).alias(d) for c, d in zip(ncols, ds)])
    most = wild.agg(*[F.max(d).alias(d) for d in ds]).first()
    cells = bcols.select(build_id, *[
        F.least(F.array_max(F.transform(F.split(F.col(h), "\n", -1), lambda x: F.char_length(x))),
                F.lit(most[d] or 0)).alias(d) for h, d in zip(hcols, ds)])
    cells = cells.groupBy(*ds).agg(F.min(build_id).alias(out))
    for d in ds:   # a cell satisfies every smaller threshold too
        cells = cells.withColumn(d, F.explode(F.sequence(F.lit(0), F.col(d))))
    least = cells.groupBy(*ds).agg(F.min(out).alias(out))
    return wild.join(least, ds).select(*ncols, out)


class PreparedBuild(NamedTuple):
    """Distinct build tuples (least id each), written once; reusable by
    several ``first_match_contains`` calls on the same build columns."""
    tuples: DataFrame
    columns: list[str]
    build_id: str


def prepare_build(build: DataFrame, columns: Sequence[str], build_id: str) -> PreparedBuild:
    """Collapse identical build tuples to their least id and write them
    (columns renamed ``_bs_h_0``, ``_bs_h_1``, ... in ``columns`` order)."""
    hcols = [f"_bs_h_{i}" for i in range(len(columns))]
    tuples = build.select(build_id, *[F.col(b).alias(h) for b, h in zip(columns, hcols)]).groupBy(*hcols).agg(
        F.min(build_id).alias(build_id))
    return PreparedBuild(written_once(tuples, "match-build"), list(columns), build_id)


def _id_ranges(tuples: DataFrame, build_id: str) -> list[Column]:
    """Conditions on ``build_id``: ascending ranges that hold about FIRST_IDS rows, then ID_GROWTH times more each."""
    n, shares = tuples.count(), []
    if n > FIRST_IDS and isinstance(tuples.schema[build_id].dataType, NumericType):
        size = FIRST_IDS
        while size < n:
            shares.append(size / n)
            size *= ID_GROWTH
    bounds = sorted(set(tuples.agg(F.percentile_approx(build_id, shares, 10_000)).first()[0])) if shares else []
    c, steps = F.col(build_id), [None, *bounds, None]
    both = [(F.lit(True) if a is None else c > F.lit(a)) & (F.lit(True) if b is None else c <= F.lit(b)) for a, b in zip(steps, steps[1:])]
    return both


def _literal_matches(tuples: DataFrame, literals: Sequence[str], hcols: Sequence[str], bcols: DataFrame, build_id: str,
                     verify: Column, out: str) -> DataFrame:
    """(_bs_t, out): the least build id per needle tuple that has a literal."""
    def keyed(i: int, grams: Column) -> Column:   # a gram's column and length are part of its key
        return F.transform(grams, lambda g: F.concat(F.lit(f"{i}:"), g))

    def needle_grams(i: int) -> Column:
        c, k = F.col(literals[i]), F.least(F.char_length(literals[i]), F.lit(NAME_GRAM))
        every = F.transform(F.sequence(F.lit(1), F.char_length(c) - k + 1), lambda at: F.substr(c, at, k))
        return F.when(k > 0, keyed(i, F.array_distinct(every))).otherwise(F.array().cast("array<string>"))

    columns = range(len(literals))
    mine = tuples.select("_bs_t", F.explode(F.concat(*[needle_grams(i) for i in columns])).alias("_bs_key"))
    lengths = [F.collect_set(F.least(F.char_length(x), F.lit(NAME_GRAM))) for x in literals]
    in_use = [sorted(set(ks) - {0}) for ks in tuples.agg(*lengths).first()]   # NAME_GRAM values at most
    grams = [keyed(i, _gram_array(F.col(hcols[i]), k)) for i in columns for k in in_use[i]]
    if not grams:
        return tuples.select("_bs_t", F.lit(None).cast(bcols.schema[build_id].dataType).alias(out)).limit(0)
    emitted = bcols.withColumn("_bs_key", F.explode(F.concat(*grams)))
    wanted = mine.select("_bs_key").distinct()
    counts = emitted.select("_bs_key").join(wanted, "_bs_key", "left_semi").groupBy("_bs_key").agg(F.count(F.lit(1)).alias("n"))
    rarest = mine.join(counts, "_bs_key", "left").groupBy("_bs_t").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "_bs_key")).alias("x"))
    open_ = written_once(tuples.join(rarest.filter("x.n > 0").select("_bs_t", "x._bs_key"), "_bs_t"), "name-keys")
    hits = emitted.join(open_.select("_bs_key").distinct(), "_bs_key", "left_semi")
    found, ranges = [], _id_ranges(bcols, build_id)
    if len(ranges) > 1:
        hits = written_once(hits, "name-hits")
    for i, within in enumerate(ranges):
        best = open_.join(hits.filter(within), "_bs_key").filter(verify).groupBy("_bs_t").agg(F.min(build_id).alias(out))
        if i + 1 < len(ranges):
            best = written_once(best, "name-matches")
            open_ = open_.join(best, "_bs_t", "left_anti")
        found.append(best)
    return reduce(DataFrame.unionByName, found)


def first_match_contains(probe: DataFrame, build: DataFrame | PreparedBuild, pairs: Sequence[tuple[str, str]],
                         build_id: str, out: str | None = None, match: str = "contains", how: str = "inner",
                         on_reject: str = "raise") -> DataFrame:
    """For each probe row, the least ``build_id`` whose build columns contain
    the probe's needles, for every (probe_col, build_col) pair.

    ``match='contains'`` is literal substring matching; ``match='regex'``
    reads the probe values as patterns searched in the build values, as the
    reference does; ``match='exact'`` is plain equality on every pair.
    Patterns outside the supported class raise, or with ``on_reject='skip'``
    find nothing (``rejected_patterns`` lists them).  Rows without a match
    are dropped (``how='inner'``) or kept with a null id (``how='left'``).
    Work is done once per distinct needle tuple, then joined back.
    ``build`` may be a ``prepare_build`` result shared by several calls."""
    out = out or build_id
    ncols = [p for p, _ in pairs]
    hcols = [f"_bs_h_{i}" for i in range(len(pairs))]
    if isinstance(build, PreparedBuild):
        assert build.columns == [b for _, b in pairs] and build.build_id == build_id, "prepared for other columns"
        bcols = build.tuples
    else:
        bcols = prepare_build(build, [b for _, b in pairs], build_id).tuples
    tuples = probe.select(*ncols).dropna().distinct()

    if match == "exact":
        cond = reduce(lambda a, b: a & b, [F.col(p) == F.col(h) for (p, _), h in zip(pairs, hcols)])
        best = tuples.join(bcols, cond).groupBy(*ncols).agg(F.min(build_id).alias(out))
        return probe.join(best, ncols, how)
    if match not in ("contains", "regex"):
        raise ValueError(f"unknown match mode {match!r}")

    literals = [f"_bs_lit_{i}" for i in range(len(pairs))]
    if match == "regex":
        read = [_pattern(n) for n in ncols]
        regexes = [f"_bs_re_{i}" for i in range(len(pairs))]
        supported = reduce(lambda a, b: a & b, [r.ok for r in read]) & ~_without_literal(ncols)
        tuples = written_once(tuples.withColumns({
            **{x: r.literal for x, r in zip(literals, read)}, **{x: r.java for x, r in zip(regexes, read)},
            "_bs_ok": supported, "_bs_t": F.monotonically_increasing_id()}), "match-needles")
        if on_reject == "raise" and (bad := tuples.filter(~F.col("_bs_ok")).select(*ncols).take(3)):
            n = tuples.filter(~F.col("_bs_ok")).count()
            raise ValueError(f"{n} pattern tuples can't be searched for, such as {[tuple(b) for b in bad]}")
        tuples = tuples.filter("_bs_ok")
        verify = reduce(lambda a, b: a & b, [F.regexp_like(F.col(h), F.col(x)) for h, x in zip(hcols, regexes)])
    else:
        tuples = written_once(tuples.withColumns({
            **{x: F.col(n) for x, n in zip(literals, ncols)}, "_bs_t": F.monotonically_increasing_id()}), "match-needles")
        verify = reduce(lambda a, b: a & b, [F.col(h).contains(F.col(n)) for h, n in zip(hcols, ncols)])

    some = reduce(lambda a, b: a | b, [F.char_length(x) > 0 for x in literals])
    complete = reduce(lambda a, b: a & b, [F.col(h).isNotNull() for h in hcols])
    best = _literal_matches(tuples.filter(some), literals, hcols, bcols.filter(complete), build_id, verify, out)
    best = tuples.select(*ncols, "_bs_t").join(best, "_bs_t").drop("_bs_t")
    # tuples without any literal: all needles empty, or patterns of dots alone
    bare = tuples.filter(~some).select(*ncols)
    if match == "regex":
        best = best.unionByName(_wildcard_only_best(bare, ncols, bcols, build_id, hcols, out))
    else:
        least = bcols.filter(complete).agg(F.min(build_id)).first()[0]
        if least is not None:
            best = best.unionByName(bare.withColumn(out, F.lit(least)))
    # null-safe is unnecessary: null needles never match
    return probe.join(best, ncols, how)
