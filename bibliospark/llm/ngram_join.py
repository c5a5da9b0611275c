"""N-gram Jaccard join by vertical partitioning (operator 1).

A document's set is its distinct word n-grams, as 64-bit hashes; the order of
the hashes is the global n-gram order, and ``fragments`` equal ranges of it
are the vertical partitions.  Overlaps are counted in each fragment and summed
per pair.

1. Documents with equal sets are one class; only classes are compared.
2. An n-gram that no other class has is a certain difference, and a linked
   class can afford few.  They are counted in the first fragments; classes
   over their allowance go, and the rest are counted in all fragments.
3. Each remaining class emits its rarest shared n-grams, one more than its
   allowance, so linked classes meet at one.  Where classes meet, each is
   compared with one leader only (the class with the fewest certain
   differences), never all with all: (class, leader) pairs get their partial
   overlaps, and the n-grams in which they differ.
4. Two classes of such a block that do not both link with its leader can link
   only if they share many of their differences from it, hence one among the
   rarest of each, at positions that sum up to their distance at most.  The
   members that share such a difference are compared with a few further leaders,
   then with several, then with many; only members that the links found so far
   leave in different components are, and only where both positions allow it.
   So a family is settled by one leader, and no pair of siblings is formed.

So a group of a million near copies costs a row per copy and difference, not
a row per pair, also where it falls into families that do not link; no list
of documents is collected anywhere, and joins on a leader, an n-gram or a
class are dealt by a salt as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, as_binary, hash_words, looked_up, saved, unused

FRAGMENTS, FIRST = 16, 4
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def ngram_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes (int64) of the word n-grams; one of the whole sequence if it is shorter.

    Words are what ASCII blanks leave, A-Z lower-cased.  Null or blank texts
    have an empty set.
    """
    words = text.lower().split() if text else []  # on bytes: ASCII blanks and letters alone
    if not words:
        return np.empty(0, np.int64)
    hashes = hash_words(words)
    size = min(n, len(hashes))
    grams = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        grams = (grams ^ hashes[i : len(hashes) - size + 1 + i]) * _MULTIPLIER
        grams ^= grams >> np.uint64(29)
    return np.unique(grams.view(np.int64))


def _allowance(size: Column, percent: int) -> Column:
    """The most n-grams of a set of this size that a linked set may lack."""
    return F.floor(size * (100 - percent) / 100).cast("long")


def _least_overlap(sizes: Column, percent: int) -> Column:
    """The least overlap with which two sets of together ``sizes`` n-grams link."""
    return F.ceil(sizes * percent / (100 + percent)).cast("long")


def _first_range(first: int, fragments: int) -> int:
    """The first ``first`` of ``fragments`` equal ranges of int64 end below this hash."""
    return -(1 << 63) + ((1 << 64) // fragments) * first


def document_sets(docs: DataFrame, n: int, below: int | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, class_a, class_b, grams): the set's size, 128 bits that identify it, its n-grams below a bound."""

    def run(batches):
        for batch in batches:
            sizes, keys, grams = [], [], []
            for t in as_binary(batch, "text"):
                s = ngram_set(t, n)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                grams.append(s if below is None else s[: np.searchsorted(s, below)])
            both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            ends = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.ascontiguousarray(both[:, 0])),
                    pa.array(np.ascontiguousarray(both[:, 1])),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*grams, np.empty(0, np.int64)]))),
                ],
                names=["doc_id", "size", "class_a", "class_b", "grams"],
            )

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return arrow_map(named, run, "doc_id long, size long, class_a long, class_b long, grams array<long>")


def _survivors(postings: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``classes`` (id, size, ...) whose n-grams in ``postings`` (gram, id) that no other class has are within their allowance."""
    alone = (
        postings.groupBy("gram").agg(F.min("id").alias("id"), F.max("id").alias("other"))
        .filter("id = other").groupBy("id").agg(F.count("*").alias("alone"))
    )
    judged = classes.join(alone, "id", "left").withColumn("alone", F.coalesce("alone", F.lit(0).cast("long")))
    return judged.filter(F.col("alone") <= _allowance(F.col("size"), percent))


def cells(pairs: DataFrame, segments: DataFrame, fragments: int) -> DataFrame:
    """(a, b, fragment, x, y): what ``a`` and ``b`` of each pair have in each fragment.

    ``segments`` (id, fragment, grams) are the vertical partitions of the
    sets.  A long set is spread over its fragments, so no row holds all of it.
    """
    none = F.array().cast("array<bigint>")
    every = pairs.select("a", "b", F.explode(F.sequence(F.lit(-fragments // 2), F.lit(fragments // 2 - 1))).alias("fragment"))
    left = segments.select(F.col("id").alias("a"), "fragment", F.col("grams").alias("x"))
    # a leader stands in many pairs, and few are leaders
    leaders = saved(pairs.select("b").distinct(), "ngram-leaders")
    right = segments.select(F.col("id").alias("b"), "fragment", F.col("grams").alias("y")).join(leaders, "b", "left_semi")
    both = looked_up(every, right, ["b", "fragment"], "a", "left").join(left, ["a", "fragment"], "left")
    return both.select("a", "b", "fragment", F.coalesce("x", none).alias("x"), F.coalesce("y", none).alias("y"))


def overlaps(partial: DataFrame) -> DataFrame:
    """(a, b, overlap): the partial overlaps (a, b, n) of all fragments, summed per pair."""
    return partial.groupBy("a", "b").agg(F.sum("n").cast("long").alias("overlap"))


def linked_components(classes: DataFrame, percent: int, fragments: int = FRAGMENTS) -> DataFrame:
    """(id, component): the smallest id that links between ``classes`` (id, size, grams) reach, for every id with a link.

    Every pair of linked classes is either compared, or already joined by a
    path of links that were found.
    """
    postings = classes.select(F.explode("grams").alias("gram"), "id")
    ranked = saved(_survivors(postings, classes, percent), "ngram-survivors")
    width = (1 << 64) // fragments
    fragment = F.floor(F.col("gram") / F.lit(float(width))).cast("int")
    segments = saved(
        ranked.select("id", F.explode("grams").alias("gram")).groupBy("id", fragment.alias("fragment"))
        .agg(F.collect_list("gram").alias("grams")),
        "ngram-segments",
    )
    sizes = ranked.select("id", "size", "alone")

    # the rarest n-grams of each class, those of no other class counted but not emitted
    postings = segments.select("id", F.explode("grams").alias("gram"))
    shared = postings.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    ordered = postings.join(shared, "gram").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("grams"), F.count("*").alias("shared")
    )
    keep = F.greatest(F.lit(0), _allowance(F.col("size"), percent) + 1 - (F.col("size") - F.col("shared"))).cast("int")
    blocks = saved(
        ordered.join(sizes, "id").select(
            "id", F.col("alone") / F.col("size"), F.explode(F.slice("grams", F.lit(1), keep)["gram"])
        ).toDF("id", "apart", "gram"),
        "ngram-blocks",
    )
    leaders = blocks.groupBy("gram").agg(F.min(F.struct("apart", "id"))["id"].alias("leader"), F.count("*").alias("n"))
    met = blocks.join(leaders.filter("n > 1"), "gram").filter("id <> leader")
    met = saved(met.select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct(), "ngram-met")
    compared, counted = _compared(met, segments, ranked.select("id", "size"), percent, fragments)
    labels = components(counted.filter("linked").select("a", "b"))
    rows = _shared_differences(compared, counted, labels, percent)
    done, leading = met, 4
    while True:
        rows = saved(_active(rows, labels), "ngram-active")
        if rows.isEmpty():
            return labels
        # of two in different components, one is outside the largest
        first = Window.partitionBy("block", "gram").orderBy("apart", "a")
        ahead = rows.filter("not inner").withColumn("place", F.row_number().over(first)).filter(F.col("place") <= leading).drop("place")
        ahead = saved(ahead, "ngram-ahead")
        pairs = saved(_pairs(rows, ahead, percent).join(done, ["a", "b"], "left_anti"), "ngram-pairs")
        _, counted = _compared(pairs, segments, ranked.select("id", "size"), percent, fragments)
        labels = _merged(labels, counted.filter("linked").select("a", "b"))
        # a leader has met all it could link with
        rows = rows.drop("component", "inner").join(ahead.select("block", "gram", "a"), ["block", "gram", "a"], "left_anti")
        done, leading = done.unionByName(pairs), 16 * leading


def _compared(pairs: DataFrame, segments: DataFrame, sizes: DataFrame, percent: int, fragments: int) -> tuple[DataFrame, DataFrame]:
    """Per pair (a, b) and fragment the n-grams in which they differ; per pair whether it links, and the distance."""
    compared = saved(
        cells(pairs.select("a", "b"), segments, fragments).select(
            "a", "b", F.size(F.array_intersect("x", "y")).alias("n"),
            F.concat(F.array_except("x", "y"), F.array_except("y", "x")).alias("differing"),
        ),
        "ngram-compared",
    )
    size_a, size_b = (sizes.select(F.col("id").alias(c), F.col("size").alias(f"size_{c}")) for c in "ab")
    sized = looked_up(overlaps(compared).join(size_a, "a"), size_b, ["b"], "a")
    total = F.col("size_a") + F.col("size_b")
    linked = F.col("overlap") >= _least_overlap(total, percent)
    counted = sized.select("a", "b", "size_a", linked.alias("linked"), (total - 2 * F.col("overlap")).alias("apart"))
    return compared, saved(counted, "ngram-counted")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component of ``a``: itself, where it has no link yet."""
    return rows.join(labels.withColumnRenamed("id", "a"), "a", "left").withColumn("component", F.coalesce("component", "a"))


def _shared_differences(compared: DataFrame, counted: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(block, gram, a, size, apart, at, reach): the rarest differences of each member from its leader (the block),
    where members of several components share them; ``at`` is the position in the member's order."""
    state = saved(_labelled(counted, labels).withColumnRenamed("b", "block"), "ngram-state")
    between = [F.min("component").alias("low"), F.max("component").alias("high")]
    mixed = saved(state.groupBy("block").agg(*between).filter("low <> high").select("block"), "ngram-mixed")
    state = looked_up(state, mixed, ["block"], "a")
    differing = compared.select("a", F.col("b").alias("block"), F.explode("differing").alias("gram"))
    differing = state.select("block", "a", "size_a", "apart", "component").join(differing, ["a", "block"])
    differing = saved(differing, "ngram-differing")
    # differences that no other component has come first in the order, unseen: they move the others' positions up
    rare = differing.groupBy("block", "gram").agg(F.count("*").alias("df"), *between)
    rare = saved(rare.filter("low <> high").select("block", "gram", "df"), "ngram-rare")
    ordered = looked_up(differing, rare, ["block", "gram"], "a").groupBy("block", "a", "size_a", "apart").agg(
        F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("grams")
    )
    # sets that lie farther apart can't link with one of size_a
    reach = F.floor(F.col("size_a") * (100 - percent) / percent).cast("long")
    placed = ordered.select(
        "block", "a", F.col("size_a").alias("size"), "apart", reach.alias("reach"), (F.col("apart") - F.size("grams")).alias("unseen"),
        F.posexplode("grams").alias("i", "g"),
    )
    place = (F.col("unseen") + F.col("i")).alias("at")
    return saved(placed.select("block", F.col("g.gram").alias("gram"), "a", "size", "apart", place, "reach").filter("at <= reach"), "ngram-placed")


def _active(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` that may link with one of another component, and whether theirs is the largest at the shared difference.

    Two members p and q whose first common difference stands at places at_p
    and at_q share too few for a link unless 2 at_p - apart_p + apart_q and
    2 at_q - apart_q + apart_p are within the distance that a link allows.
    """
    rows = saved(_labelled(rows, labels), "ngram-rows")
    key, lead = ["block", "gram"], 2 * F.col("at") - F.col("apart")
    per = rows.groupBy(*key, "component").agg(F.count("*").alias("n"), F.min("apart").alias("near"), F.min(lead).alias("ahead"))
    per = saved(per, "ngram-standing")
    best = saved(per.groupBy(*key).agg(
        F.count("*").alias("components"), F.max(F.struct("n", "component"))["component"].alias("largest"),
        F.min(F.struct("near", "component")).alias("near_1"), F.min(F.struct("ahead", "component")).alias("ahead_1"),
    ).filter("components > 1"), "ngram-best")
    elsewhere = lambda c: F.min(F.when(F.col("component") != F.col(f"{c}_1.component"), F.col(c))).alias(f"{c}_2")
    two = looked_up(per, best, key, "component").groupBy(*key, "largest", "near_1", "ahead_1").agg(elsewhere("near"), elsewhere("ahead"))
    two = saved(two, "ngram-two")
    other = lambda c: F.when(F.col("component") == F.col(f"{c}_1.component"), F.col(f"{c}_2")).otherwise(F.col(f"{c}_1.{c}"))
    able = (lead + other("near") <= F.col("reach")) & (F.col("apart") + other("ahead") <= F.col("reach"))
    return looked_up(rows, two, key, "a").filter(able).select(*rows.columns, (F.col("component") == F.col("largest")).alias("inner"))


def _pairs(rows: DataFrame, ahead: DataFrame, percent: int) -> DataFrame:
    """(a, b) of members and leaders that share a difference, lie in different components and may link."""
    leaders = ahead.select("block", "gram", *[F.col(c).alias(f"{c}_b") for c in ("a", "size", "at", "apart", "component")])
    sizes = F.col("size") + F.col("size_b")
    allowed = sizes - 2 * _least_overlap(sizes, percent)
    fits = (
        (F.col("component") != F.col("component_b"))
        & (2 * F.col("at") - F.col("apart") + F.col("apart_b") <= allowed)
        & (2 * F.col("at_b") - F.col("apart_b") + F.col("apart") <= allowed)
        & (100 * F.least("size", "size_b") >= percent * F.greatest("size", "size_b"))
    )
    met = looked_up(rows, leaders, ["block", "gram"], "a").filter(fits)
    return met.select(F.greatest("a", "a_b").alias("a"), F.least("a", "a_b").alias("b")).distinct()


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Component labels (id, component) after further links (a, b)."""
    ends = saved(links.select("a").unionByName(links.select(F.col("b").alias("a"))).distinct(), "ngram-ends")
    if ends.isEmpty():
        return labels
    known = saved(labels.unionByName(ends.join(labels.select(F.col("id").alias("a")), "a", "left_anti").select("a", F.col("a").alias("component")).toDF("id", "component")), "labels")
    side = {c: known.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab"}
    between = looked_up(saved(links.join(side["a"], "a"), "ngram-between"), side["b"], ["b"], "a").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    joined = components(between.filter("a <> b").distinct()).toDF("component", "lowest")
    after = looked_up(known, joined, ["component"], "id", "left").select("id", F.coalesce("lowest", "component").alias("component"))
    return saved(after, "labels")


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (a, b), for every id in them.

    Each round points every node at the smallest label around it and then at
    that label's own label, so the longest path shrinks by halves; the rounds
    end when no label changes.  A hub's rows are pre-aggregated by minimum.
    """
    if links.isEmpty():
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    edges = saved(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    # a leader has many neighbours
    labels = saved(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        around = looked_up(edges, labels.withColumnsRenamed({"id": "b"}), ["b"], "a").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        lower = labels.join(around, "id").select("id", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("label").alias("lowest"))
        after = saved(lower.join(jump, "low").select("id", F.least("low", "lowest").alias("label"), (F.least("low", "lowest") < F.col("label")).alias("moved")), "labels")
        labels = after.select("id", "label")
        if after.filter("moved").isEmpty():
            return labels.withColumnRenamed("label", "component")


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, fragments: int = FRAGMENTS, first: int = FIRST,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Documents link when 100 * |intersection| >= percent * |union| of their
    word n-gram sets; component_id is the smallest doc_id reachable by links,
    itself included.  Null and blank texts have empty sets and link with
    nothing.  Repeated doc_ids with one text count as one document (and give
    repeated rows); one doc_id with several texts links by the largest of
    their sets (equal sizes: by digest) and has one component, while
    n_shingles stays each row's own.  Rows without a doc_id link with nothing
    and have no component.
    """
    bound = _first_range(first, fragments)
    every = saved(document_sets(docs, n, bound, doc_id, text), "ngram-sets")
    key = ["size", "class_a", "class_b"]
    own = F.struct(*key)
    several = every.filter("doc_id is not null").groupBy("doc_id").agg(F.max(own).alias("of"), F.min(own).alias("least"))
    several = saved(several.filter("of <> least").select("doc_id", "of"), "ngram-several")
    judged = every.join(several, "doc_id", "left").withColumn("n_shingles", F.col("size"))
    judged = judged.withColumn("stands", F.col("of").isNull() | (F.col("of") == own))
    judged = judged.withColumns({k: F.coalesce(F.col("of")[k], F.col(k)) for k in key})
    sets = judged.filter("stands and size > 0 and doc_id is not null")
    classes = sets.groupBy(*key).agg(F.min("doc_id").alias("id"))
    leading = sets.select("class_a", F.explode("grams").alias("gram"))
    # in the first fragments class_a stands for the class: no join is needed to count
    alone = (
        leading.groupBy("gram").agg(F.min("class_a").alias("class_a"), F.max("class_a").alias("other"))
        .filter("class_a = other").groupBy("class_a").agg(F.count("*").alias("alone"))
    )
    kept = classes.join(alone, "class_a", "left").filter(
        F.coalesce("alone", F.lit(0)) <= _allowance(F.col("size"), percent)
    )
    kept = saved(kept.select("id").distinct(), "ngram-kept")
    wanted = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(
        kept.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"
    )
    whole = document_sets(wanted, n, None).join(several, "doc_id", "left").filter(F.col("of").isNull() | (F.col("of") == own))
    whole = whole.withColumnRenamed("doc_id", "id")
    whole = saved(whole.select("id", "size", "grams").dropDuplicates(["id"]), "ngram-whole")
    found = linked_components(whole, percent, fragments)
    members = classes.join(found, "id", "left").select(*key, F.coalesce("component", "id").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    # a class may hold a third of all documents; empty sets belong to none
    return looked_up(judged.select("doc_id", "n_shingles", *key), members, key, "doc_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id")
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with the smallest doc_id.

    Repeated rows of that doc_id, and rows without a doc_id, stay.
    """
    groups = near_duplicates(docs, n, percent)
    name = unused(docs, "gone")
    gone = groups.filter("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")
