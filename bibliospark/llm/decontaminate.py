"""Benchmark decontamination by winnowing (operator 2).

Of every run of ``span`` words the smallest k-gram hash is kept as its
fingerprint, so any ``span`` words shared by a text and an item share a
fingerprint.  Fingerprints of texts and items are joined; each hit is then
extended to the spans whose smallest hash it is, and those are compared word
by word with the items' spans.  Items shorter than ``span`` are one span of
their own length, winnowed with parameters for that length.

DataFrame operations only.  Texts are read twice and shuffled at most once
(not at all while the hits are small enough for Spark to broadcast them);
fingerprints are joined and dropped as they are made.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, saved, unused

SPAN = 13
# Fixed value of the contract: everything in ASCII that is neither a letter nor a digit separates words.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; an empty array for null."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), _SEPARATORS), ""), F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def gram_size(span: int) -> int:
    """Words per k-gram: a window of span - k + 1 grams is then exactly one span."""
    return max(min(span, 4), (span + 1) // 2)


def span_fingerprints(words_: Column, span: int) -> Column:
    """For each span (by its start) the smallest hash of its k-grams; empty if there are fewer words."""
    k = gram_size(span)
    grams = F.transform(
        F.sequence(F.lit(1), F.size(words_) - k + 1), lambda i: F.xxhash64(F.slice(words_, i, k), F.lit(span))
    )
    window = span - k + 1
    smallest = (
        grams
        if window == 1
        else let(
            grams,
            lambda g: F.transform(F.sequence(F.lit(1), F.size(g) - window + 1), lambda i: F.array_min(F.slice(g, i, window))),
        )
    )
    return F.when(F.size(words_) >= span, smallest).otherwise(F.array().cast("array<bigint>"))


def _spans(words_: Column, span: int) -> Column:
    """(print, start, n, text) of each span."""
    return F.transform(
        span_fingerprints(words_, span),
        lambda p, i: F.struct(
            p.alias("print"),
            (i + 1).alias("start"),
            F.lit(span).alias("n"),
            F.array_join(F.slice(words_, i + 1, span), " ").alias("text"),
        ),
    )


def item_spans(items: DataFrame, span: int, item_id: str, text: str) -> DataFrame:
    """(print, n, text, items) of the distinct spans of all items; an item without words has none."""
    split = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("words"))
    every = [
        split.filter(F.size("words") == n if n < span else F.size("words") >= n).select(
            "item", F.explode(_spans(F.col("words"), n)).alias("s")
        )
        for n in range(1, span + 1)
    ]
    rows = reduce(DataFrame.unionByName, every).select("s.print", "s.n", "s.text", "item")
    return rows.groupBy("print", "n", "text").agg(F.array_sort(F.collect_set("item")).alias("items"))


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    span: int = SPAN,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, key, n_words, n_hit, items) of every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of an item's span,
    ``items`` are the ids (as strings, sorted) of the items with an occurring
    span.  A null text has no words.  ``key`` identifies (doc_id, text), so
    rows without an id, and different texts under one id, are told apart;
    repeated rows give repeated results.  Items with a null id occur without
    a name.
    """
    known = saved(item_spans(items, span, item_id, item_text), "benchmark-spans")
    lengths = sorted(r[0] for r in known.select("n").distinct().collect())  # at most ``span`` numbers
    prints = saved(known.select("print").distinct(), "benchmark-prints")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("doc_id", "text"))
    split = words(F.col("text"))
    none = F.array().cast("array<bigint>")
    seen = let(split, lambda w: F.array_distinct(F.concat(none, *[span_fingerprints(w, n) for n in lengths])))
    hits = texts.select("key", F.explode(seen).alias("print")).join(prints, "print", "left_semi")
    hits = saved(hits.groupBy("key").agg(F.collect_set("print").alias("prints")), "benchmark-hits")

    # extension: the spans whose fingerprint was hit, with their words
    extended = let(
        split,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.when(
                F.col("prints").isNotNull(),
                F.concat(
                    F.array().cast("array<struct<print:bigint,start:int,n:int,text:string>>"),
                    *[F.filter(_spans(w, n), lambda s: F.array_contains(F.col("prints"), s["print"])) for n in lengths],
                ),
            ).alias("spans"),
        ),
    )
    judged = saved(
        texts.join(hits, "key", "left").select("doc_id", "key", extended.alias("e")).select("doc_id", "key", "e.*"),
        "benchmark-extended",
    )
    spans = judged.filter(F.size("spans") > 0).select("key", F.explode("spans").alias("s")).select("key", "s.*")
    matched = spans.join(known, ["print", "n", "text"])
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "n"))),
        F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("n_hit")),
        lambda a, s: F.struct(
            F.greatest(a["last"], s["start"] + s["n"] - 1).alias("last"),
            (a["n_hit"] + F.greatest(F.lit(0), s["start"] + s["n"] - 1 - F.greatest(a["last"], s["start"] - 1))).alias("n_hit"),
        ),
    )
    found = matched.groupBy("key").agg(
        covered["n_hit"].alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    return judged.drop("spans").join(found, "key", "left").select(
        "doc_id",
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated(n_hit: Column, n_words: Column, one_in: int = 20) -> Column:
    """At least one word in ``one_in`` is hit."""
    return (n_hit > 0) & (one_in * n_hit >= n_words)


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``."""
    return find_hits(docs, items, span).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` without the contaminated rows; all columns, and all other rows, stay."""
    hits = find_hits(docs, items, span)
    name = unused(docs, "key")
    bad = hits.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("key").alias(name)).distinct()
    return docs.join(bad, F.xxhash64("doc_id", "text") == F.col(name), "left_anti")
