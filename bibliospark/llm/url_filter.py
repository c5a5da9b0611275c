"""URL verdicts from host rules and mined association rules (operator 3).

Explicit rules decide first.  For the other URLs, Spark's FP-growth mines
which combinations of URL tokens go with which label; rules of enough support
and confidence, and better than every part of theirs, are kept in an inverted
index (token -> rules) that is joined with the URLs' tokens.  Only DataFrame
and ML operations on the JVM are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, saved

# (verdict, host, path): the most specific rule that fits a URL decides.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# A mined rule needs this share of the labelled URLs, and this many of them whatever their number.
MIN_SUPPORT, MIN_ROWS = 0.005, 25
MIN_CONFIDENCE, MAX_TOKENS_IN_RULE = 0.7, 3
DEFAULT = "allow"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _specific_first(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))


def fitting_rule(host_: Column, path_: Column, rules: Sequence[tuple[str, str, str]], verdict: bool = False) -> Column:
    """The longest rule (host and path) that fits, or its verdict; null if none does.

    A rule fits its host and all subdomains where the path starts with the rule's.
    """
    cases = [
        F.when(
            ((host_ == F.lit(h)) | host_.endswith(f".{h}")) & path_.startswith(p), F.lit(v if verdict else h + p)
        )
        for v, h, p in _specific_first(rules)
    ]
    return F.coalesce(*cases, F.lit(None).cast("string"))


def tokens(url: Column, host_: Column, path_: Column) -> Column:
    """The distinct tokens of a URL: scheme, top domain, domain, host, words of hyphened labels, folders, extension, query names."""
    labels = F.split(host_, r"\.")
    hosts = F.transform(F.array(F.lit(1), F.lit(2), F.size(labels)), lambda k: F.concat(F.lit("host="), F.array_join(F.slice(labels, -F.least(k, F.size(labels)), k), ".")))
    hyphened = F.flatten(F.transform(F.filter(labels, lambda x: x.contains("-")), lambda x: F.split(x, "-")))
    words = F.transform(hyphened, lambda x: F.concat(F.lit("word="), x))
    parts = F.filter(F.split(path_, "/"), lambda x: (x != "") & ~x.rlike(r"\d"))
    folders = F.transform(parts, lambda x: F.concat(F.lit("path="), x))
    query = F.regexp_extract_all(url, F.lit(r"[?&]([^=&#]+)="), F.lit(1))
    asked = F.transform(query, lambda x: F.concat(F.lit("query="), x))
    rest = F.array(
        F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, r"^([^:/?#]+)://", 1))),
        F.concat(F.lit("ext="), F.regexp_extract(path_, r"\.([A-Za-z0-9]{1,5})$", 1)),
    )
    every = F.concat(hosts, words, folders, F.coalesce(asked, F.array().cast("array<string>")), rest)
    return F.array_distinct(F.filter(every, lambda x: x.isNotNull() & ~x.endswith("=")))


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_rows: int = MIN_ROWS,
    min_confidence: float = MIN_CONFIDENCE,
    most_tokens: int = MAX_TOKENS_IN_RULE,
) -> DataFrame:
    """(rule, tokens, n, verdict, confidence, support, alike) mined from ``labelled`` (tokens, verdict).

    Tokens that occur in exactly the same rows (the query names of one URL
    template, say) are mined as one item, else every subset of them would be
    an itemset of its own; ``alike`` lists them for each token of a rule, and
    any of them stands for it.

    A rule of several tokens stays only if its confidence exceeds that of
    every rule on a part of its tokens; so a frequent pair that adds nothing
    to one of its tokens goes.  Tokens in fewer than ``min_support`` of the
    rows take no part, which bounds the rules whatever the number of rows.
    """
    spark = labelled.sparkSession
    empty = "rule long, tokens array<string>, n int, verdict string, confidence double, support double, alike array<array<string>>"
    baskets = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("verdict="), "verdict"))).alias("items"))
    baskets = saved(baskets.filter(F.size("items") > 1).withColumn("row", F.monotonically_increasing_id()), "url-baskets")
    rows = baskets.count()
    if rows < min_rows:
        return spark.createDataFrame([], empty)
    support = max(min_support, min_rows / rows)
    classes = _alike(baskets, support * rows)
    others = [t for first, *rest in classes for t in rest]
    mined = baskets.withColumn("items", F.array_except("items", F.lit(others))) if others else baskets
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(mined)
    is_verdict = F.element_at("consequent", 1).startswith("verdict=")
    of_tokens = ~F.exists("antecedent", lambda x: x.startswith("verdict="))
    found = model.associationRules.filter(is_verdict & of_tokens & (F.size("antecedent") <= most_tokens) & (F.col("lift") > 1.0))
    found = saved(
        found.select(
            F.array_sort("antecedent").alias("tokens"),
            F.substring(F.element_at("consequent", 1), len("verdict=") + 1, 1 << 20).alias("verdict"),
            "confidence",
            "support",
        ),
        "url-rules",
    )
    # a part of a rule holds each of its tokens in the rule: joined by one token, checked by subset
    part = found.select(
        F.explode("tokens").alias("token"), F.col("tokens").alias("part"), F.col("verdict").alias("v"),
        F.col("confidence").alias("c"),
    )
    whole = found.withColumn("token", F.explode("tokens"))
    beaten = (
        whole.join(part, "token")
        .filter(
            (F.size("part") < F.size("tokens")) & (F.col("v") == F.col("verdict")) & (F.col("c") >= F.col("confidence"))
            & (F.size(F.array_except("part", "tokens")) == 0)
        )
        .select("tokens", "verdict").distinct()
    )
    kept = found.join(beaten, ["tokens", "verdict"], "left_anti")
    sets = [x for members in classes for x in (F.lit(members[0]), F.lit(members))]
    alike = F.transform("tokens", lambda t: F.coalesce(F.try_element_at(F.create_map(*sets), t), F.array(t)) if sets else F.array(t))
    return saved(
        kept.select(
            F.xxhash64("tokens", "verdict").alias("rule"), "tokens", F.size("tokens").alias("n"), "verdict", "confidence", "support",
            alike.alias("alike"),
        ),
        "url-kept-rules",
    )


def _alike(baskets: DataFrame, least: float) -> list[list[str]]:
    """Tokens that occur in the same rows of ``baskets`` (row, items) as another one, in classes; the first stands for all.

    Told by two sums of row hashes.  Only tokens in ``least`` rows or more are
    looked at, so there are at most as many as (tokens of a mean row) / support.
    """
    each = baskets.select("row", F.explode("items").alias("token")).filter(~F.col("token").startswith("verdict="))
    sums = each.groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("one"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("two")
    )
    same = sums.filter(F.col("n") >= least).groupBy("n", "one", "two").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    return sorted(r[0] for r in same.filter(F.size("tokens") > 1).select("tokens").collect())


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined): the verdict of the most confident rule all of whose tokens a URL has.

    ``urls`` has distinct url and tokens.  Ties go to the rule of more
    support, then of more tokens, then of the smaller id.  URLs that no rule matches are
    left out.
    """
    index = rules.select("rule", F.posexplode("alike").alias("place", "tokens")).select("rule", "place", F.explode("tokens").alias("token"))
    seen = urls.select("url", F.explode("tokens").alias("token")).join(index, "token").select("url", "rule", "place").distinct()
    full = seen.groupBy("url", "rule").agg(F.count("*").cast("int").alias("n"))
    hits = full.join(rules.select("rule", "n", "verdict", "confidence", "support"), ["rule", "n"])
    best = hits.groupBy("url").agg(
        F.max(F.struct("confidence", "support", "n", (-F.col("rule")).alias("order"), "verdict")).alias("best")
    )
    return best.select("url", F.col("best.verdict").alias("mined"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    default: str = DEFAULT,
    **mining: float,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    ``rule`` is the longest fitting rule, else null; ``verdict`` is that
    rule's, else the mined one, else ``default``.  Rules are mined from the
    pages that an explicit rule decides, and, of the other pages, from
    ``labels`` (page_id, verdict), where given.  A null url or one without
    ``://`` has empty host and path.  Repeated rows give repeated results.
    """
    here = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    here = here.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    here = here.withColumns(
        {
            "rule": fitting_rule(F.col("host"), F.col("path"), rules),
            "ruled": fitting_rule(F.col("host"), F.col("path"), rules, verdict=True),
        }
    )
    labelled = here.withColumn("verdict", F.col("ruled"))
    if labels is not None:
        given = labels.groupBy("page_id").agg(F.max("verdict").alias("given"))
        labelled = labelled.join(given, "page_id", "left").withColumn("verdict", F.coalesce("ruled", "given"))
    tokenized = labelled.filter(F.col("verdict").isNotNull() & F.col("url").isNotNull())
    mined = mine_rules(tokenized.select(tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), "verdict"), **mining)
    open_ = here.filter(F.col("rule").isNull() & F.col("url").isNotNull()).select("url", "host", "path").distinct()
    verdicts = match_rules(open_.select("url", tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")), mined)
    return here.join(verdicts, "url", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "mined", F.lit(default)).alias("verdict")
    )
