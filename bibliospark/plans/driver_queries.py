"""Every operator run over the shared test tables (whole tables, no subsets).

The publication tables do not exist in the shared data, so each operator,
``QUERIES[name](spark, sf_dir)`` returns the Spark result; ``ORACLE[name]``
is the same question in plain SQL for DuckDB (absent where no SQL twin
exists).  Counts, ranks and ids are bigint on both sides; averages and
ratios are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibliospark.functions import first_char, first_last, first_or_null, first_token, format_rfc1123, last_token
from bibliospark.functions.text import FIRST_TOKEN, LAST_TOKEN
from bibliospark.operators import (
    KeyFilter,
    audit_column,
    audit_key_space,
    author_ids,
    audit_reference,
    audit_unique,
    co_neighbours,
    date_dimension_for,
    dim_distinct,
    dim_first_seen,
    dim_per_row,
    distinct_bitmaps,
    distinct_on,
    distinct_rollup,
    drop_all_duplicates,
    drop_columns,
    drop_nulls,
    enrich_by_lookup,
    filtered_in,
    filtered_not_in,
    first_match_contains,
    flatten_authors,
    flatten_versions,
    graph_edges,
    graph_nodes,
    head_n,
    join_star,
    key_filter,
    left_join_null_safe,
    lookup_exact,
    min_contained,
    min_length,
    nullify,
    profile,
    reference_summary,
    relations,
    row_not_in,
    sample_n,
    stable_ids,
    top_nodes,
)
from bibliospark.operators.datedim import with_date_attributes
from bibliospark.plans import pipeline_queries, source_queries
from bibliospark.plans.warehouse_queries import lowest_ranked, proportions, rank_by_sum, star_stats, top_groups
from bibliospark.session import scratch_path, written_once
from bibliospark.sources import conform, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = " ".join(sql.split())
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


# ---------------------------------------------------------------- cleaning

@query("title_min_length", """
    SELECT doc_id, CAST(length(text) AS BIGINT) AS title_len FROM documents WHERE length(text) >= 350""")
def title_min_length(spark, sf):
    return min_length(_t(spark, sf, "documents"), "text", 350).select(
        "doc_id", F.char_length("text").cast("bigint").alias("title_len"))


@query("drop_all_duplicates", """
    SELECT doc_id, lang, source FROM (
      SELECT doc_id, lang, source, count(*) OVER (PARTITION BY text, lang) AS c FROM documents) WHERE c = 1""")
def drop_all_duplicates_q(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return drop_all_duplicates(docs, exclude=["doc_id", "source"]).select("doc_id", "lang", "source")


@query("first_last_version", """
    SELECT conv_id, turn, string_split(text, chr(10))[1] AS publ_date,
           string_split(text, chr(10))[-1] AS publ_lastupdate FROM conversations""")
def first_last_version(spark, sf):
    conv = _t(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.transform(F.split("text", "\n", -1), lambda x: F.struct(x.alias("created"))).alias("versions"))
    first, last = first_last("versions", "created")
    return conv.select("conv_id", "turn", first.alias("publ_date"), last.alias("publ_lastupdate"))


@query("drop_columns", """
    SELECT doc_id, lang, source FROM documents""")
def drop_columns_q(spark, sf):
    """unused fields dropped before any work (an absent name is ignored)."""
    return drop_columns(_t(spark, sf, "documents"), ["text", "n_chars", "abstract"])


@query("conform_types", """
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
           CAST(c_acctbal AS DECIMAL(12, 2)) AS c_acctbal, c_mktsegment FROM customer""")
def conform_types(spark, sf):
    """a result cast to declared column types."""
    from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType
    schema = StructType([StructField("c_custkey", IntegerType()), StructField("c_nationkey", LongType()),
                         StructField("c_acctbal", DecimalType(12, 2)), StructField("c_mktsegment", StringType())])
    return conform(_t(spark, sf, "customer"), schema)


@query("head_n", """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE nullif(event_type, 'error') IS NOT NULL ORDER BY event_id LIMIT 100""")
def head_n_q(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return head_n(drop_nulls(nullify(ev, "error", ["event_type"]), ["event_type"]), 100, ["event_id"])


@query("first_token_unique", f"""
    SELECT DISTINCT regexp_extract(p_name, '{FIRST_TOKEN}', 1) AS firstname FROM part
    WHERE NOT contains(regexp_extract(p_name, '{FIRST_TOKEN}', 1), 'w')""")
def first_token_unique(spark, sf):
    names = _t(spark, sf, "part").select(first_token("p_name").alias("firstname")).distinct()
    return names.filter(~F.col("firstname").contains("w"))


@query("first_last_token", f"""
    SELECT conv_id, turn, regexp_extract(text, '{FIRST_TOKEN}', 1) AS first_token,
           regexp_extract(text, '{LAST_TOKEN}', 1) AS last_token FROM conversations""")
def first_last_token(spark, sf):
    return _t(spark, sf, "conversations").select(
        "conv_id", "turn", first_token("text").alias("first_token"), last_token("text").alias("last_token"))


@query("first_or_null", """
    SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: x IN ('ring', 'red'))[1] AS first_match
    FROM part""")
def first_or_null_q(spark, sf):
    toks = F.filter(F.split("p_name", " "), lambda x: x.isin("ring", "red"))
    return _t(spark, sf, "part").select("p_partkey", first_or_null(toks).alias("first_match"))


@query("json_props", """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props(spark, sf):
    return _t(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


# ---------------------------------------------------------- flatten / ids

_AUTHORS_SQL = """
    a AS (SELECT p_partkey AS id,
                 CASE WHEN p_size > 25 THEN [string_split(p_name, ' '), [p_type]]
                      ELSE [string_split(p_name, ' ')] END AS ap FROM part),
    f AS (SELECT id, unnest(range(1, len(ap) + 1)) AS pos, unnest(ap) AS au FROM a),
    g AS (SELECT id, pos, row_number() OVER (ORDER BY id, pos) - 1 AS gpos, au[1] AS surname,
                 array_to_string(au[2:], ' ') AS names FROM f),
    au AS (SELECT CAST(min(gpos) AS BIGINT) AS author_id, surname, names FROM g GROUP BY surname, names)"""


def _parsed_authors(spark, sf) -> DataFrame:
    """Stand-in for ``authors_parsed``: one or two [surname, names...] lists per part."""
    p = _t(spark, sf, "part")
    one = F.array(F.split("p_name", " "))
    two = F.array(F.split("p_name", " "), F.array("p_type"))
    return p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 25, two).otherwise(one).alias("authors_parsed"))


def _authors_table(spark, sf) -> tuple[DataFrame, DataFrame]:
    pubs = _parsed_authors(spark, sf)
    flat = flatten_authors(pubs, surname="surname", names="names")
    return flat, author_ids(pubs, surname="surname", names="names")


@query("author_flatten", f"WITH {_AUTHORS_SQL} SELECT author_id, surname, names FROM au")
def author_flatten(spark, sf):
    return _authors_table(spark, sf)[1]


@query("author_bridge", f"""
    WITH {_AUTHORS_SQL}
    SELECT g.id AS publication_id, min(au.author_id) AS author_id FROM g JOIN au
      ON contains(au.names, g.names) AND contains(au.surname, g.surname)
    GROUP BY g.id, g.pos""")
def author_bridge(spark, sf):
    """Each parsed author -> least author whose Names and Surname contain it."""
    flat, authors = _authors_table(spark, sf)
    m = first_match_contains(flat, authors.withColumnsRenamed({"surname": "a_surname", "names": "a_names"}),
                             [("names", "a_names"), ("surname", "a_surname")], "author_id")
    return m.select(F.col("id").alias("publication_id"), "author_id")


@query("versions_parse", """
    SELECT event_id, date_trunc('second', ts) AS version FROM events""")
def versions_parse(spark, sf):
    ev = _t(spark, sf, "events").select(
        "event_id", F.array(F.struct(F.lit("v1").alias("version"), format_rfc1123("ts").alias("created"))).alias("versions"))
    return flatten_versions(ev, "event_id")


_DIM_TYPE_SQL = """SELECT row_number() OVER (ORDER BY p_type ASC NULLS LAST) AS type_id, p_type AS type_name
                   FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)"""
_DIM_BRAND_SQL = """SELECT row_number() OVER (ORDER BY p_brand ASC NULLS LAST) AS brand_id, p_brand AS brand_name
                    FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)"""


@query("dim_per_row", """
    SELECT row_number() OVER (ORDER BY p_brand ASC NULLS LAST, p_partkey) AS brand_id, p_brand AS brand_name FROM part""")
def dim_per_row_q(spark, sf):
    return dim_per_row(_t(spark, sf, "part"), "p_brand", ["p_partkey"], "brand_id", "brand_name")


@query("dim_distinct", _DIM_TYPE_SQL)
def dim_distinct_q(spark, sf):
    return dim_distinct(_t(spark, sf, "part"), "p_type", "type_id", "type_name")


@query("dim_first_seen", """
    SELECT row_number() OVER (ORDER BY f) - 1 AS type_id, p_type AS type_name
    FROM (SELECT p_type, min(p_partkey) AS f FROM part GROUP BY p_type)""")
def dim_first_seen_q(spark, sf):
    return dim_first_seen(_t(spark, sf, "part"), "p_type", "p_partkey", "type_id", "type_name")


@query("fact_build", f"""
    WITH t AS ({_DIM_TYPE_SQL}), b AS ({_DIM_BRAND_SQL})
    SELECT p_partkey, t.type_id, b.brand_id FROM part
    LEFT JOIN t ON p_type = t.type_name LEFT JOIN b ON p_brand = b.brand_name""")
def fact_build(spark, sf):
    part = _t(spark, sf, "part")
    dt = dim_distinct(part, "p_type", "type_id", "type_name")
    db = dim_distinct(part, "p_brand", "brand_id", "brand_name")
    fact = join_star(part.select("p_partkey", "p_type", "p_brand"),
                     [(dt, "p_type", "type_name"), (db, "p_brand", "brand_name")])
    return fact.select("p_partkey", "type_id", "brand_id")


# ----------------------------------------------------------------- dedupe

@query("distinct_on", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
      FROM lineitem) WHERE rn = 1""")
def distinct_on_q(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return distinct_on(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query("row_not_in", """
    SELECT e.event_id FROM events e WHERE NOT EXISTS (
      SELECT 1 FROM (SELECT event_type, max(user_id) AS user_id FROM events GROUP BY event_type) s
      WHERE s.event_type IS NOT DISTINCT FROM e.event_type AND s.user_id IS NOT DISTINCT FROM e.user_id)""")
def row_not_in_q(spark, sf):
    ev = _t(spark, sf, "events")
    top = ev.groupBy("event_type").agg(F.max("user_id").alias("user_id"))
    return row_not_in(ev.select("event_id", "event_type", "user_id"), top, ["event_type", "user_id"]).select("event_id")


def _returned(spark, sf):
    """(part, supplier) pairs that were ever returned, with the filter kept beside them."""
    line = _t(spark, sf, "lineitem")
    pairs = written_once(line.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey").distinct(), "returned")
    path = scratch_path(spark, "returned-filter")
    key_filter(pairs, ["l_partkey", "l_suppkey"]).save(path)
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), pairs, KeyFilter.load(spark, path)


@query("filtered_not_in", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE NOT EXISTS (
      SELECT 1 FROM (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem WHERE l_returnflag = 'R') r
      WHERE p IS NOT DISTINCT FROM l_partkey AND s IS NOT DISTINCT FROM l_suppkey)""")
def filtered_not_in_q(spark, sf):
    line, pairs, kept = _returned(spark, sf)
    return filtered_not_in(line, pairs, ["l_partkey", "l_suppkey"], kept)


@query("filtered_in", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE EXISTS (
      SELECT 1 FROM (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem WHERE l_returnflag = 'R') r
      WHERE p IS NOT DISTINCT FROM l_partkey AND s IS NOT DISTINCT FROM l_suppkey)""")
def filtered_in_q(spark, sf):
    line, pairs, kept = _returned(spark, sf)
    return filtered_in(line, pairs, ["l_partkey", "l_suppkey"], kept)


# ------------------------------------------------------------------ joins

@query("enrich_lookup", """
    SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def enrich_lookup(spark, sf):
    return enrich_by_lookup(_t(spark, sf, "documents").select("doc_id", "lang"), _t(spark, sf, "labels"), "doc_id")


@query("gender_exact", """
    SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE n_name IS DISTINCT FROM 'NATION_1'""")
def gender_exact(spark, sf):
    j = lookup_exact(_t(spark, sf, "supplier").select("s_suppkey", "s_nationkey"),
                     _t(spark, sf, "nation").select("n_nationkey", "n_name"), "s_nationkey", "n_nationkey")
    return j.filter(~F.col("n_name").eqNullSafe("NATION_1")).select("s_suppkey", "n_name")


@query("submatch_min", """
    SELECT d.doc_id, min(b.item_id) AS item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)
    GROUP BY d.doc_id""")
def submatch_min(spark, sf):
    return min_contained(_t(spark, sf, "documents"), "doc_id", "text", _t(spark, sf, "benchmark"), "item_id", "text")


@query("two_pair_match", f"""
    WITH q AS (SELECT p_name, substr(regexp_extract(p_name, '{FIRST_TOKEN}', 1), 1, 1) AS ini,
                      regexp_extract(p_name, '{LAST_TOKEN}', 1) AS sur FROM (SELECT DISTINCT p_name FROM part))
    SELECT q.p_name, min(b.p_partkey) AS author_id FROM q JOIN part b
      ON contains(b.p_name, q.ini) AND contains(b.p_name, q.sur) GROUP BY q.p_name""")
def two_pair_match(spark, sf):
    """Submitter -> author whose Names contain the initial and Surname the last token."""
    part = _t(spark, sf, "part")
    probe = part.select("p_name").distinct().select(
        "p_name", first_char(first_token("p_name")).alias("sub_initial"), last_token("p_name").alias("sub_surname"))
    build = part.select("p_partkey", F.col("p_name").alias("names"), F.col("p_name").alias("surname"))
    m = first_match_contains(probe, build, [("sub_initial", "names"), ("sub_surname", "surname")], "p_partkey",
                             out="author_id")
    return m.select("p_name", "author_id")


@query("regex_pair_match", f"""
    WITH q AS (SELECT p_name, substr(regexp_extract(p_name, '{FIRST_TOKEN}', 1), 1, 1) AS ini,
                      regexp_replace(regexp_extract(p_name, '{LAST_TOKEN}', 1), '^(.).', '\\1.') AS sur
               FROM (SELECT DISTINCT p_name FROM part))
    SELECT q.p_name, min(b.p_partkey) AS author_id FROM q JOIN part b
      ON regexp_matches(b.p_name, q.ini) AND regexp_matches(b.p_name, q.sur) GROUP BY q.p_name""")
def regex_pair_match(spark, sf):
    """J4 in the reference's regex reading: the surname pattern has a wildcard
    (its second character becomes '.'), so "ring" also matches "rang"."""
    part = _t(spark, sf, "part")
    probe = part.select("p_name").distinct().select(
        "p_name", first_char(first_token("p_name")).alias("sub_initial"),
        F.regexp_replace(last_token("p_name"), r"^(.).", "$1.").alias("sub_surname"))
    build = part.select("p_partkey", F.col("p_name").alias("names"), F.col("p_name").alias("surname"))
    m = first_match_contains(probe, build, [("sub_initial", "names"), ("sub_surname", "surname")], "p_partkey",
                             out="author_id", match="regex")
    return m.select("p_name", "author_id")


_REGEX_NAMES = ["A (X)", "A+", "r[aei]ng", "(re|gre)en?", "b.{1,3}e", "^s", "l?ow", "w(hi)?te{1}", "[^a-m]ue"]


@query("regex_search", f"""
    WITH q AS (SELECT unnest({_REGEX_NAMES}) AS pattern)
    SELECT q.pattern, min(p_partkey) AS p_partkey FROM q JOIN part ON regexp_matches(p_name, q.pattern) GROUP BY q.pattern""")
def regex_search(spark, sf):
    """J3's regex reading with groups, classes, anchors and quantifiers, searched in every part name."""
    probe = spark.createDataFrame([(x,) for x in _REGEX_NAMES], "pattern string")
    found = first_match_contains(probe, _t(spark, sf, "part").select("p_partkey", "p_name"), [("pattern", "p_name")],
                                 "p_partkey", match="regex")
    return found.select("pattern", "p_partkey")


@query("null_safe_join", """
    WITH e AS (SELECT event_id, nullif(event_type, 'error') AS et, value FROM events),
         m AS (SELECT et, max(value) AS max_value FROM e GROUP BY et)
    SELECT e.event_id, m.max_value FROM e LEFT JOIN m ON e.et IS NOT DISTINCT FROM m.et""")
def null_safe_join(spark, sf):
    ev = nullify(_t(spark, sf, "events").select("event_id", "event_type", "value"), "error", ["event_type"])
    mx = ev.groupBy("event_type").agg(F.max("value").alias("max_value"))
    return left_join_null_safe(ev.select("event_id", "event_type"), mx, ["event_type"]).select("event_id", "max_value")


# ----------------------------------------------------------------- audits

@query("fk_orphans", """
    SELECT count(*) AS orphan_rows, count(DISTINCT doc_id) AS orphan_keys FROM documents
    WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)""")
def fk_orphans(spark, sf):
    orphans = audit_reference(_t(spark, sf, "documents").select("doc_id"), _t(spark, sf, "labels"), ["doc_id"])
    return reference_summary(orphans, ["doc_id"])


@query("pk_violations", """
    SELECT l_orderkey, l_linenumber, count(*) AS n,
           CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate' END AS reason
    FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def pk_violations(spark, sf):
    return audit_unique(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("audit_column", """
    SELECT CAST(sum(CASE WHEN p_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_rows,
           CAST(sum(CASE WHEN length(p_name) > 10 THEN 1 ELSE 0 END) AS BIGINT) AS too_long_rows FROM part""")
def audit_column_q(spark, sf):
    return audit_column(_t(spark, sf, "part"), "p_name", not_null=True, max_len=10)


# --------------------------------------------------- warehouse questions

@query("sq1_top_groups", """
    SELECT p_type, count(l_orderkey) AS total_publications FROM part JOIN lineitem ON p_partkey = l_partkey
    GROUP BY p_type ORDER BY total_publications DESC, p_type LIMIT 5""")
def sq1_top_groups(spark, sf):
    return top_groups(_t(spark, sf, "part"), _t(spark, sf, "lineitem"), "p_partkey", "l_partkey",
                      "p_type", "l_orderkey", 5)


@query("sq2_top_groups", """
    SELECT p_brand, count(l_orderkey) AS total_publications FROM part JOIN lineitem ON p_partkey = l_partkey
    GROUP BY p_brand ORDER BY total_publications DESC, p_brand LIMIT 3""")
def sq2_top_groups(spark, sf):
    return top_groups(_t(spark, sf, "part"), _t(spark, sf, "lineitem"), "p_partkey", "l_partkey",
                      "p_brand", "l_orderkey", 3)


@query("sq3_proportion", """
    SELECT n_name,
      round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) / count(DISTINCT o_custkey)::DOUBLE, 6)
        AS proportion_urgent,
      round(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) / count(DISTINCT o_custkey)::DOUBLE, 6)
        AS proportion_high
    FROM nation JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey
    GROUP BY n_name""")
def sq3_proportion(spark, sf):
    chain = (_t(spark, sf, "nation")
             .join(_t(spark, sf, "customer"), F.col("n_nationkey") == F.col("c_nationkey"))
             .join(_t(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey")))
    prio = F.col("o_orderpriority")
    return proportions(chain, "n_name", {"proportion_urgent": prio == "1-URGENT", "proportion_high": prio == "2-HIGH"},
                       "o_custkey", digits=6)


@query("sq4_rank", """
    WITH h AS (SELECT l_suppkey,
                      rank() OVER (ORDER BY sum(CAST(floor(o_totalprice) AS BIGINT)) DESC NULLS FIRST) AS hindex
               FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY l_suppkey)
    SELECT s_suppkey, s_name, hindex FROM h JOIN supplier ON l_suppkey = s_suppkey
    ORDER BY hindex DESC, s_suppkey LIMIT 5""")
def sq4_rank(spark, sf):
    fact = _t(spark, sf, "orders").select("o_orderkey", F.floor("o_totalprice").cast("bigint").alias("reference_count"))
    bridge = _t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    ranked = rank_by_sum(fact, bridge, "o_orderkey", "l_orderkey", "l_suppkey", "reference_count")
    return lowest_ranked(ranked, _t(spark, sf, "supplier"), "l_suppkey", "s_suppkey", ["s_name"], 5)


@query("nq1_star", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_name, s_name, o_orderpriority
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN orders ON l_orderkey = o_orderkey""")
def nq1_star(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    star = join_star(li, [(_t(spark, sf, "part").select("p_partkey", "p_name"), "l_partkey", "p_partkey"),
                          (_t(spark, sf, "supplier").select("s_suppkey", "s_name"), "l_suppkey", "s_suppkey"),
                          (_t(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "l_orderkey", "o_orderkey")])
    return star.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "p_name", "s_name", "o_orderpriority")


def _date_key(ts: str):
    return F.date_format(F.col(ts), "yyyyMMdd").cast("int")


@query("nq2_year", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year_actual, round(avg(o_totalprice), 6) AS avg_totalprice,
           round(avg(c_acctbal), 6) AS avg_acctbal, count(*) AS order_count
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def nq2_year(spark, sf):
    orders = _t(spark, sf, "orders")
    dates = date_dimension_for(orders, "o_orderdate").select("date_dim_id", "year_actual")
    fact = orders.select(_date_key("o_orderdate").alias("d_date_key"), "o_custkey", "o_totalprice")
    cust = _t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return star_stats(fact, [(dates, "d_date_key", "date_dim_id"), (cust, "o_custkey", "c_custkey")], "year_actual",
                      {"o_totalprice": "avg_totalprice", "c_acctbal": "avg_acctbal"}, "order_count", digits=6)


@query("nq3_weekday_like", """
    SELECT CAST(isodow(l_shipdate) AS INTEGER) AS day_of_week, round(avg(l_quantity), 6) AS avg_quantity,
           round(avg(l_extendedprice), 6) AS avg_price, count(*) AS line_count
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE p_name LIKE '%ring%' GROUP BY 1""")
def nq3_weekday_like(spark, sf):
    li = _t(spark, sf, "lineitem")
    dates = date_dimension_for(li, "l_shipdate").select("date_dim_id", "day_of_week")
    fact = li.select(_date_key("l_shipdate").alias("d_date_key"), "l_partkey", "l_quantity", "l_extendedprice")
    part = _t(spark, sf, "part").select("p_partkey", "p_name")
    return star_stats(fact, [(dates, "d_date_key", "date_dim_id"), (part, "l_partkey", "p_partkey")], "day_of_week",
                      {"l_quantity": "avg_quantity", "l_extendedprice": "avg_price"}, "line_count",
                      where=F.col("p_name").like("%ring%"), digits=6)


@query("date_dim", r"""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_dim_id, d AS date_actual,
           CAST(epoch(d) AS BIGINT) AS epoch, CAST(isodow(d) AS INTEGER) AS day_of_week,
           CAST(day(d) AS INTEGER) AS day_of_month, CAST(floor((day(d) - 1) / 7) + 1 AS INTEGER) AS week_of_month,
           CAST(week(d) AS INTEGER) AS week_of_year,
           concat(CAST(isoyear(d) AS VARCHAR), '-W', lpad(CAST(week(d) AS VARCHAR), 2, '0'), '-',
                  CAST(isodow(d) AS VARCHAR)) AS week_of_year_iso,
           CAST(month(d) AS INTEGER) AS month_actual, CAST(year(d) AS INTEGER) AS year_actual
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_dim(spark, sf):
    days = _t(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return with_date_attributes(days, "d").drop("d")


@query("profile", """
    SELECT 'p_size' AS column_name, count(p_size) AS count, round(avg(p_size), 6) AS mean,
           round(stddev_samp(p_size), 6) AS std, CAST(min(p_size) AS DOUBLE) AS min,
           round(quantile_cont(p_size, 0.25), 6) AS q25, round(quantile_cont(p_size, 0.5), 6) AS q50,
           round(quantile_cont(p_size, 0.75), 6) AS q75, CAST(max(p_size) AS DOUBLE) AS max FROM part
    UNION ALL
    SELECT 'p_retailprice', count(p_retailprice), round(avg(p_retailprice), 6), round(stddev_samp(p_retailprice), 6),
           min(p_retailprice), round(quantile_cont(p_retailprice, 0.25), 6), round(quantile_cont(p_retailprice, 0.5), 6),
           round(quantile_cont(p_retailprice, 0.75), 6), max(p_retailprice) FROM part""")
def profile_q(spark, sf):
    p = profile(_t(spark, sf, "part"), ["p_size", "p_retailprice"])
    r = ["mean", "std", "q25", "q50", "q75"]
    return p.select(F.col("column").alias("column_name"), "count", *[F.round(c, 6).alias(c) if c in r else F.col(c)
                                                                     for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@query("sample_n", """
    SELECT p_partkey, p_name FROM part ORDER BY md5('42|' || CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 25""")
def sample_n_q(spark, sf):
    return sample_n(_t(spark, sf, "part").select("p_partkey", "p_name"), 25, 42, ["p_partkey"])


# ------------------------------------------------------------------ graph

@query("graph_nodes", """
    SELECT 'supplier' AS label, CAST(s_suppkey AS VARCHAR) AS node_id, s_name AS name FROM supplier
    UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation""")
def graph_nodes_q(spark, sf):
    nodes = graph_nodes({
        "supplier": (_t(spark, sf, "supplier").withColumnRenamed("s_name", "name"), "s_suppkey", ["name"]),
        "nation": (_t(spark, sf, "nation").withColumnRenamed("n_name", "name"), "n_nationkey", ["name"]),
    })
    return nodes.select("label", "node_id", F.col("props")["name"].alias("name"))


@query("graph_edges", """
    SELECT 'supplier' AS src_label, CAST(l_suppkey AS VARCHAR) AS src_id, 'CREATE' AS rel, 'order' AS dst_label,
           CAST(l_orderkey AS VARCHAR) AS dst_id FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) AND l_orderkey IN (SELECT o_orderkey FROM orders)
    UNION ALL
    SELECT 'supplier', CAST(s_suppkey AS VARCHAR), 'PART_OF', 'nation', CAST(s_nationkey AS VARCHAR) FROM supplier
    WHERE s_nationkey IN (SELECT n_nationkey FROM nation)""")
def graph_edges_q(spark, sf):
    supplier, orders, nation = (_t(spark, sf, n) for n in ("supplier", "orders", "nation"))
    nodes = graph_nodes({"supplier": (supplier, "s_suppkey", ["s_name"]),
                         "order": (orders, "o_orderkey", ["o_orderstatus"]),
                         "nation": (nation, "n_nationkey", ["n_name"])})
    return graph_edges([(_t(spark, sf, "lineitem"), "supplier", "l_suppkey", "CREATE", "order", "l_orderkey"),
                        (supplier, "supplier", "s_suppkey", "PART_OF", "nation", "s_nationkey")], nodes)


@query("relations", """
    WITH p AS (SELECT p_partkey, nullif(p_type, 'SMALL') AS ptype, p_brand FROM part),
         dt AS (SELECT row_number() OVER (ORDER BY f) - 1 AS ptype_id, ptype AS ptype_name
                FROM (SELECT ptype, min(p_partkey) AS f FROM p GROUP BY ptype)),
         db AS (SELECT row_number() OVER (ORDER BY f) - 1 AS brand_id, p_brand AS brand_name
                FROM (SELECT p_brand, min(p_partkey) AS f FROM p GROUP BY p_brand))
    SELECT p.p_partkey, dt.ptype_id, db.brand_id FROM p
    LEFT JOIN dt ON p.ptype IS NOT DISTINCT FROM dt.ptype_name
    LEFT JOIN db ON p.p_brand IS NOT DISTINCT FROM db.brand_name""")
def relations_q(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("ptype"), "p_brand")
    dt = dim_first_seen(p, "ptype", "p_partkey", "ptype_id", "ptype_name")
    db = dim_first_seen(p, "p_brand", "p_partkey", "brand_id", "brand_name")
    return relations(p, "p_partkey", [("ptype", dt, "ptype_name", "ptype_id"), ("p_brand", db, "brand_name", "brand_id")])


@query("co_neighbours", """
    SELECT DISTINCT l_suppkey FROM lineitem
    WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey = 7) AND l_suppkey <> 7""")
def co_neighbours_q(spark, sf):
    return co_neighbours(_t(spark, sf, "lineitem").select("l_suppkey", "l_orderkey"), "l_suppkey", "l_orderkey", 7)


@query("top_nodes", """
    SELECT l_suppkey, sum(CAST(floor(o_totalprice) AS DOUBLE)) AS total FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey GROUP BY l_suppkey ORDER BY total DESC, l_suppkey LIMIT 5""")
def top_nodes_q(spark, sf):
    weights = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.floor("o_totalprice").alias("w"))
    return top_nodes(_t(spark, sf, "lineitem").select("l_suppkey", "l_orderkey"), "l_suppkey", "l_orderkey",
                     weights, "w", 5)


@query("stable_ids", """
    WITH first AS (SELECT lang, source, row_number() OVER (ORDER BY lang NULLS FIRST, source NULLS FIRST) AS id
                   FROM (SELECT DISTINCT lang, source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)),
         more AS (SELECT lang, source FROM documents EXCEPT SELECT lang, source FROM first)
    SELECT id AS kind_id, lang, source FROM first
    UNION ALL SELECT (SELECT coalesce(max(id), 0) FROM first) + row_number() OVER (ORDER BY lang NULLS FIRST, source NULLS FIRST), lang, source
    FROM more""")
def stable_ids_q(spark, sf):
    docs, labels = _t(spark, sf, "documents").select("doc_id", "lang", "source"), _t(spark, sf, "labels")
    toxic = docs.join(labels.filter("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    first = stable_ids(toxic, ["lang", "source"], "kind_id")
    return stable_ids(docs, ["lang", "source"], "kind_id", written_once(first, "key-map"))


@query("distinct_rollup", """
    SELECT c_mktsegment, o_orderstatus, count(DISTINCT o_custkey) AS n_customers, count(*) AS n_orders,
           CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS n_urgent
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY GROUPING SETS ((c_mktsegment, o_orderstatus), (c_mktsegment), (o_orderstatus), ())""")
def distinct_rollup_q(spark, sf):
    orders = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    keys, sums = ["c_mktsegment", "o_orderstatus"], {
        "n_orders": F.lit(1), "n_urgent": F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)}
    bits = written_once(distinct_bitmaps(orders, keys, "o_custkey", sums), "bitmaps")
    levels = [distinct_rollup(bits, by, "n_customers", list(sums)) for by in (keys, keys[:1], keys[1:], [])]
    none = {k: F.lit(None).cast("string") for k in keys}
    parts = [df.withColumns({k: v for k, v in none.items() if k not in df.columns}) for df in levels]
    return reduce(DataFrame.unionByName, parts).select(*keys, "n_customers", *sums)


@query("key_space_audit", """
    SELECT 'part_pk' AS audit, (SELECT count(*) FROM (SELECT p_partkey FROM part GROUP BY 1 HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'line_part_fk', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'order_pk', (SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1 HAVING count(*) > 1))
    UNION ALL SELECT 'line_order_fk', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O')
    UNION ALL SELECT 'line_pk', (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1))
    UNION ALL SELECT 'order_line_fk', count(*) FROM orders WHERE o_orderstatus <> 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def key_space_audit_q(spark, sf):
    line, part = _t(spark, sf, "lineitem"), _t(spark, sf, "part")
    orders = _t(spark, sf, "orders").filter(F.col("o_orderstatus") != "O")
    return audit_key_space({"part_pk": (part, "p_partkey")}, {"line_part_fk": (line, "l_partkey", "part_pk")}).unionByName(
        audit_key_space({"order_pk": (orders, "o_orderkey"), "line_pk": (line, "l_orderkey")},
                        {"line_order_fk": (line, "l_orderkey", "order_pk"), "order_line_fk": (orders, "o_orderkey", "line_pk")}))


# -------------------------------------------------------------- pipelines

QUERIES.update(pipeline_queries.QUERIES)
ORACLE.update({name: " ".join(sql.split()) for name, sql in pipeline_queries.ORACLE.items()})

QUERIES.update(source_queries.QUERIES)
ORACLE.update({name: " ".join(sql.split()) for name, sql in source_queries.ORACLE.items()})

FLAGSHIP = "sq1_top_groups"
