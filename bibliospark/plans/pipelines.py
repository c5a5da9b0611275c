"""The four pipelines, composed from operators.

P1 ``clean_publications``  raw records -> cleaned publications
P2 ``normalise``           publications + lookups -> final table, authors,
                           versions, bridge, author genders, reference counts
P3 ``build_warehouse``     P2 tables -> dimensions, fact, bridge, versions
                           + integrity audits
P4 ``build_graph``         P2 tables -> node and edge tables

Building them runs jobs: operators that need a global order or write an
intermediate once do so eagerly, when their table is first asked for.  Persist the results as Parquet tables with
``sources.save_table`` between runs, as ``plans.run`` does.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibliospark.functions import first_char, first_last, first_or_null, first_token, last_token
from bibliospark.operators import (
    author_ids,
    audit_column,
    audit_key_space,
    audit_reference,
    audit_unique,
    dim_distinct,
    dim_first_seen,
    dim_per_row,
    distinct_on,
    drop_all_duplicates,
    drop_columns,
    drop_nulls,
    enrich_by_lookup,
    first_match_contains,
    flatten_authors,
    flatten_versions,
    graph_edges,
    graph_nodes,
    head_n,
    join_star,
    min_length,
    nullify,
    one_row_per_key,
    prepare_build,
    rejected_patterns,
    relations,
)
from bibliospark.plans.lazy import LazyTables
from bibliospark.session import written_once

# Fixed values taken over from the reference's behaviour.
DROPPED_SOURCE_FIELDS = ["abstract", "update_date", "license"]
DUPLICATE_EXCLUDED = ["id", "versions", "authors_parsed"]
MIN_TITLE_LENGTH = 35
NULL_TOKEN = "None"
UNKNOWN_GENDER = "unknown"
# Text fields that pandas' CSV reader turns into NaN (used for csv_parity).
PANDAS_NA_TEXT = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                  "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


# ---------------------------------------------------------------- P1

def clean_publications(raw: DataFrame, min_title: int = MIN_TITLE_LENGTH, require_authors: bool = False) -> DataFrame:
    """Drop unused source fields, keep titles of ``min_title``+ characters,
    remove every member of a duplicate group (compared without id, versions
    and authors_parsed) and add first / last version dates (by array
    position).  ``require_authors`` also drops rows without authors (the
    reference computes this but discards the result)."""
    df = drop_columns(raw, DROPPED_SOURCE_FIELDS)
    df = min_length(df, "title", min_title)
    df = drop_all_duplicates(df, exclude=[c for c in DUPLICATE_EXCLUDED if c in df.columns])
    if require_authors:
        df = drop_nulls(df, ["authors"])
    first, last = first_last("versions", "created")
    return df.withColumns({"publ_date": first, "publ_lastupdate": last})


# ---------------------------------------------------------------- P2

def _csv_nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    """What a pandas CSV round trip does to text: NA words become null."""
    return df.withColumns({c: F.when(F.col(c).isin(PANDAS_NA_TEXT), None).otherwise(F.col(c)) for c in cols})


def enrich_publications(pubs: DataFrame, doi_lookup: DataFrame, max_publications: int | None = None) -> DataFrame:
    """First half of P2: ``'None'`` text -> null, rows without doi go,
    optionally the first ``max_publications`` by id (the reference keeps
    100), then DOI metadata (reference_count, discipline list,
    publication_type, journal) by left lookup join."""
    df = drop_nulls(nullify(pubs, NULL_TOKEN), ["doi"])
    if max_publications is not None:
        df = head_n(df, max_publications, ["id"])
    return enrich_by_lookup(df, doi_lookup, "doi")


def derive_tables(df: DataFrame, authors: DataFrame, gender_lookup: DataFrame, csv_parity: bool = False,
                  match: str = "contains") -> LazyTables:
    """Second half of P2, from enriched publications and their author table
    (``author_ids(df)``): gender_data, versions, bridge, author_genders,
    final and reference_counts."""
    flat = flatten_authors(df)
    build = _csv_nulls(authors, ["Surname", "Names"]) if csv_parity else authors

    @cache
    def gender_data() -> DataFrame:
        firstnames = df.select(first_token("submitter").alias("firstname")).filter(F.col("firstname") != "")
        # a first name without a lookup row is skipped; one whose gender is null stays
        return firstnames.distinct().filter(~F.col("firstname").contains(".")).join(
            one_row_per_key(gender_lookup.select("firstname", "gender").dropna(subset=["firstname"]), "firstname"),
            "firstname")

    @cache
    def prepared():   # both matches search the same author columns: prepare them once
        return prepare_build(build, ["Names", "Surname"], "author_id")

    def bridge() -> DataFrame:
        found = first_match_contains(flat, prepared(), [("Names", "Names"), ("Surname", "Surname")], "author_id",
                                     match=match, on_reject="skip")
        return found.select(F.col("id").alias("publication_id"), "author_id")

    @cache
    def submitters() -> DataFrame:
        sub = df.select("id", first_token("submitter").alias("sub_name"), last_token("submitter").alias("sub_surname"))
        return sub.filter(F.col("sub_name") != "").withColumn("sub_initial", first_char("sub_name"))

    def author_genders() -> DataFrame:
        sub_author = first_match_contains(submitters(), prepared(), [("sub_initial", "Names"), ("sub_surname", "Surname")],
                                          "author_id", match=match, on_reject="skip")
        return (
            sub_author.join(gender_data().withColumnRenamed("firstname", "sub_name"), "sub_name")
            .filter(~F.col("gender").eqNullSafe(UNKNOWN_GENDER))
            .select("author_id", "gender")
        )

    rejected = {}
    if match == "regex":   # names that are no searchable patterns are listed, not dropped in silence
        rejected["rejected_names"] = lambda: rejected_patterns(flat, ["Names", "Surname"])
        rejected["rejected_submitters"] = lambda: rejected_patterns(submitters(), ["sub_initial", "sub_surname"])

    return LazyTables({
        "reference_counts": lambda: df.select("id", "reference_count"),
        "gender_data": gender_data,
        "versions": lambda: flatten_versions(df),
        "bridge": bridge,
        "author_genders": author_genders,
        "final": lambda: df.select("id", "title", "comments", "doi", "reference_count",
                                   first_or_null("discipline").alias("discipline"), "publication_type", "journal"),
        **rejected,
    })


def normalise(pubs: DataFrame, doi_lookup: DataFrame, gender_lookup: DataFrame, max_publications: int | None = None,
              csv_parity: bool = False, match: str = "contains") -> dict[str, DataFrame]:
    """Enrichment and normalisation (``enrich_publications`` then
    ``derive_tables``).

    * authors: flattened ``authors_parsed``, id = first position;
    * gender_data: distinct submitter first names without a dot that the
      lookup has, with their gender (null where the lookup's is null);
    * versions: one row per version with a parsed timestamp;
    * bridge: each parsed author -> least author id whose Names and Surname
      contain it (literal substring; ``match='exact'`` for equality; with
      ``match='regex'`` names that are no searchable patterns are listed in
      rejected_names and rejected_submitters);
    * author_genders: submitter -> author (Names contains the first letter
      of the first name, Surname contains the last token) with a gender
      that is not 'unknown'; one row per publication;
    * final: the publication table with the first discipline.

    ``csv_parity`` nulls out empty / NA-word names on the matching side, as
    the reference's CSV round trip does (such authors then never match)."""
    df = enrich_publications(pubs, doi_lookup, max_publications)
    authors = author_ids(df)
    return derive_tables(df, authors, gender_lookup, csv_parity, match) | {"publications": df, "authors": authors}


# ---------------------------------------------------------------- P3

def build_warehouse(tables: Mapping[str, DataFrame], dim_mode: str = "distinct", strict: bool = False) -> LazyTables:
    """Star schema from the P2 tables, plus audits of its declared keys.

    ``dim_mode='distinct'``: one id per distinct name (what the schema
    intends).  ``dim_mode='per_row'``: the reference's form, one dimension
    row per publication row (discipline numbered in publication_type
    order, as written there).  The fact keeps one row per publication.
    ``strict=True`` raises on violations of the validated constraints
    (primary keys, dim_gender and bridge foreign keys)."""
    final = tables["final"]

    @cache
    def dimension(name: str) -> DataFrame:
        if dim_mode == "distinct":
            return dim_distinct(final, name, f"{name}_id", f"{name}_name")
        sort_col = {"sort_col": "publication_type"} if name == "discipline" else {}
        return dim_per_row(final, name, ["id"], f"{name}_id", f"{name}_name", **sort_col)

    if dim_mode not in ("distinct", "per_row"):
        raise ValueError(dim_mode)
    pubs = final.withColumnRenamed("id", "publication_id")
    # Keeping the least (discipline, type, journal) id triple of the joined
    # rows equals taking the least id per name in each dimension on its own,
    # so each dimension is reduced to name -> min(id) before the join: a
    # per-row dimension cannot multiply fact rows (a name shared by a third
    # of all publications would otherwise square that third).
    def least_id(name: str) -> tuple[DataFrame, str, str]:
        least = dimension(name).groupBy(f"{name}_name").agg(F.min(f"{name}_id").alias(f"{name}_id"))
        # written, so that the planner knows its size: publications are not shuffled by a few names where it is small
        return written_once(least, f"least-{name}"), name, f"{name}_name"

    def fact() -> DataFrame:
        ids = ("discipline_id", "publication_type_id", "journal_id")
        joined = join_star(pubs, [least_id("discipline"), least_id("publication_type"), least_id("journal")])
        joined = joined.select("publication_id", "title", "comments", "doi", "reference_count", *ids)
        return distinct_on(joined, ["publication_id"], [(c, "asc_nulls_last") for c in ids])

    built = LazyTables({
        "dim_author": lambda: tables["authors"].select("author_id", "Surname", "Names"),
        "dim_gender": lambda: tables["author_genders"].select("author_id", "gender"),
        "dim_journal": lambda: dimension("journal"),
        "dim_discipline": lambda: dimension("discipline"),
        "dim_publication_type": lambda: dimension("publication_type"),
        "fact_publications": fact,
        "bridge_author_publications": lambda: tables["bridge"].select("publication_id", "author_id"),
        "dim_versions": lambda: tables["versions"].select(F.col("id").alias("publication_id"), "version"),
    })
    audits = LazyTables({**{name: (lambda name=name: built[name]) for name in built}, "audits": lambda: audit_warehouse(built, strict)})
    if strict:
        audits["audits"]
    return audits


def audit_warehouse(wh: dict[str, DataFrame], strict: bool = False) -> dict[str, DataFrame]:
    """Violations of the warehouse's declared constraints, one DataFrame per
    constraint.  ``strict=True`` raises on the validated ones (primary keys,
    dim_gender and bridge foreign keys); ``NOT VALID`` foreign keys and
    column limits are only reported."""
    da, dg, dj = wh["dim_author"], wh["dim_gender"], wh["dim_journal"]
    dd, dp, fact = wh["dim_discipline"], wh["dim_publication_type"], wh["fact_publications"]
    bridge, versions = wh["bridge_author_publications"], wh["dim_versions"]
    return {
        "dim_author_pk": audit_unique(da, ["author_id"], strict),
        "dim_journal_pk": audit_unique(dj, ["journal_id"], strict),
        "dim_discipline_pk": audit_unique(dd, ["discipline_id"], strict),
        "dim_publication_type_pk": audit_unique(dp, ["publication_type_id"], strict),
        "fact_pk": audit_unique(fact, ["publication_id"], strict),
        "dim_gender_fk": audit_reference(dg, da, ["author_id"], strict=strict),
        "bridge_publication_fk": audit_reference(bridge, fact, ["publication_id"], strict=strict),
        "bridge_author_fk": audit_reference(bridge, da, ["author_id"], strict=strict),
        # NOT VALID constraints: reported, never enforced
        "fact_discipline_fk": audit_reference(fact, dd, ["discipline_id"]),
        "fact_publication_type_fk": audit_reference(fact, dp, ["publication_type_id"]),
        "fact_journal_fk": audit_reference(fact, dj, ["journal_id"]),
        "versions_fk": audit_reference(versions, fact, ["publication_id"]),
        "journal_name": audit_column(dj, "journal_name", not_null=True, max_len=50),
        "discipline_name": audit_column(dd, "discipline_name", not_null=False, max_len=100),
        "publication_type_name": audit_column(dp, "publication_type_name", not_null=False, max_len=100),
    }


# Declared limits of the dimensions' names: (not null, greatest length).
NAME_LIMITS = {"journal": (True, 50), "discipline": (False, 100), "publication_type": (False, 100)}


def audit_key_rows(wh: Mapping[str, DataFrame], name_limits: bool = True) -> DataFrame:
    """(audit, violations) of every declared constraint, with one shuffle per
    key space (author, publication, and the three dimensions) instead of one
    or two per constraint.  ``name_limits=False`` leaves the names' limits out."""
    da, dg, dj = wh["dim_author"], wh["dim_gender"], wh["dim_journal"]
    dd, dp, fact = wh["dim_discipline"], wh["dim_publication_type"], wh["fact_publications"]
    bridge, versions = wh["bridge_author_publications"], wh["dim_versions"]
    spaces = [
        audit_key_space({"dim_author_pk": (da, "author_id")},
                        {"dim_gender_fk": (dg, "author_id", "dim_author_pk"), "bridge_author_fk": (bridge, "author_id", "dim_author_pk")}),
        audit_key_space({"fact_pk": (fact, "publication_id")},
                        {"bridge_publication_fk": (bridge, "publication_id", "fact_pk"), "versions_fk": (versions, "publication_id", "fact_pk")}),
    ]
    for name, dim in (("journal", dj), ("discipline", dd), ("publication_type", dp)):
        spaces.append(audit_key_space({f"dim_{name}_pk": (dim, f"{name}_id")},
                                      {f"fact_{name}_fk": (fact, f"{name}_id", f"dim_{name}_pk")}))
    if name_limits:
        for (name, (not_null, most)), dim in zip(NAME_LIMITS.items(), (dj, dd, dp)):
            seen = audit_column(dim, f"{name}_name", not_null=not_null, max_len=most)
            spaces.append(seen.select(F.lit(f"{name}_name").alias("audit"),
                                      F.coalesce(F.col("null_rows") + F.col("too_long_rows"), F.lit(0)).alias("violations")))
    return reduce(DataFrame.unionByName, spaces)


def audit_key_counts(wh: Mapping[str, DataFrame], observed: Mapping[str, int] | None = None) -> dict[str, int]:
    """The counts of ``audit_counts(audit_warehouse(wh))`` by ``audit_key_rows``,
    all in one job.  ``observed`` has the violations of the name limits where
    the writes counted them (``save_observed``)."""
    rows = audit_key_rows(wh, name_limits=observed is None).collect()   # one row per audit
    return {r.audit: r.violations for r in rows} | dict(observed or {})


def audit_counts(audits: dict[str, DataFrame]) -> dict[str, int]:
    """Violation count of every audit, all computed in one job (a union of
    one-row aggregates)."""
    parts = []
    for name, df in audits.items():
        if {"null_rows", "too_long_rows"} <= set(df.columns):      # column audits: one summary row
            n = df.select((F.col("null_rows") + F.col("too_long_rows")).alias("n"))
        else:
            n = df.agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.select(F.lit(name).alias("audit"), F.col("n").cast("bigint").alias("violations")))
    rows = reduce(DataFrame.unionByName, parts).collect()   # one row per audit
    return {r.audit: r.violations or 0 for r in rows}


# ---------------------------------------------------------------- P4

def build_graph(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Node and edge tables of the property graph.

    Discipline / publication type / journal ids are 0-based in first-seen
    (publication id) order, null being a value; they differ from the
    warehouse ids.  Edges: CREATE author->publication, PART_OF
    publication->discipline and ->publication_type, SENT_TO
    publication->journal, PUBLISH journal->publication."""
    final = tables["final"]
    disc = dim_first_seen(final, "discipline", "id", "discipline_id", "discipline_name")
    ptype = dim_first_seen(final, "publication_type", "id", "publication_type_id", "publication_type_name")
    journ = dim_first_seen(final, "journal", "id", "journal_id", "journal_name")
    rel = relations(final, "id", [("journal", journ, "journal_name", "journal_id"),
                                  ("publication_type", ptype, "publication_type_name", "publication_type_id"),
                                  ("discipline", disc, "discipline_name", "discipline_id")])
    authors = tables["authors"].select("author_id", F.col("Names").alias("names"), F.col("Surname").alias("surname"))
    nodes = graph_nodes({
        "author": (authors, "author_id", ["names", "surname"]),
        "publication": (final, "id", ["title", "comments", "doi", "reference_count"]),
        "publication_type": (ptype, "publication_type_id", ["publication_type_name"]),
        "journal": (journ, "journal_id", ["journal_name"]),
        "discipline": (disc, "discipline_id", ["discipline_name"]),
    })
    edges = graph_edges([
        (tables["bridge"], "author", "author_id", "CREATE", "publication", "publication_id"),
        (rel, "publication", "id", "PART_OF", "discipline", "discipline_id"),
        (rel, "publication", "id", "PART_OF", "publication_type", "publication_type_id"),
        (rel, "publication", "id", "SENT_TO", "journal", "journal_id"),
        (rel, "journal", "journal_id", "PUBLISH", "publication", "id"),
    ], nodes)
    return {"nodes": nodes, "edges": edges, "relations": rel, "disciplines": disc,
            "publication_types": ptype, "journals": journ}
