"""The four pipelines as registered queries, on publication records that are
derived from whole ``documents`` and ``labels``.

The title is the whole text, names are words of its beginning, middle and end
(thousands of distinct ones), DOIs come from its digest, DOI metadata from the labels and genders from the length of a first
name, some of which the lookup lacks.  ``RECORDS_SQL`` derives the same
records in SQL; each query's twin states its rules on top of that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibliospark.functions.text import FIRST_TOKEN, LAST_TOKEN, first_token
from bibliospark.operators import author_ids
from bibliospark.plans import pipelines
from bibliospark.plans.lazy import LazyTables
from bibliospark.plans.warehouse_queries import gender_share, sample_queries
from bibliospark.session import written_once
from bibliospark.sources import read_table

V1, V2 = "Mon, 2 Apr 2007 19:18:42 GMT", "Tue, 8 May 2007 01:02:03 GMT"


def records(spark: SparkSession, sf: str) -> DataFrame:
    """A publication record per document."""
    docs = read_table(spark, sf, "documents")
    w = F.split(F.regexp_replace("text", r"[^\p{L} ]", ""), " +")

    def word(i):
        i = F.lit(i) if isinstance(i, int) else i
        return F.coalesce(F.try_element_at(w, i), F.lit(""))

    # Words 1 and 2 once more, without splitting the whole text: filters on names are pushed to the scan, where
    # they evaluate their words several times a row.  A blank always parts two words, what is removed never does.
    # The text's head is enough where a blank ends word 2 in it.
    def letters(c):
        return F.coalesce(F.regexp_replace(c, r"[^\p{L}]+", ""), F.lit(""))

    in_head = F.nullif(F.regexp_extract(F.substring("text", 1, 256), r"^[^ ]* [^\p{L}]*(\p{L}[^ ]*) ", 1), F.lit(""))
    word_1 = letters(F.substring_index("text", " ", 1))
    word_2 = letters(F.coalesce(in_head, F.regexp_extract("text", r"^[^ ]* [^\p{L}]*([^ ]*)", 1)))
    n, last = F.char_length("text"), F.greatest(F.size(w) - 1, F.lit(1))
    middle = F.floor(F.size(w) / 2).cast("int") + 1
    return docs.select(
        F.col("doc_id").alias("id"),
        F.concat_ws(" ", word_2, word_1).alias("submitter"),
        F.col("text").alias("title"),
        F.when(n % 7 == 0, "None").otherwise("c").alias("comments"),
        F.when(n % 11 != 0, F.concat(F.lit("10.1/"), F.md5("text"))).alias("doi"),
        F.col("lang").alias("categories"),
        F.lit("unused").alias("abstract"),
        F.array(F.struct(F.lit(V1).alias("created")), F.struct(F.when(n % 2 == 0, V2).otherwise(V1).alias("created"))).alias("versions"),
        F.array(*[F.array(word(i), word(i + 1)) for i in (1, middle, last)]).alias("authors_parsed"),
    )


def doi_lookup(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    by_doi = docs.join(labels, "doc_id").groupBy(F.concat(F.lit("10.1/"), F.md5("text")).alias("doi")).agg(
        F.max(F.col("quality") * 10 + F.col("toxic")).cast("bigint").alias("reference_count"),
        F.min("lang").alias("lang"), F.min("source").alias("publication_type"))
    return by_doi.select("doi", "reference_count", F.array("lang").alias("discipline"), "publication_type",
                         F.concat(F.lit("Journal "), "lang").alias("journal"))


def gender_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Genders by the length of the name; every fifth length has no row, another a null."""
    names = records(spark, sf).select(first_token("submitter").alias("firstname")).distinct()
    k = F.char_length("firstname") % 5
    gender = F.when(k == 0, "female").when(k == 1, "male").when(k == 2, "unknown")
    return names.filter((k != 4) & (F.col("firstname") != "")).select("firstname", gender.alias("gender"))


def _tables(spark: SparkSession, sf: str) -> LazyTables:
    """P1 and P2, the shared intermediates written once as the runner does; tables are built when asked for."""
    clean = pipelines.clean_publications(records(spark, sf))
    pubs = written_once(pipelines.enrich_publications(clean, doi_lookup(spark, sf)), "p2-publications")
    authors = written_once(author_ids(pubs), "p2-authors")
    return pipelines.derive_tables(pubs, authors, gender_lookup(spark, sf)) | {"publications": pubs, "authors": authors}


RECORDS_SQL = f"""
    words AS (SELECT *, string_split_regex(regexp_replace(text, '[^\\p{{L}} ]', '', 'g'), ' +') AS w FROM documents),
    rec AS (SELECT doc_id AS id, coalesce(w[2], '') || ' ' || coalesce(w[1], '') AS submitter, text AS title,
                   CASE WHEN length(text) % 7 = 0 THEN 'None' ELSE 'c' END AS comments,
                   CASE WHEN length(text) % 11 <> 0 THEN '10.1/' || md5(text) END AS doi, lang AS categories,
                   '{V1}' AS publ_date, CASE WHEN length(text) % 2 = 0 THEN '{V2}' ELSE '{V1}' END AS publ_lastupdate,
                   list_transform([1, len(w) // 2 + 1, greatest(len(w) - 1, 1)],
                                  lambda i: [coalesce(w[i], ''), coalesce(w[i + 1], '')]) AS ap
            FROM words),
    clean AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY submitter, title, comments, doi, categories) AS copies
                             FROM rec WHERE length(title) >= 35) WHERE copies = 1)"""

_PUBS_SQL = f"""{RECORDS_SQL},
    meta AS (SELECT '10.1/' || md5(text) AS doi, max(quality * 10 + toxic) AS reference_count, min(lang) AS discipline,
                    min(source) AS publication_type, 'Journal ' || min(lang) AS journal
             FROM documents JOIN labels USING (doc_id) GROUP BY 1),
    pubs AS (SELECT c.id, submitter, ap, reference_count, discipline, publication_type, journal
             FROM clean c LEFT JOIN meta USING (doi) WHERE c.doi IS NOT NULL),
    flat AS (SELECT id, unnest(range(1, 4)) AS pos, unnest(ap) AS a FROM pubs),
    numbered AS (SELECT id, pos, a[1] AS surname, a[2] AS names, row_number() OVER (ORDER BY id, pos) - 1 AS place FROM flat),
    authors AS (SELECT min(place) AS author_id, surname, names FROM numbered GROUP BY surname, names)"""

_BRIDGE_SQL = f"""{_PUBS_SQL},
    asked AS (SELECT DISTINCT surname, names FROM numbered),
    least AS (SELECT asked.surname, asked.names, min(author_id) AS author_id FROM asked JOIN authors a
              ON contains(a.names, asked.names) AND contains(a.surname, asked.surname) GROUP BY ALL),
    bridge AS (SELECT id AS publication_id, author_id FROM numbered JOIN least USING (surname, names))"""

_GENDERS_SQL = f"""{_PUBS_SQL},
    sub AS (SELECT id, regexp_extract(submitter, '{FIRST_TOKEN}', 1) AS firstname,
                   regexp_extract(submitter, '{LAST_TOKEN}', 1) AS lastname FROM pubs),
    known AS (SELECT DISTINCT regexp_extract(submitter, '{FIRST_TOKEN}', 1) AS firstname FROM rec),
    lookup AS (SELECT firstname, CASE length(firstname) % 5 WHEN 0 THEN 'female' WHEN 1 THEN 'male' WHEN 2 THEN 'unknown' END AS gender
               FROM known WHERE length(firstname) % 5 <> 4 AND firstname <> ''),
    genders AS (SELECT sub.id, min(a.author_id) AS author_id, any_value(gender) AS gender FROM sub JOIN lookup USING (firstname)
                JOIN authors a ON contains(a.names, substr(firstname, 1, 1)) AND contains(a.surname, lastname)
                WHERE firstname <> '' AND gender IS DISTINCT FROM 'unknown' GROUP BY sub.id)"""


def _ids(name: str) -> str:
    return f"(SELECT {name} AS name, row_number() OVER (ORDER BY {name}) AS id FROM (SELECT DISTINCT {name} FROM pubs WHERE {name} IS NOT NULL))"


def _seen(name: str) -> str:
    return f"(SELECT {name} AS name, row_number() OVER (ORDER BY min(id), {name}) - 1 AS id FROM pubs GROUP BY {name})"


def p1_clean(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.clean_publications(records(spark, sf)).select("id", "title", "doi", "publ_date", "publ_lastupdate")


def p2_authors(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf)["authors"].withColumnsRenamed({"Surname": "surname", "Names": "names"})


def p2_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf)["bridge"]


def p2_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf)["versions"]


def p2_final(spark: SparkSession, sf: str) -> DataFrame:
    """The publication table, its reference counts joined back from the table of their own."""
    t = _tables(spark, sf)
    counts = t["reference_counts"].withColumnRenamed("reference_count", "counted")
    return t["final"].join(counts, "id").select("id", "title", "comments", "doi", "reference_count", "counted",
                                                "discipline", "publication_type", "journal")


def p2_gender_data(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf)["gender_data"]


def p2_author_genders(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf)["author_genders"]


def p3_fact(spark: SparkSession, sf: str) -> DataFrame:
    fact = pipelines.build_warehouse(_tables(spark, sf))["fact_publications"]
    return fact.select("publication_id", "reference_count", "discipline_id", "publication_type_id", "journal_id")


def p3_gender_share(spark: SparkSession, sf: str) -> DataFrame:
    wh = pipelines.build_warehouse(_tables(spark, sf))
    shares = gender_share(wh["dim_discipline"], wh["fact_publications"], wh["bridge_author_publications"],
                          wh["dim_author"], wh["dim_gender"])
    return shares.select("discipline_name", *[F.round(c, 6).alias(c) for c in ("proportion_male", "proportion_female")])


def _warehouse(spark: SparkSession, sf: str, *names: str) -> LazyTables:
    """P3's tables; those named are written, as the runner does, since several joins read them."""
    wh = pipelines.build_warehouse(_tables(spark, sf))
    return wh | {name: written_once(wh[name], f"p3-{name}") for name in names}


def p3_top_disciplines(spark: SparkSession, sf: str) -> DataFrame:
    return sample_queries(_warehouse(spark, sf))["sq1_top_disciplines"]


def p3_top_journals(spark: SparkSession, sf: str) -> DataFrame:
    return sample_queries(_warehouse(spark, sf))["sq2_top_journals"]


def p3_hindex(spark: SparkSession, sf: str) -> DataFrame:
    return sample_queries(_warehouse(spark, sf))["sq4_hindex"].withColumnsRenamed({"Surname": "surname", "Names": "names"})


def p3_audits(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.audit_key_rows(_warehouse(spark, sf, "fact_publications", "bridge_author_publications"))


def p4_edges(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.build_graph(_tables(spark, sf))["edges"]


def p4_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """A row per property of a node."""
    nodes = pipelines.build_graph(_tables(spark, sf))["nodes"]
    return nodes.select("label", "node_id", F.explode("props").alias("prop", "value"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_clean, p2_authors, p2_bridge, p2_versions, p2_final, p2_gender_data, p2_author_genders, p3_fact,
                            p3_gender_share, p3_top_disciplines, p3_top_journals, p3_hindex, p3_audits, p4_edges, p4_nodes)
}

_FACT_SQL = f"""{_PUBS_SQL},
    fact AS (SELECT p.id AS publication_id, CAST(reference_count AS BIGINT) AS reference_count, d.id AS discipline_id,
                    t.id AS publication_type_id, j.id AS journal_id
             FROM pubs p LEFT JOIN {_ids('discipline')} d ON p.discipline = d.name
             LEFT JOIN {_ids('publication_type')} t ON p.publication_type = t.name LEFT JOIN {_ids('journal')} j ON p.journal = j.name)"""

_FULL_SQL = f"""{_PUBS_SQL},
    final AS (SELECT p.id, c.title, nullif(c.comments, 'None') AS comments, c.doi, p.reference_count, p.discipline,
                     p.publication_type, p.journal FROM pubs p JOIN clean c USING (id))"""


def _key_violations(name: str, table: str, key: str) -> str:
    """A violation per key that occurs twice, and one for null."""
    return f"SELECT '{name}' AS audit, count(*) AS violations FROM (SELECT {key} FROM {table} GROUP BY 1 HAVING count(*) > 1 OR {key} IS NULL)"


def _orphans(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return f"""SELECT '{name}', count(*) FROM {child} c
               WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})"""


def _misfits(name: str, most: int) -> str:
    return f"SELECT '{name}_name', count(*) FROM (SELECT name FROM {name}_dim) WHERE name IS NULL OR length(name) > {most}"


def _props(label: str, table: str, key: str, props: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{label}' AS label, CAST({key} AS VARCHAR) AS node_id, '{p}' AS prop, CAST({e} AS VARCHAR) AS value FROM {table}"
                              for p, e in props.items())


ORACLE = {
    "p1_clean": f"WITH {RECORDS_SQL} SELECT id, title, doi, publ_date, publ_lastupdate FROM clean",
    "p2_authors": f"WITH {_PUBS_SQL} SELECT author_id, surname, names FROM authors",
    "p2_bridge": f"WITH {_BRIDGE_SQL} SELECT publication_id, author_id FROM bridge",
    "p2_author_genders": f"WITH {_GENDERS_SQL} SELECT author_id, gender FROM genders",
    "p2_versions": f"""WITH {_PUBS_SQL}, given AS (SELECT c.* FROM pubs p JOIN clean c USING (id))
        SELECT id, strptime(publ_date, '%a, %-d %b %Y %H:%M:%S GMT') AS version FROM given
        UNION ALL SELECT id, strptime(publ_lastupdate, '%a, %-d %b %Y %H:%M:%S GMT') FROM given""",
    "p2_final": f"""WITH {_FULL_SQL}
        SELECT id, title, comments, doi, reference_count, reference_count AS counted, discipline, publication_type, journal FROM final""",
    "p2_gender_data": f"""WITH {_GENDERS_SQL}
        SELECT DISTINCT firstname, gender FROM sub JOIN lookup USING (firstname) WHERE firstname <> '' AND NOT contains(firstname, '.')""",
    "p3_fact": f"""WITH {_FACT_SQL}
        SELECT publication_id, reference_count, discipline_id, publication_type_id, journal_id FROM fact""",
    "p3_top_disciplines": f"""WITH {_PUBS_SQL}
        SELECT discipline AS discipline_name, count(*) AS total_publications FROM pubs WHERE discipline IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "p3_top_journals": f"""WITH {_PUBS_SQL}
        SELECT journal AS journal_name, count(*) AS total_publications FROM pubs WHERE journal IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
    "p3_hindex": f"""WITH {_BRIDGE_SQL},
        sums AS (SELECT b.author_id, sum(reference_count) AS total FROM pubs p JOIN bridge b ON b.publication_id = p.id GROUP BY 1),
        ranked AS (SELECT author_id, rank() OVER (ORDER BY total DESC NULLS FIRST) AS hindex FROM sums)
        SELECT author_id, surname, names, hindex FROM ranked JOIN authors USING (author_id) ORDER BY hindex DESC, author_id LIMIT 5""",
    "p3_audits": f"""WITH {_GENDERS_SQL}, {_BRIDGE_SQL.removeprefix(_PUBS_SQL).lstrip(',')}, {_FACT_SQL.removeprefix(_PUBS_SQL).lstrip(',')},
        discipline_dim AS {_ids('discipline')}, publication_type_dim AS {_ids('publication_type')}, journal_dim AS {_ids('journal')}
        {_key_violations('dim_author_pk', 'authors', 'author_id')}
        UNION ALL {_orphans('dim_gender_fk', 'genders', 'author_id', 'authors', 'author_id')}
        UNION ALL {_orphans('bridge_author_fk', 'bridge', 'author_id', 'authors', 'author_id')}
        UNION ALL {_key_violations('fact_pk', 'fact', 'publication_id')}
        UNION ALL {_orphans('bridge_publication_fk', 'bridge', 'publication_id', 'fact', 'publication_id')}
        UNION ALL {_orphans('versions_fk', 'pubs', 'id', 'fact', 'publication_id')}
        UNION ALL """ + " UNION ALL ".join(
            f"{_key_violations(f'dim_{n}_pk', f'{n}_dim', 'id')} UNION ALL {_orphans(f'fact_{n}_fk', 'fact', f'{n}_id', f'{n}_dim', 'id')}"
            f" UNION ALL {_misfits(n, pipelines.NAME_LIMITS[n][1])}" for n in pipelines.NAME_LIMITS),
    "p3_gender_share": f"""WITH {_GENDERS_SQL}, {_BRIDGE_SQL.removeprefix(_PUBS_SQL).lstrip(',')}
        SELECT discipline AS discipline_name,
               round(sum(CASE WHEN gender = 'male' THEN 1 ELSE 0 END) / count(DISTINCT b.author_id)::DOUBLE, 6) AS proportion_male,
               round(sum(CASE WHEN gender = 'female' THEN 1 ELSE 0 END) / count(DISTINCT b.author_id)::DOUBLE, 6) AS proportion_female
        FROM pubs p JOIN bridge b ON b.publication_id = p.id JOIN genders g ON g.author_id = b.author_id
        WHERE discipline IS NOT NULL GROUP BY discipline""",
    "p4_edges": f"""WITH {_BRIDGE_SQL}
        SELECT 'author' AS src_label, CAST(author_id AS VARCHAR) AS src_id, 'CREATE' AS rel, 'publication' AS dst_label,
               CAST(publication_id AS VARCHAR) AS dst_id FROM bridge
        UNION ALL SELECT 'publication', CAST(p.id AS VARCHAR), 'PART_OF', 'discipline', CAST(x.id AS VARCHAR)
        FROM pubs p JOIN {_seen('discipline')} x ON p.discipline IS NOT DISTINCT FROM x.name
        UNION ALL SELECT 'publication', CAST(p.id AS VARCHAR), 'PART_OF', 'publication_type', CAST(x.id AS VARCHAR)
        FROM pubs p JOIN {_seen('publication_type')} x ON p.publication_type IS NOT DISTINCT FROM x.name
        UNION ALL SELECT 'publication', CAST(p.id AS VARCHAR), 'SENT_TO', 'journal', CAST(x.id AS VARCHAR)
        FROM pubs p JOIN {_seen('journal')} x ON p.journal IS NOT DISTINCT FROM x.name
        UNION ALL SELECT 'journal', CAST(x.id AS VARCHAR), 'PUBLISH', 'publication', CAST(p.id AS VARCHAR)
        FROM pubs p JOIN {_seen('journal')} x ON p.journal IS NOT DISTINCT FROM x.name""",
    "p4_nodes": f"""WITH {_FULL_SQL}, {', '.join(f"{n}_node AS {_seen(n)}" for n in pipelines.NAME_LIMITS)}
        {_props('author', 'authors', 'author_id', {'names': 'names', 'surname': 'surname'})}
        UNION ALL {_props('publication', 'final', 'id', {c: c for c in ('title', 'comments', 'doi', 'reference_count')})}
        UNION ALL """ + " UNION ALL ".join(_props(n, f"{n}_node", "id", {f"{n}_name": "name"}) for n in pipelines.NAME_LIMITS),
}
