"""Run the four pipelines in order, each stage writing its tables.

    python -m bibliospark.plans.run --source pubs.json --doi-lookup doi.parquet \\
        --gender-lookup genders.csv --out hdfs:///shared/bibliospark [--max-publications 100]

Stage outputs are Parquet folders of a new version under ``out`` (plus a JSON
``audit_summary``); the next stage reads them back, so each stage starts from
written data (lineage is cut at stage boundaries).  When everything is
written and audited, the version becomes the current one at once
(``sources.TableStore``): a run that fails half-way leaves the tables of the
one before, and reruns are idempotent, as drop-and-rebuild is in the
reference.  ``TableStore(spark, out).read("warehouse/fact_publications")``
reads the current version.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibliospark import schemas
from bibliospark.operators import author_ids
from bibliospark.plans import pipelines
from bibliospark.session import scratch_collected
from bibliospark.sources import TableStore, read_csv_table, read_indexed_json, read_jsonl, save_observed, save_table


def _read_source(spark: SparkSession, path: str) -> DataFrame:
    """By extension: one JSON object of records by key (``.json``), JSONL
    records with a bigint ``id`` (``.jsonl``), otherwise Parquet records with
    ``id``.  Works for local paths and cluster URIs alike; all are read in
    parallel."""
    if path.endswith(".jsonl"):
        fields = [f if f.name != "id" else schemas.StructField("id", schemas.LongType()) for f in schemas.PUBLICATION]
        return read_jsonl(spark, path, schemas.StructType(fields))
    if path.endswith(".json"):
        return read_indexed_json(spark, path, schemas.PUBLICATION)
    return spark.read.parquet(path)


def _read_lookup(spark: SparkSession, path: str, schema) -> DataFrame:
    if path.endswith(".csv"):
        return read_csv_table(spark, path, schema)
    return spark.read.parquet(path)


# Warehouse tables and their join key, for bucketed (co-located) output.
BUCKET_KEYS = {
    "fact_publications": "publication_id",
    "bridge_author_publications": "publication_id",
    "dim_versions": "publication_id",
    "dim_author": "author_id",
    "dim_gender": "author_id",
}


def run_pipelines(spark: SparkSession, source: str, doi_lookup: str, gender_lookup: str, out: str,
                  max_publications: int | None = None, dim_mode: str = "distinct",
                  buckets: int | None = None, match: str = "contains", timings: dict | None = None,
                  strict: bool = False, csv_parity: bool = False) -> dict:
    """P1 -> P2 -> P3 -> P4 with written stage boundaries; returns audit counts.

    With ``buckets``, the warehouse tables are also registered as catalog
    tables bucketed on their join key (``BUCKET_KEYS``), so the fact-bridge
    and author joins of the warehouse questions need no shuffle.  ``timings``,
    when given, receives the wall-clock seconds of each stage.  ``strict``
    fails the run on a violated primary key, or gender or bridge foreign key,
    before the graph is built; ``csv_parity`` leaves empty names out of the
    matches as a CSV round trip does."""
    clock = [time.perf_counter()]

    def lap(stage: str) -> None:
        now = time.perf_counter()
        if timings is not None:
            timings[stage] = round(now - clock[0], 2)
        clock[0] = now

    store = TableStore(spark, out)
    with scratch_collected(spark):
        return _stages(spark, store, source, doi_lookup, gender_lookup, max_publications, dim_mode, buckets, match, strict, csv_parity, lap)


def _stages(spark, store, source, doi_lookup, gender_lookup, max_publications, dim_mode, buckets, match, strict, csv_parity, lap) -> dict:
    path = store.path

    def write(tables: dict, prefix: str) -> None:
        for name, df in tables.items():
            if isinstance(df, DataFrame):
                save_table(df, name, path=path(f"{prefix}/{name}"))

    def read(prefix: str, name: str) -> DataFrame:
        return spark.read.parquet(path(f"{prefix}/{name}"))

    save_table(pipelines.clean_publications(_read_source(spark, source)), "publications", path=path("p1/publications"))
    lap("p1")

    # Each intermediate that feeds several tables is written once and
    # read back, so the enrichment join and the author numbering run once
    enriched = pipelines.enrich_publications(read("p1", "publications"),
                                             _read_lookup(spark, doi_lookup, schemas.DOI_LOOKUP), max_publications)
    save_table(enriched, "publications", path=path("p2/publications"))
    pubs = read("p2", "publications")
    lap("p2_enrich")
    save_table(author_ids(pubs), "authors", path=path("p2/authors"))
    lap("p2_authors")
    p2 = pipelines.derive_tables(pubs, read("p2", "authors"),
                                 _read_lookup(spark, gender_lookup, schemas.GENDER_LOOKUP), csv_parity, match)
    write(p2, "p2")
    lap("p2_tables")
    tables = {name: read("p2", name) for name in ["publications", "authors", *p2]}

    wh = pipelines.build_warehouse(tables, dim_mode=dim_mode)
    if buckets:
        for name, key in BUCKET_KEYS.items():
            draft = f"{name}_{store.run}"   # a table of this run; its files stay where they are
            save_table(wh[name], draft, path=path(f"warehouse/{name}"), bucket_by=(buckets, [key]))
            spark.sql(f"DROP TABLE {draft}")
    # the dimensions' name limits are counted by the writes themselves
    observed = {}
    for name, limit in pipelines.NAME_LIMITS.items():
        seen = save_observed(wh[f"dim_{name}"], path(f"warehouse/dim_{name}"), {f"{name}_name": limit})
        observed |= seen.violations
    done = {f"dim_{name}" for name in pipelines.NAME_LIMITS} | {"audits"} | set(BUCKET_KEYS if buckets else ())
    write({k: wh[k] for k in wh if k not in done}, "warehouse")
    # audits run on the written tables, all counts in one job; violation
    # details are written only for the constraints that fail
    written = {name: read("warehouse", name) for name in wh if name != "audits"}
    checks = pipelines.audit_warehouse(written)
    audits = pipelines.audit_key_counts(written, observed)
    for name, n in audits.items():
        if n:
            save_table(checks[name], name, path=path(f"audits/{name}"))
    if strict:
        pipelines.audit_warehouse(written, strict=True)
    lap("p3")
    write(pipelines.build_graph(tables), "graph")
    lap("p4")
    # one small summary table (one row per audit), written by Spark so that
    # ``out`` may be any cluster file system
    summary = spark.createDataFrame(sorted(audits.items()), "audit string, violations bigint")
    save_table(summary.coalesce(1), "audit_summary", path=path("audit_summary"), fmt="json")
    store.commit()
    if buckets:   # the catalog's names follow the committed version
        for name, key in BUCKET_KEYS.items():
            kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written[name].schema.fields)
            spark.sql(f"DROP TABLE IF EXISTS spark_catalog.default.{name}")
            spark.sql(f"CREATE TABLE spark_catalog.default.{name} ({kinds}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                      f"INTO {buckets} BUCKETS LOCATION '{path(f'warehouse/{name}')}'")
    store.collect()
    return audits


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--source", required=True)
    ap.add_argument("--doi-lookup", required=True)
    ap.add_argument("--gender-lookup", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--max-publications", type=int)
    ap.add_argument("--dim-mode", default="distinct", choices=["distinct", "per_row"])
    ap.add_argument("--buckets", type=int, help="register bucketed warehouse tables in the catalog")
    ap.add_argument("--match", default="contains", choices=["contains", "regex", "exact"],
                    help="how parsed author names are matched to the author table")
    ap.add_argument("--strict", action="store_true", help="fail on violated primary, gender and bridge keys")
    ap.add_argument("--csv-parity", action="store_true", help="empty and NA-word names never match")
    a = ap.parse_args(argv)
    from bibliospark.session import get_session
    spark = get_session()
    print(json.dumps(run_pipelines(spark, a.source, a.doi_lookup, a.gender_lookup, a.out, a.max_publications,
                                   a.dim_mode, a.buckets, a.match, strict=a.strict, csv_parity=a.csv_parity),
                     sort_keys=True))


if __name__ == "__main__":
    main()
