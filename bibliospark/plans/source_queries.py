"""Readers, writers and loads as registered queries: whole tables are written
in a format, read back (or loaded, rebuilt, asked by SQL) and returned, so the
twin is the table itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from bibliospark.plans import warehouse_sql
from bibliospark.session import scratch_path
from bibliospark.sources import (
    TableStore,
    append_rejects,
    load_staging_rejects,
    read_csv_table,
    read_indexed_json,
    read_jsonl,
    read_table,
    save_observed,
    save_table,
    staging_ddl,
    write_csv_table,
    write_documents,
    write_indexed_json,
)


def json_object_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as JSON objects keyed by id, read in byte ranges; the key is the id again."""
    docs = read_table(spark, sf, "documents")
    path = scratch_path(spark, "json-objects")
    write_indexed_json(docs, path, key="doc_id")
    return read_indexed_json(spark, path, docs.schema, key="doc_id")


def jsonl_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as JSON lines."""
    docs = read_table(spark, sf, "documents")
    path = scratch_path(spark, "json-lines")
    write_documents(docs, path, fmt="json")
    return read_jsonl(spark, path, docs.schema)


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, whose texts hold line breaks and quotes, as CSV cut in byte ranges."""
    docs = read_table(spark, sf, "documents")
    path = scratch_path(spark, "csv")
    write_csv_table(docs, path)
    return read_csv_table(spark, path, docs.schema, multi_line=True)


def staging_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Orders from a CSV in another column order, where the price of finished ones is no number."""
    price = F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    path = scratch_path(spark, "staging")
    write_csv_table(read_table(spark, sf, "orders").select(price.alias("o_totalprice"), "o_orderkey"), path)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_totalprice", DoubleType())])
    loaded = load_staging_rejects(spark, "orders_import", path, schema)
    kept = spark.table("orders_import").select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"), F.lit(False).alias("rejected"))
    raw = F.split_part("_corrupt_record", F.lit(","), F.lit(2)).cast("bigint")
    return kept.unionByName(loaded.rejects.select(raw.alias("o_orderkey"), F.lit(None).cast("double").alias("o_totalprice"), F.lit(True).alias("rejected")))


def staging_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Parts, as text, into a table of the declared schema; brands that are no numbers stay behind."""
    declared = StructType([StructField("p_partkey", LongType()), StructField("brand", LongType()), StructField("p_name", StringType())])
    path = scratch_path(spark, "insert")
    table = f"stage_{path[-32:]}"
    empty = spark.createDataFrame([], declared)
    spark.sql(f"{staging_ddl(empty, table)} USING parquet LOCATION '{path}'")
    try:
        brand = F.regexp_extract("p_brand", r"(\d+)$", 1)
        text = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(brand)
        part = read_table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("p_partkey"), text.alias("brand"), "p_name")
        left = append_rejects(part, table, declared)
    finally:
        spark.sql(f"DROP TABLE {table}")   # external: its files stay
    found = spark.read.schema(declared).parquet(path)
    return found.unionByName(left.select(F.col("p_partkey").cast("bigint"), F.lit(None).cast("bigint").alias("brand"), "p_name"))


def table_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """A table is created from a query, replaced by the next run, and the old version collected."""
    path = scratch_path(spark, "rebuild")
    orders = read_table(spark, sf, "orders")
    first = TableStore(spark, path)
    save_table(orders.select("o_custkey"), "spend", path=first.path("spend"))
    first.commit()
    second = TableStore(spark, path)
    spend = orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spend"), F.count(F.lit(1)).alias("n"))
    save_table(spend, "spend", path=second.path("spend"))
    second.commit()
    second.collect()
    return second.read("spend")


def observed_write(spark: SparkSession, sf: str) -> DataFrame:
    """Limits and moments counted by the write of the line items itself."""
    line = read_table(spark, sf, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("A")))
    seen = save_observed(line, scratch_path(spark, "observed"), {"l_returnflag": (True, None), "l_linestatus": (True, 0)},
                         ["l_quantity", "l_discount"])
    rows = [(name, n, None, None, None, None, None) for name, n in seen.violations.items()]
    rows += [(name, None, m["count"], round(m["mean"], 6), round(m["std"], 6), m["min"], m["max"]) for name, m in seen.moments.items()]
    return spark.createDataFrame(rows, "column string, violations bigint, n bigint, mean double, std double, low double, high double")


def sql_arguments(spark: SparkSession, sf: str) -> DataFrame:
    """The user's SQL over quoted mixed-case columns, with a bound argument."""
    part = read_table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("Names"), F.col("p_brand").alias("Surname"))
    part.createOrReplaceTempView("authors_of_parts")
    return warehouse_sql.ask(spark, "SELECT p_partkey, `Names` AS names, `Surname` AS surname FROM authors_of_parts "
                                    "WHERE `Names` LIKE :pattern", pattern="%re%")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (json_object_round_trip, jsonl_round_trip, csv_round_trip, staging_rejects, staging_insert,
                            table_rebuild, observed_write, sql_arguments)
}

ORACLE = {
    "json_object_round_trip": "SELECT * FROM documents",
    "jsonl_round_trip": "SELECT * FROM documents",
    "csv_round_trip": "SELECT * FROM documents",
    "staging_rejects": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE round(o_totalprice, 6) END AS o_totalprice,
               o_orderstatus = 'F' AS rejected FROM orders""",
    "staging_insert": r"""
        SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN CAST(regexp_extract(p_brand, '(\d+)$', 1) AS BIGINT) END AS brand, p_name
        FROM part""",
    "table_rebuild": "SELECT o_custkey, round(sum(o_totalprice), 2) AS spend, count(*) AS n FROM orders GROUP BY o_custkey",
    "observed_write": """
        SELECT 'l_returnflag' AS "column", (SELECT count(*) FROM lineitem WHERE nullif(l_returnflag, 'A') IS NULL) AS violations,
               CAST(NULL AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS low,
               CAST(NULL AS DOUBLE) AS high
        UNION ALL SELECT 'l_linestatus', (SELECT count(*) FROM lineitem WHERE l_linestatus IS NULL OR length(l_linestatus) > 0),
               NULL, NULL, NULL, NULL, NULL
        UNION ALL SELECT 'l_quantity', NULL, count(l_quantity), round(avg(l_quantity), 6), round(stddev_samp(l_quantity), 6),
               min(l_quantity), max(l_quantity) FROM lineitem
        UNION ALL SELECT 'l_discount', NULL, count(l_discount), round(avg(l_discount), 6), round(stddev_samp(l_discount), 6),
               min(l_discount), max(l_discount) FROM lineitem""",
    "sql_arguments": "SELECT p_partkey, p_name AS names, p_brand AS surname FROM part WHERE p_name LIKE '%re%'",
}
