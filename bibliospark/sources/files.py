"""File formats at the pipeline edges: index-keyed JSON, JSONL, CSV.

Parquet is the working format between stages.  Every reader takes a declared
schema, and none turns what does not fit into a null: a bad record fails the
load, or, from the ``load_*`` functions, goes to a table of rejects.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bibliospark.session import ship_package, written_once
from bibliospark.sources.splits import CsvEnds, JsonEnds, records

# CSV options shared by reader and writer: keep blanks (a name may end in
# ' ') and write nulls as empty fields, as pandas does.
CSV_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}
CORRUPT = "_corrupt_record"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


class Loaded(NamedTuple):
    """A load that keeps what it could not read: ``rejects`` has the raw text in ``_corrupt_record``."""

    rows: DataFrame
    rejects: DataFrame

    def counts(self) -> tuple[int, int]:
        return self.rows.count(), self.rejects.count()


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def _strict(parsed: DataFrame, what: str) -> DataFrame:
    """``parsed`` without its last column, which must be null; a filter, so that no projection skips the check."""
    text = F.concat(F.lit(f"{what}: bad record "), F.substring(CORRUPT, 1, 200))
    fits = F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    return parsed.filter(fits).drop(CORRUPT)


def _split(parsed: DataFrame, name: str) -> Loaded:
    """Good and bad rows of one pass over the files, which is written."""
    once = written_once(parsed, name)
    return Loaded(once.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), once.filter(F.col(CORRUPT).isNotNull()))


def _parsed_json(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    fields = [f for f in schema.fields if f.name != key]
    found = records(spark, path, JsonEnds)
    blanks = " \t\r\n"
    text = F.btrim(F.col("text"), F.lit(blanks))
    text = F.when(F.col("number") == 0, F.btrim(F.regexp_replace(text, "^﻿", ""), F.lit(blanks))).otherwise(text)
    lead = F.when(F.col("number") == 0, F.lit("{")).otherwise(F.lit(","))
    body = F.when(F.col("last"), F.expr("left(t, char_length(t) - 1)")).otherwise(F.col("t"))  # the object's own brace
    found = found.withColumn("t", text).withColumn("t", F.btrim(body, F.lit(blanks)))
    found = found.filter(F.col("t") != "")
    inner = F.expr("substring(t, 2)")
    entries = F.when(F.substring("t", 1, 1) == lead, F.from_json(F.concat(F.lit("{"), inner, F.lit("}")), "map<string,string>"))
    exploded = found.filter(~((F.col("t") == "{") & (F.col("number") == 0))).select("t", F.explode_outer(entries).alias("k", "v"))
    record = F.from_json("v", _with_corrupt(StructType(fields)), _PERMISSIVE)
    number = F.col("k").try_cast("bigint")
    corrupt = F.when(F.col("k").isNull(), F.col("t")).when(number.isNull(), F.concat("k", F.lit(": "), "v")).otherwise(F.col(f"r.{CORRUPT}"))
    return exploded.withColumn("r", record).select(
        number.alias(key), *[F.col("r").getField(f.name).alias(f.name) for f in fields], corrupt.alias(CORRUPT)
    )


def read_indexed_json(spark: SparkSession, path: str, schema: StructType, key: str = "id") -> DataFrame:
    """Read JSON *objects* ``{"0": {...}, "1": {...}}`` as one row per entry.

    Files are cut into byte ranges that are read in parallel, however large
    one object is (``splits``).  The key becomes a bigint ``key`` column
    replacing any ``key`` field of the record; an entry that is null gives a
    row of nulls, a repeated key repeated rows.  A file that ends early fails
    at once, an entry that does not fit the schema fails the job.
    """
    return _strict(_parsed_json(spark, path, schema, key), path)


def load_indexed_json(spark: SparkSession, path: str, schema: StructType, key: str = "id") -> Loaded:
    """``read_indexed_json`` that keeps entries which do not fit (a file that ends early still fails)."""
    return _split(_parsed_json(spark, path, schema, key), "json-load")


def write_indexed_json(df: DataFrame, path: str, key: str = "id", mode: str = "overwrite") -> None:
    """Write one JSON object ``{key: record, ...}`` per partition (``coalesce(1)`` beforehand for a single file)."""
    ship_package(df.sparkSession)
    rest = [F.col(c) for c in df.columns if c != key]
    named = F.when(F.col(key).isNotNull(), F.col(key).cast("string")).otherwise(F.raise_error(F.lit(f"a record without {key}")).cast("string"))
    entry = F.concat(F.to_json(F.struct(named.alias("k"))), F.lit("\x00"), F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}))

    def run(batches):
        first = True
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                k, record = text.split("\x00", 1)
                out.append(("{" if first else ",") + k[5:-1] + ":" + record)  # k is {"k":"..."}
                first = False
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["{}" if first else "}"])], names=["value"])

    df.select(entry.alias("value")).mapInArrow(run, "value string").write.mode(mode).text(path)


def _json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.options(**_PERMISSIVE).schema(_with_corrupt(schema)).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Line-delimited JSON with a declared schema (splittable); a line that does not fit fails the job."""
    return spark.read.option("mode", "FAILFAST").schema(schema).json(path)


def load_jsonl(spark: SparkSession, path: str, schema: StructType) -> Loaded:
    """``read_jsonl`` that keeps the lines which do not fit."""
    return _split(_json_lines(spark, path, schema), "jsonl-load")


def write_documents(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write records as Parquet (default) or JSONL.  Never pass the input
    path: Spark reads lazily, so overwriting a source while reading it loses data."""
    df.write.mode(mode).format(fmt).save(path)


def _file_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """The schema in the order of the files' header; columns that ``schema`` does not name are strings."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    declared = {f.name: f for f in schema.fields}
    if missing := [n for n in declared if n not in header]:
        raise ValueError(f"{path}: the header {header} lacks {missing}")
    return StructType([declared.get(n, StructField(n, StringType())) for n in header])


def _plain_csv(spark: SparkSession, path: str, schema: StructType, in_file: StructType, options: dict) -> DataFrame:
    read = spark.read.options(**CSV_OPTIONS, **options, enforceSchema="false").schema(in_file).csv(path)
    return read.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def _multi_line_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    in_file = _file_schema(spark, path, schema)
    found = records(spark, path, CsvEnds).withColumn("t", F.regexp_replace("text", "\r?\n\\z", ""))
    found = found.filter(F.btrim("t", F.lit(" \t\r\n")) != "")
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    return _headed(found, in_file).select(_csv_record(in_file, options).alias("r")).select(
        *[F.col("r").getField(f.name).alias(f.name) for f in schema.fields], F.col("r").getField(CORRUPT).alias(CORRUPT)
    )


def _csv_record(in_file: StructType, options: dict) -> Column:
    # multiLine keeps line breaks within quotes as they are
    return F.from_csv("t", _with_corrupt(in_file).toDDL(), {**options, **_PERMISSIVE, "multiLine": "true"})


def _headed(found: DataFrame, in_file: StructType) -> DataFrame:
    """The records without the files' headers, each of which must name the same columns."""
    header = F.regexp_replace("t", "^﻿", "")
    got = F.transform(F.split(header, ","), lambda c: F.regexp_replace(c, '^"|"$', ""))
    same = got == F.array(*[F.lit(f.name) for f in in_file.fields])
    text = F.concat(F.lit("another header than that of the first file: "), F.substring("t", 1, 200))
    checked = F.when(F.col("number") > 0, F.lit(True)).when(same, F.lit(False)).otherwise(F.raise_error(text).cast("boolean"))
    return found.filter(checked)


def read_csv_table(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """CSV with header and a declared schema; blanks are preserved.

    Columns are found by the names in the header, whatever their order;
    columns that the schema does not name are not read.  A record that does
    not fit (a value, or the number of fields) fails the job.

    ``multi_line`` reads fields with line breaks.  Files are split all the
    same (``splits``); quotes must only stand around fields, doubled inside.
    """
    if multi_line:
        return _strict(_multi_line_csv(spark, path, schema), path)
    return _plain_csv(spark, path, schema, _file_schema(spark, path, schema), {"mode": "FAILFAST"})


def load_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> Loaded:
    """``read_csv_table`` that keeps the records which do not fit."""
    if multi_line:
        return _split(_multi_line_csv(spark, path, schema), "csv-load")
    in_file, wanted = _with_corrupt(_file_schema(spark, path, schema)), _with_corrupt(schema)
    return _split(_plain_csv(spark, path, wanted, in_file, _PERMISSIVE), "csv-load")


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, no index column, blanks preserved."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
