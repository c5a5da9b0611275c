"""Declared schemas of the publication domain (no inference at run time)."""

from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

VERSION = StructType([StructField("version", StringType()), StructField("created", StringType())])

# One source record (value of the index-keyed JSON object, or one JSONL line).
# Fields the pipelines never read still take part in the duplicate check of
# P1, so every field of the public record layout is declared.
PUBLICATION = StructType([
    StructField("id", StringType()),
    StructField("submitter", StringType()),
    StructField("authors", StringType()),
    StructField("title", StringType()),
    StructField("comments", StringType()),
    StructField("journal-ref", StringType()),
    StructField("doi", StringType()),
    StructField("report-no", StringType()),
    StructField("categories", StringType()),
    StructField("abstract", StringType()),
    StructField("license", StringType()),
    StructField("update_date", StringType()),
    StructField("versions", ArrayType(VERSION)),
    StructField("authors_parsed", ArrayType(ArrayType(StringType()))),
])

DOI_LOOKUP = StructType([
    StructField("doi", StringType()),
    StructField("reference_count", LongType()),
    StructField("discipline", ArrayType(StringType())),
    StructField("publication_type", StringType()),
    StructField("journal", StringType()),
])

GENDER_LOOKUP = StructType([StructField("firstname", StringType()), StructField("gender", StringType())])

AUTHORS = StructType([
    StructField("author_id", LongType()),
    StructField("Surname", StringType()),
    StructField("Names", StringType()),
])
