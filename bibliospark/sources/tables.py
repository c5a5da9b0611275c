"""Tables: staging loads, create-table-as-select, conformed inserts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from bibliospark.session import written_once
from bibliospark.sources.files import Loaded, load_csv, read_csv_table


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared parquet tables ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_staging(spark: SparkSession, name: str, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """``COPY name FROM path CSV HEADER``: read with the declared schema and
    register as a view (drop-and-replace, so reruns are idempotent).  A record
    that does not fit fails the load."""
    df = read_csv_table(spark, path, schema, multi_line)
    df.createOrReplaceTempView(name)
    return df


def load_staging_rejects(spark: SparkSession, name: str, path: str, schema: StructType, multi_line: bool = False) -> Loaded:
    """``load_staging`` that goes on: what does not fit is the view ``{name}_rejects``
    (the columns that could be read, and the raw record in ``_corrupt_record``)."""
    loaded = load_csv(spark, path, schema, multi_line)
    loaded.rows.createOrReplaceTempView(name)
    loaded.rejects.createOrReplaceTempView(f"{name}_rejects")
    return loaded


def save_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
               bucket_by: tuple[int, list[str]] | None = None) -> None:
    """``DROP TABLE IF EXISTS; SELECT ... INTO name``: overwrite a table
    (catalog table, or a path when given).

    ``bucket_by=(n, cols)`` writes a catalog table bucketed and sorted on
    ``cols`` (stored at ``path`` when given): tables bucketed the same way on
    their join key are joined later without a shuffle."""
    w = df.write.mode("overwrite").format(fmt)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
    elif path:
        w.save(path)
    else:
        w.saveAsTable(name)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Declared types for a result (the "best dtype" step): select the
    schema's columns by name and cast to its types.  A value that does not
    fit fails the job; ``misfits`` lists such rows beforehand."""
    return df.select(*[_fitting(f) for f in schema.fields])


class Observed(NamedTuple):
    """What a write saw: violations per limited column, and the moments of numeric ones."""

    violations: dict[str, int]
    moments: dict[str, dict[str, float | int | None]]


def save_observed(df: DataFrame, path: str, limits: Mapping[str, tuple[bool, int | None]] | None = None,
                  moments: Sequence[str] = (), fmt: str = "parquet") -> Observed:
    """``save_table(df, path=path)`` that audits and profiles the rows as it writes them.

    ``limits`` maps a column to (not null, greatest length), as
    ``audit_column`` checks them; ``moments`` lists numeric columns for count,
    mean, sample standard deviation, min and max, as in ``profile``.  Both are
    metrics of the write itself (``DataFrame.observe``): the rows are neither
    scanned again nor shuffled for them."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, (name, (not_null, most)) in enumerate((limits or {}).items()):
        c = F.col(f"`{name}`")
        bad = (c.isNull() & F.lit(not_null)) | (F.coalesce(F.char_length(c) > most, F.lit(False)) if most is not None else F.lit(False))
        metrics.append(F.coalesce(F.sum(bad.cast("bigint")), F.lit(0)).alias(f"limit_{i}"))
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    for i, name in enumerate(moments):
        metrics += [f(F.col(f"`{name}`").cast("double")).alias(f"{stat}_{i}") for stat, f in stats.items()]
    seen = Observation(f"write-{uuid.uuid4().hex}")
    save_table(df.observe(seen, *metrics), "", path=path, fmt=fmt)
    got = seen.get
    return Observed({n: got[f"limit_{i}"] for i, n in enumerate(limits or {})},
                    {n: {stat: got[f"{stat}_{i}"] for stat in stats} for i, n in enumerate(moments)})


def _fitting(f: StructField) -> Column:
    """The column under its declared type: one cast, and a message only where it fails."""
    c = F.col(f"`{f.name}`")
    text = F.concat(F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "), c.cast("string"))
    return F.coalesce(c.try_cast(f.dataType), F.when(c.isNotNull(), F.raise_error(text).cast(f.dataType))).alias(f.name)


def _misfit_columns(df: DataFrame, schema: StructType) -> DataFrame:
    bad = [F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), F.lit(f.name))
           for f in schema.fields]
    return df.withColumn("misfit_columns", F.array_compact(F.array(*bad)))


def misfits(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows of ``df`` with a value that ``conform`` could not cast, and
    the names of those columns in ``misfit_columns``."""
    return _misfit_columns(df, schema).filter(F.size("misfit_columns") > 0)


def append_conformed(df: DataFrame, name: str, schema: StructType) -> None:
    """``INSERT INTO name(cols) SELECT ...``: cast to the declared schema by
    name, align to the table's column order (``insertInto`` is positional)
    and append; table columns outside ``schema`` get nulls.  A value that does
    not fit fails the insert.  The table must exist."""
    declared = {f.name.lower(): f for f in schema.fields}
    target = df.sparkSession.table(name).schema.fields
    cols = [_fitting(StructField(declared[f.name.lower()].name, f.dataType)).alias(f.name) if f.name.lower() in declared
            else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
    df.select(*cols).write.insertInto(name)


def append_rejects(df: DataFrame, name: str, schema: StructType) -> DataFrame:
    """``append_conformed`` of the rows that fit; returns those that do not, with ``misfit_columns``."""
    judged = written_once(_misfit_columns(df, schema), "append")
    append_conformed(judged.filter(F.size("misfit_columns") == 0).drop("misfit_columns"), name, schema)
    return judged.filter(F.size("misfit_columns") > 0)


def staging_ddl(df: DataFrame, name: str) -> str:
    """CREATE TABLE text for ``df``'s schema (the declared staging schema)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in df.schema.fields)
    return f"CREATE TABLE {name} ({cols})"
