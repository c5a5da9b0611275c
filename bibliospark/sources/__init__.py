"""Readers and writers."""

from bibliospark.sources.files import (
    Loaded,
    load_csv,
    load_indexed_json,
    load_jsonl,
    read_csv_table,
    read_indexed_json,
    read_jsonl,
    write_csv_table,
    write_documents,
    write_indexed_json,
)
from bibliospark.sources.splits import MalformedFile
from bibliospark.sources.tables import (
    Observed,
    append_conformed,
    append_rejects,
    conform,
    load_staging,
    load_staging_rejects,
    misfits,
    read_table,
    save_observed,
    save_table,
    staging_ddl,
)
from bibliospark.sources.versions import TableStore

__all__ = [
    "Loaded",
    "MalformedFile",
    "Observed",
    "TableStore",
    "append_conformed",
    "append_rejects",
    "conform",
    "load_csv",
    "load_indexed_json",
    "load_jsonl",
    "load_staging",
    "load_staging_rejects",
    "misfits",
    "read_csv_table",
    "read_indexed_json",
    "read_jsonl",
    "read_table",
    "save_observed",
    "save_table",
    "staging_ddl",
    "write_csv_table",
    "write_documents",
    "write_indexed_json",
]
