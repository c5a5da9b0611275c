"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from bibliospark.functions.arrays import first_last, first_or_null
from bibliospark.functions.dates import date_attributes, format_rfc1123, parse_rfc1123
from bibliospark.functions.text import first_char, first_token, join_tail, last_token

__all__ = [
    "date_attributes",
    "first_char",
    "first_last",
    "first_or_null",
    "first_token",
    "format_rfc1123",
    "join_tail",
    "last_token",
    "parse_rfc1123",
]
