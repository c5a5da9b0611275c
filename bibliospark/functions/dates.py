"""Date text parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bibliospark.functions._util import as_col

# Fixed formats: version stamps look like "Mon, 2 Apr 2007 19:18:42 GMT"
# (RFC 1123, C strptime "%a, %d %b %Y %H:%M:%S %Z").
RFC1123_PARSE = "d MMM yyyy HH:mm:ss"
RFC1123_FORMAT = "EEE, d MMM yyyy HH:mm:ss"


def parse_rfc1123(c) -> Column:
    """RFC-1123 text -> ``timestamp_ntz`` of the wall clock as written (like
    strptime, which yields a naive datetime); malformed text gives null.

    Spark rejects the day-name letter when parsing, so the weekday and its
    comma are stripped first (redundant with the date), and the zone name
    (GMT / UTC in this data) is dropped.  Parsing in the session zone and
    casting back to ``timestamp_ntz`` returns the written wall clock
    whatever the session time zone."""
    body = F.regexp_replace(F.trim(as_col(c)), r"^[A-Za-z]+,\s*", "")
    body = F.regexp_replace(body, r"\s+[A-Za-z]+$", "")
    return F.try_to_timestamp(body, F.lit(RFC1123_PARSE)).cast("timestamp_ntz")


def format_rfc1123(ts) -> Column:
    """timestamp -> RFC-1123 text in GMT (session time zone is UTC)."""
    return F.concat(F.date_format(as_col(ts), RFC1123_FORMAT), F.lit(" GMT"))


def date_attributes(d) -> dict[str, Column]:
    """Calendar columns of a date dimension row, keyed by output name.

    day_of_week is ISO (Mon=1..Sun=7), week_of_year the ISO week, and
    week_of_month counts 7-day blocks from the 1st (PostgreSQL ``W``)."""
    d = as_col(d)
    iso_dow = F.extract(F.lit("DAYOFWEEK_ISO"), d)
    iso_week = F.extract(F.lit("WEEK"), d)
    return {
        "date_dim_id": F.date_format(d, "yyyyMMdd").cast("int"),
        "date_actual": d,
        # seconds since 1970-01-01 00:00 of the date itself (no session zone)
        "epoch": (F.datediff(d, F.lit("1970-01-01").cast("date")).cast("bigint") * F.lit(86400)),
        "day_of_week": iso_dow.cast("int"),
        "day_of_month": F.dayofmonth(d),
        "week_of_month": (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("int"),
        "week_of_year": iso_week.cast("int"),
        "week_of_year_iso": F.concat(
            F.extract(F.lit("YEAROFWEEK"), d).cast("string"),
            F.lit("-W"),
            F.lpad(iso_week.cast("string"), 2, "0"),
            F.lit("-"),
            iso_dow.cast("string"),
        ),
        "month_actual": F.month(d),
        "year_actual": F.year(d),
    }
