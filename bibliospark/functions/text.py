"""String helpers: whitespace tokens, joined list tails, first character."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bibliospark.functions._util import as_col


# The characters Python's str.split() treats as whitespace
# (tab, newline, vertical tab, form feed, carriage return, the four
# information separators, space, next line, no-break space, ogham space mark,
# en quad through hair space, line and paragraph separators, narrow no-break
# space, medium mathematical space, ideographic space), written with \x{...}
# escapes that Java regex and RE2 both read.
WHITESPACE = (r"\x{9}\x{a}\x{b}\x{c}\x{d}\x{1c}\x{1d}\x{1e}\x{1f}\x{20}\x{85}\x{a0}\x{1680}"
              r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
FIRST_TOKEN = f"^[{WHITESPACE}]*([^{WHITESPACE}]+)"
LAST_TOKEN = f"([^{WHITESPACE}]+)[{WHITESPACE}]*$"


def first_token(c) -> Column:
    """First whitespace-separated token (``s.split()[0]``); '' when there is none."""
    return F.regexp_extract(as_col(c), FIRST_TOKEN, 1)


def last_token(c) -> Column:
    """Last whitespace-separated token (``s.split()[-1]``); '' when there is none.

    Computed as the first token of the reversed text (reversed back): an
    anchored match is linear, while an end-anchored pattern is retried from
    every position of a long text.  Same result as ``LAST_TOKEN``."""
    return F.reverse(F.regexp_extract(F.reverse(as_col(c)), FIRST_TOKEN, 1))


def join_tail(arr, sep: str = " ") -> Column:
    """``sep.join(a[1:])``: elements 2..n joined; '' for one element, and a
    trailing blank survives when the last element is ''."""
    a = as_col(arr)
    return F.array_join(F.slice(a, 2, F.greatest(F.size(a), F.lit(1))), sep)


def first_char(c) -> Column:
    """First character (code point) of a string; '' for ''."""
    return F.substring(as_col(c), 1, 1)
