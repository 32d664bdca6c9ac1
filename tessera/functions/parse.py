"""Text parsing with ANSI-safe ``try_`` functions: currency, dates, whitespace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two date layouts found in the record files, tried in this
# order ("2020 Jan 02 01:10:00 PM" and "01/02/2020 01:10:00 PM").
RECORD_DATE_FORMATS: tuple[str, ...] = ("yyyy MMM dd hh:mm:ss a", "MM/dd/yyyy hh:mm:ss a")

# Whitespace as Java's ``\s`` defines it (space, tab, newline,
# vertical tab, form feed, carriage return), spelled out so the same pattern
# means the same thing in Java regex and in RE2-based engines.
WS_CLASS = r"[ \t\n\x0B\f\r]"
NON_WS_CLASS = r"[^ \t\n\x0B\f\r]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_currency(text: Column | str) -> Column:
    """``"$12,345.60"`` -> 12345.6; anything unparseable -> NULL (never an error)."""
    cleaned = F.regexp_replace(_col(text), r"[$,]", "")
    return cleaned.try_cast("double")


def render_currency(amount: Column | str) -> Column:
    """12345.6 -> ``"$12,345.60"`` (two decimals, thousands separators)."""
    return F.concat(F.lit("$"), F.format_number(_col(amount), 2))


def parse_timestamp_any(text: Column | str, formats: Sequence[str] = RECORD_DATE_FORMATS) -> Column:
    """First layout that parses wins; NULL when none does (``try_to_timestamp``)."""
    t = _col(text)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(fmt)) for fmt in formats])


def split_tokens(text: Column | str) -> Column:
    """Array of the non-empty whitespace-separated tokens of ``text``."""
    parts = F.split(_col(text), WS_CLASS + "+")
    return F.filter(parts, lambda s: s != F.lit(""))
