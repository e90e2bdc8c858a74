"""Numbers held as text: cleaning, formatting and parsing back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NOT_NUMERIC = r"[^0-9.]"
AREA_NUMBER = r"(?iU)(\d+(?:[.,]\d+)?)\s*(?:m²|m2|mét|vuông)"
BILLION = 1e9


def clean_number(text: Column) -> Column:
    """Keep digits and dots, then read as double. No number gives NULL.

    This is the strict cleaning the reports use: ``80 m²`` is 80, but the digit
    of ``m2`` counts (``80 m2`` is 802) and a decimal comma vanishes.
    ``parse_area`` is the unit-aware alternative.
    """
    return F.regexp_replace(text, NOT_NUMERIC, "").try_cast("double")


def parse_area(text: Column) -> Column:
    """Area in square metres read from number plus unit; ``80,5 m2`` is 80.5."""
    number = F.regexp_extract(text, AREA_NUMBER, 1)
    return F.replace(number, F.lit(","), F.lit(".")).try_cast("double")


def format_money(number: Column) -> Column:
    """Whole number with thousands commas, halves rounded to even."""
    return F.format_number(number, 0)


def format_area(number: Column) -> Column:
    """At most two decimals with thousands commas, in the shape ``FM999,999,999.99``.

    That shape drops trailing zeros but keeps the point (``80.``), and drops a
    zero in front of the point when decimals follow (``.5``).
    """
    no_trailing_zeros = F.regexp_replace(F.format_number(number, 2), r"0{1,2}$", "")
    return F.regexp_replace(no_trailing_zeros, r"^(-?)0(?=\.[0-9])", "$1")


def parse_formatted(text: Column) -> Column:
    """Read formatted text back as double."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def in_billions(number: Column) -> Column:
    return number / F.lit(BILLION)
