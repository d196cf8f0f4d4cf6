"""Text cleaning, all built-in expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F

from wareloom.schemas import AVAILABLE, FILL_COLUMNS, NOT_AVAILABLE, UNKNOWN

# Every character Unicode calls white space, including the no-break spaces
# that a plain trim() leaves in place.
WHITE_SPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())

# Non-ASCII decimal digits and their values, so a price typed with them counts.
_WIDE_DIGITS = [c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isdecimal()]
_WIDE_VALUES = "".join(str(unicodedata.decimal(c)) for c in _WIDE_DIGITS)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def strip_html(text: Column) -> Column:
    """Drop ``<...>`` runs that stay on one line, trim; NULL becomes ``''``.

    Only a line feed ends a line here, so the class is spelled out instead of
    using a dot. Entities stay as they are.
    """
    return strip(F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^\n]*?>", ""))


def ascii_digits(text: Column) -> Column:
    has_wide = text.rlike(r"[^\x00-\x7F]")
    return F.when(has_wide, F.translate(text, "".join(_WIDE_DIGITS), _WIDE_VALUES)).otherwise(text)


def text_price(text: Column) -> Column:
    """Number left after deleting all but digits and dots, else NULL."""
    kept = F.regexp_replace(ascii_digits(text), r"[^0-9.]", "")
    return F.nullif(kept, F.lit("")).try_cast("double")


def numeric_price(value: Column) -> Column:
    """Numbers pass through with their sign; NaN counts as missing."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def clean_price(value: Column, data_type: str) -> Column:
    """Pick the price rule by the column's declared type."""
    return text_price(value) if data_type == "string" else numeric_price(value)


def availability_flag(label: Column) -> Column:
    """1 for the word "available" in any case and nothing around it, else 0."""
    return F.when(F.lower(label) == AVAILABLE.lower(), 1).otherwise(0)


def fill(text: Column, value: str = NOT_AVAILABLE) -> Column:
    return F.coalesce(text, F.lit(value))


def fill_missing(df, columns=FILL_COLUMNS, value: str = NOT_AVAILABLE):
    """NULL to ``value``; a column that is not there is created."""
    present = set(df.columns)
    return df.withColumns({
        c: fill(F.col(c), value) if c in present else F.lit(value) for c in columns
    })


def platform_or_unknown(platform: Column) -> Column:
    return fill(platform, UNKNOWN)
