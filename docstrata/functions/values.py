"""Tests on the text of a value, defaults, and timestamp and JSON rendering."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from docstrata.conventions import DECIMAL_TEXT, INTEGER_TEXT, LISTING_TIMESTAMP, MISSING_ATTRIBUTE

NESTED_TYPES = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def as_text(column: Column, data_type: T.DataType) -> Column:
    """The value as text. Nested values become JSON, everything else its ordinary cast."""
    if isinstance(data_type, T.StringType):
        return column
    return F.to_json(column) if isinstance(data_type, NESTED_TYPES) else column.cast("string")


def is_empty_text(text: Column) -> Column:
    return text == F.lit("")


def is_filled_text(text: Column) -> Column:
    return text.isNotNull() & (text != F.lit(""))


def _starts_with_digit(text: Column) -> Column:
    # A byte-level look at the first character. It spares the regular expression, and the decoding of
    # the whole text that comes with it, for nearly all prose.
    return F.substring(text, 1, 1).between(F.lit("0"), F.lit("9"))


def is_integer_text(text: Column) -> Column:
    return _starts_with_digit(text) & text.rlike(INTEGER_TEXT)


def is_decimal_text(text: Column) -> Column:
    """Unsigned decimal text; integers are a subset."""
    return _starts_with_digit(text) & text.rlike(DECIMAL_TEXT)


def is_numeric_or_present(text: Column) -> Column:
    """Matches either number pattern, or is simply not null."""
    return is_integer_text(text) | is_decimal_text(text) | text.isNotNull()


def with_default(column: Column, default: str = MISSING_ATTRIBUTE) -> Column:
    return F.coalesce(column, F.lit(default))


def listing_time(timestamp: Column) -> Column:
    return F.date_format(timestamp, LISTING_TIMESTAMP)


def iso_time(timestamp: Column) -> Column:
    """ISO-8601 text with microseconds only where there are any."""
    whole = F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(timestamp, "SSSSSS")
    return F.when(micros == F.lit("000000"), whole).otherwise(F.concat(whole, F.lit("."), micros))


def pretty_json(column: Column) -> Column:
    return F.to_json(column, {"pretty": "true", "ignoreNullFields": "false"})
