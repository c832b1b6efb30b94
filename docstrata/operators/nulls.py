"""Empty text, null and the export marker."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from docstrata.conventions import NULL_MARKER
from docstrata.functions.schema_walk import top_column
from docstrata.functions.values import as_text


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become null in every string column; other columns stay as they are."""
    return df.select(*[
        F.when(top_column(f.name) != F.lit(""), top_column(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else top_column(f.name)
        for f in df.schema.fields
    ])


def mark_nulls(df: DataFrame, marker: str = NULL_MARKER) -> DataFrame:
    """Every column as text, with ``marker`` for null."""
    return df.select(*[
        F.coalesce(as_text(top_column(f.name), f.dataType), F.lit(marker)).alias(f.name) for f in df.schema.fields
    ])


def fill_missing(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """A default text for null in the named columns."""
    return df.na.fill(defaults)
