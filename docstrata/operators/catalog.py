"""Schema catalogue: one row per field of a nested schema. Metadata only, no job runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docstrata.conventions import DATA_TYPE, FIELD, HIERARCHY, STRUCT_ARRAY_TEXT, TOP_LEVEL
from docstrata.functions.names import parent_path
from docstrata.functions.schema_walk import dotted, schema_entries

CATALOG_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in (FIELD, HIERARCHY, DATA_TYPE)])


def catalog_of(spark: SparkSession, schema: T.StructType) -> DataFrame:
    rows = [(entry.field, entry.hierarchy, entry.text) for entry in schema_entries(schema)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def schema_catalog(df: DataFrame) -> DataFrame:
    """``Field, Hierarchy, Data Type`` of every field, parents first."""
    return catalog_of(df.sparkSession, df.schema)


def with_hierarchy(catalog: DataFrame) -> DataFrame:
    """Derive ``Hierarchy`` for a catalogue that only has ``Field`` and ``Data Type``."""
    return catalog.withColumn(HIERARCHY, parent_path(F.col(FIELD), TOP_LEVEL)).select(FIELD, HIERARCHY, DATA_TYPE)


def array_fields(catalog: DataFrame) -> DataFrame:
    """Catalogue rows that become child tables."""
    return catalog.filter(F.col(DATA_TYPE) == STRUCT_ARRAY_TEXT)


def on_the_way_to(path: str | Sequence[str]) -> Column:
    """Predicate: ``Field`` is the path or one of its ancestors, segment by segment."""
    text = path if isinstance(path, str) else dotted(path)
    return F.lit(text + ".").startswith(F.concat(F.col(FIELD), F.lit(".")))


def ancestors(catalog: DataFrame, path: str | Sequence[str]) -> DataFrame:
    return catalog.filter(on_the_way_to(path))


def schema_tree(df: DataFrame) -> str:
    return df.schema.treeString()


def schema_tree_rows(df: DataFrame) -> DataFrame:
    """The printed schema tree, one row per line."""
    lines = schema_tree(df).rstrip("\n").split("\n")
    return df.sparkSession.createDataFrame(list(enumerate(lines)), "line_no int, line string")
