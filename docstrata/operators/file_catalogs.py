"""Schema catalogues of many files at once, from one pass over their lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docstrata.conventions import CATALOG_FILE, DATA_TYPE, FIELD, HIERARCHY
from docstrata.functions.names import base_name
from docstrata.functions.schema_walk import schema_entries, top_column
from docstrata.functions.shapes import settled, shape_type
from docstrata.sources.documents import single_document
from docstrata.sources.files import decoded_path

_ENTRY = T.StructType([T.StructField(name, T.StringType()) for name in (FIELD, HIERARCHY, DATA_TYPE, CATALOG_FILE)])


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (entry.field, entry.hierarchy, entry.text, name)
            for name, shape in zip(batch["name"], batch["shape"])
            for entry in schema_entries(settled(shape_type(shape)))
        ]
        yield pd.DataFrame(rows, columns=_ENTRY.names)


def shapes_of(texts: DataFrame, value: str, *keys: Column) -> DataFrame:
    """``keys`` and ``shape``: what the JSON objects among the texts of each key have in common, merged task by task.

    Texts that are no single object (see ``single_document``) have no shape; a key with none but such has no row.
    """
    found = single_document(top_column(value))
    objects = texts.select(*keys, F.when(F.try_variant_get(found, "$", "map<string,variant>").isNotNull(), found).alias("__found")).where("__found IS NOT NULL")
    names = [top_column(name) for name in objects.columns[:-1]]
    return objects.groupBy(*names).agg(F.schema_of_variant_agg("__found").alias("shape"))


def text_catalogs(texts: DataFrame, value: str, name: Column) -> DataFrame:
    """``Field, Hierarchy, Data Type, filename``: the schema catalogue of the documents of each name.

    Names of any number cost one pass and one partial aggregate; only a shape per name goes on. A field whose values differ in
    type within a name is text, as it is for a reader of that one file.
    """
    return shapes_of(texts, value, name.alias("name")).mapInPandas(_entries, _ENTRY)


def file_catalogs(spark: SparkSession, path: str | list[str], name: Column | None = None) -> DataFrame:
    """The catalogue of every JSON Lines file: what ``read_catalogs`` would merge, without catalogue files and a job for each.

    ``name`` says what a file counts under, from its plain path in a column ``path``; without it, its own name.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    source = lines.metadataColumn("_metadata").getField("file_path")
    placed = lines.select("value", decoded_path(source).alias("path"))
    return text_catalogs(placed, "value", base_name(F.col("path")) if name is None else name)
