"""Delimited files: single tables, and folders of files whose column order differs."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docstrata.conventions import CATALOG_FILE, DATA_TYPE, FIELD, HIERARCHY
from docstrata.errors import LayoutError, NameClash
from docstrata.functions.names import base_name
from docstrata.functions.schema_walk import top_column
from docstrata.sources.files import dataset_below, decoded_path, qualified
from docstrata.sources.first_lines import first_lines


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    separator: str = ",",
    null_value: str = "",
    recurse: bool = True,
    multiline: bool = True,
) -> DataFrame:
    """A delimited table with a header. Without ``schema`` all columns are text.

    Quoted values may hold line breaks, so each file is read by one task; tables written here consist of
    many files. ``multiline=False`` splits large files, for tables known to have no such values.
    """
    reader = (
        spark.read.option("header", True).option("sep", separator).option("quote", '"').option("escape", '"')
        .option("nullValue", null_value).option("recursiveFileLookup", recurse).option("multiLine", multiline)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def file_headers(spark: SparkSession, folder: str, suffix: str = ".csv", known: DataFrame | None = None) -> DataFrame:
    """``path, dataset, header``: each file of the tables below a folder with its first line.

    Only the first bytes of a file are read, and nothing of files whose ``path`` is in ``known``. Files without any line have no
    header and are not listed. A header that itself holds a line break is not supported.
    """
    dataset = dataset_below(qualified(spark, folder), F.col("path"), suffix)
    return first_lines(spark, folder, dataset.isNotNull(), known).select("path", dataset.alias("dataset"), "header")


def header_names(line: str, separator: str = ",") -> tuple[str, ...]:
    """Column names of a header line. A name that stands twice cannot be told apart and is refused."""
    names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=separator), [])
    for place, name in enumerate(names):
        if name in names[:place]:
            raise NameClash(name, f"column {names.index(name)}", f"column {place}")
    return tuple(names)


def read_alike(
    spark: SparkSession, headers: Mapping[str, Sequence[str]], separator: str = ",", multiline: bool = True, origin: str | None = None
) -> DataFrame:
    """Files matched by column name. ``headers`` gives the files of each distinct header line, which are one scan.

    No rows are joined or regrouped: each scan has the columns its header names, and a row that looks like a header is a row.
    ``origin`` names a column for the plain file name of the table a row comes from.
    """
    frames = []
    for line, paths in headers.items():
        names = header_names(line, separator)
        if origin and origin in names:
            raise NameClash(origin, "file name", "column")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        rows = read_delimited(spark, list(paths), schema, separator, multiline=multiline)
        if origin:
            path = decoded_path(rows.metadataColumn("_metadata").getField("file_path"))
            named = F.regexp_extract(path, r"(?:^|/)([^/]*\.csv)(?:/|$)", 1)
            rows = rows.withColumn(origin, F.when(named != "", named).otherwise(base_name(path)))
        frames.append(rows)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def by_header(found: DataFrame) -> dict[str, list[str]]:
    """Paths of each distinct header line. Brings the list of files, never rows, to the driver, where a scan needs it anyway."""
    groups: dict[str, list[str]] = {}
    for row in found.orderBy("path").toLocalIterator():
        groups.setdefault(row.header, []).append(row.path)
    return groups


def read_delimited_by_name(
    spark: SparkSession, folder: str, columns: Sequence[str] | None = None, required: Sequence[str] | None = None, separator: str = ","
) -> DataFrame:
    """All ``.csv`` files below a folder as one table, matched by column name, plus ``filename``.

    Reading many delimited files at once matches by position and would mix up files whose columns are ordered
    differently. Here files are grouped by their header line. ``columns`` are the columns wanted (all that occur, if
    none are named), null where a file lacks them; a file that lacks one of ``required`` stops the job.
    """
    groups = by_header(file_headers(spark, folder))
    if not groups:
        raise LayoutError(f"no delimited files below {folder!r}")
    for line, paths in groups.items():
        lacking = [name for name in (columns or () if required is None else required) if name not in header_names(line, separator)]
        if lacking:
            raise LayoutError(f"no header row with {lacking} in {paths[0]}")
    rows = read_alike(spark, groups, separator, origin=CATALOG_FILE)
    if columns is None:
        return rows.select(*[top_column(name) for name in rows.columns if name != CATALOG_FILE], CATALOG_FILE)
    return rows.select(*[(top_column(name) if name in rows.columns else F.lit(None).cast("string")).alias(name) for name in columns], CATALOG_FILE)


def read_catalogs(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue files of a folder merged: ``Field, Hierarchy, Data Type, filename``."""
    return read_delimited_by_name(spark, folder, [FIELD, HIERARCHY, DATA_TYPE], required=[FIELD, DATA_TYPE])
