"""Delimited files to warehouse tables, and a worked two-level extraction."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from docstrata.conventions import CATALOG_FILE_NAME, DOCUMENT_KEY
from docstrata.functions.names import base_name, routed_table
from docstrata.functions.schema_walk import top_column
from docstrata.operators.expand import Cell, select_cells
from docstrata.operators.extract import opened
from docstrata.operators.nulls import empty_to_null
from docstrata.sinks.tables import save_table
from docstrata.sources.delimited import file_headers, read_alike


def folder_tables(
    spark: SparkSession, folder: str, target_schema: str | None = None, separator: str = ",", multiline: bool = True
) -> dict[str, DataFrame]:
    """Every table found below a folder, by name; files routed to one name are one table, matched by column name.

    One pass over the first lines of all files tells which of them are read together.
    """
    name = routed_table(base_name(F.col("dataset")), target_schema)
    found = file_headers(spark, folder).where(base_name(F.col("dataset")) != CATALOG_FILE_NAME)
    tables: dict[str, dict[str, list[str]]] = {}
    for row in found.select("path", "header", name.alias("table_name")).orderBy("path").toLocalIterator():
        tables.setdefault(row.table_name, {}).setdefault(row.header, []).append(row.path)
    return {table: read_alike(spark, headers, separator, multiline) for table, headers in tables.items()}


def load_folder(
    spark: SparkSession,
    folder: str,
    target_schema: str | None = None,
    mode: str = "append",
    location: str | None = None,
    concurrent: int = 1,
    multiline: bool = True,
) -> list[str]:
    """Load every table found below a folder into a catalogue table, empty text as null.

    Files routed to one table are loaded together. Only the list of files to load is brought to the
    driver; rows stay distributed. ``concurrent`` tables are loaded at a time. For ``multiline`` see
    ``read_delimited``.
    """
    tables = folder_tables(spark, folder, target_schema, multiline=multiline)

    def load(table_name: str) -> str:
        rows = empty_to_null(tables[table_name])
        save_table(rows, table_name, mode, f"{location.rstrip('/')}/{table_name}" if location else None)
        return table_name

    with ThreadPoolExecutor(max_workers=max(1, concurrent)) as pool:
        return list(pool.map(load, tables))


def two_level_rows(
    df: DataFrame,
    outer: str,
    inner: str,
    outer_fields: Sequence[str],
    drop: Sequence[str] = (),
    key_col: str = DOCUMENT_KEY,
) -> DataFrame:
    """Key, some fields of the outer array's elements, and all fields of the inner array's elements.

    Two of these of one name are a ``NameClash``, found while planning.
    """
    outer_type = df.schema[outer].dataType.elementType
    inner_type = outer_type[inner].dataType.elementType
    levels = opened(df, [top_column(key_col).alias("__key")], top_column(outer), "__outer_pos", "__outer_item")
    item = F.col("__outer_item")
    rows = opened(levels, [F.col("__key"), item], item.getField(inner), "__inner_pos", "__inner_item")
    cells = [Cell(key_col, F.col("__key"), df.schema[key_col].dataType, (key_col,))]
    cells += [Cell(n, item.getField(n), outer_type[n].dataType, (outer, n)) for n in outer_fields]
    cells += [
        Cell(f.name, F.col("__inner_item").getField(f.name), f.dataType, (outer, inner, f.name))
        for f in inner_type.fields if f.name not in drop
    ]
    return empty_to_null(select_cells(rows, [cell for cell in cells if cell.name not in drop]))
