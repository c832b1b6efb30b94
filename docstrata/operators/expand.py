"""Structs to columns, arrays away. Everything is worked out from the schema into one ``select``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, types as T

from docstrata.errors import NameClash
from docstrata.functions.schema_walk import Path, dotted, is_array, is_struct, top_column
from docstrata.session import is_case_sensitive


@dataclass(frozen=True)
class Cell:
    """A column of the table being laid out, with the source path it shows."""

    name: str
    column: Column
    data_type: T.DataType
    path: Path

    def fields(self, prefixed: bool) -> list[Cell]:
        return [
            Cell(
                f"{self.name}_{field.name}" if prefixed else field.name,
                self.column.getField(field.name),
                field.dataType,
                self.path + (field.name,),
            )
            for field in self.data_type.fields
        ]


def top_cells(schema: T.StructType) -> list[Cell]:
    return [Cell(f.name, top_column(f.name), f.dataType, (f.name,)) for f in schema.fields]


def open_structs(cells: Sequence[Cell], prefixed: bool = True) -> list[Cell]:
    """Breadth first: each round keeps the plain cells and appends the fields of that round's structs."""
    cells = list(cells)
    while any(is_struct(cell.data_type) for cell in cells):
        plain = [cell for cell in cells if not is_struct(cell.data_type)]
        opened = [child for cell in cells if is_struct(cell.data_type) for child in cell.fields(prefixed)]
        cells = plain + opened
    return cells


def without_arrays(cells: Iterable[Cell]) -> list[Cell]:
    return [cell for cell in cells if not is_array(cell.data_type)]


def reject_clashes(cells: Iterable[Cell], case_sensitive: bool) -> None:
    seen: dict[str, Cell] = {}
    for cell in cells:
        other = seen.setdefault(cell.name if case_sensitive else cell.name.lower(), cell)
        if other is not cell:
            raise NameClash(cell.name, dotted(other.path), dotted(cell.path))


def select_cells(df: DataFrame, cells: Sequence[Cell]) -> DataFrame:
    reject_clashes(cells, is_case_sensitive(df.sparkSession))
    return df.select(*[cell.column.alias(cell.name) for cell in cells])


def expand_structs(df: DataFrame, prefixed: bool = True) -> DataFrame:
    """Replace every struct, at any depth outside arrays, by its fields.

    ``s struct<f>`` becomes ``s_f``, or ``f`` with ``prefixed=False``. Arrays stay as they are.
    """
    return select_cells(df, open_structs(top_cells(df.schema), prefixed))


def _pruned_struct(column: Column, data_type: T.StructType) -> tuple[Column, bool]:
    """The struct without arrays at any depth, and whether anything is left of it."""
    gone = []
    for field in data_type.fields:
        if is_array(field.dataType):
            gone.append(field.name)
        elif is_struct(field.dataType):
            inner, something_left = _pruned_struct(column.getField(field.name), field.dataType)
            if not something_left:
                gone.append(field.name)
            elif inner is not None:
                column = column.withField("`" + field.name.replace("`", "``") + "`", inner)
    if len(gone) == len(data_type.fields):
        return column, False
    if gone:
        column = column.dropFields(*["`" + name.replace("`", "``") + "`" for name in gone])
    return column, True


def drop_arrays(df: DataFrame) -> DataFrame:
    """Remove arrays at the top level and inside structs; a struct holding only arrays goes too."""
    kept = []
    for cell in top_cells(df.schema):
        if is_array(cell.data_type):
            continue
        if is_struct(cell.data_type):
            column, something_left = _pruned_struct(cell.column, cell.data_type)
            if something_left:
                kept.append(column.alias(cell.name))
        else:
            kept.append(cell.column)
    return df.select(*kept)
