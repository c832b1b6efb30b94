"""Documents to a main table and one child table per array-of-struct path.

All of these are narrow plans: a projection and one generator per array level, no shuffle. A document
is never regrouped; rows of different tables find each other by ``root_id`` and the ``*_pos`` columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from docstrata.conventions import DOCUMENT_KEY, POSITION_SUFFIX, ROOT_KEY
from docstrata.errors import LayoutError, NameClash
from docstrata.functions.names import child_table_name
from docstrata.functions.schema_walk import (
    ArrayLevel,
    array_levels,
    array_paths,
    dig,
    dotted,
    resolve_array_path,
    top_column,
    underscored,
)
from docstrata.operators.expand import Cell, open_structs, select_cells, top_cells, without_arrays
from docstrata.session import is_case_sensitive

_ITEM, _ROOT, _ORIGIN = "__item", "__root", "__origin"


def main_table(df: DataFrame) -> DataFrame:
    """One row per document: structs as prefixed columns, arrays left out."""
    return select_cells(df, without_arrays(open_structs(top_cells(df.schema))))


def _position_names(levels: Sequence[ArrayLevel], taken: dict[str, str], case_sensitive: bool) -> list[str]:
    """``<array>_pos`` per level, or the underscored full path where that name is in use."""
    key = (lambda name: name) if case_sensitive else str.lower
    used = {key(name): path for name, path in taken.items()}
    names = []
    for level in levels:
        name = level.name + POSITION_SUFFIX
        if key(name) in used:
            name = underscored(level.path) + POSITION_SUFFIX
        if key(name) in used:
            raise NameClash(name, used[key(name)], f"position in {dotted(level.path)}")
        used[key(name)] = f"position in {dotted(level.path)}"
        names.append(name)
    return names


def opened(df: DataFrame, keep: Sequence[Column], array: Column, position: str, item: str, stored: bool = False) -> DataFrame:
    """One row per element of ``array``, with its position.

    From an inner generator Spark derives the filter that the array is not empty. Over an array ``stored`` in Parquet the
    scan uses it to skip documents; over one computed in the plan it would compute the array a second time. So the
    general form is an outer generator, with the rows of empty arrays left out by their missing position.
    """
    if stored:
        return df.select(*keep, F.posexplode(array).alias(position, item))
    return df.select(*keep, F.posexplode_outer(array).alias(position, item)).where(F.col(position).isNotNull())


def child_table(
    df: DataFrame,
    path: str | Sequence[str],
    key_col: str = DOCUMENT_KEY,
    keys: bool = True,
    origin_col: str | None = None,
    stored: bool = False,
    primitive: bool = False,
) -> DataFrame:
    """One row per element of the array at ``path``.

    Columns: ``root_id``, the position at every array level, then the element's fields with structs
    expanded and arrays left out; scalars of outer levels are not repeated. Documents without an
    element at some level give no row. ``keys=False`` leaves out key and positions. ``origin_col``
    names a top-level column (such as the source file name) to carry along as last column. ``stored`` says that
    ``df`` was just read from Parquet; see ``opened``. With ``primitive`` the path may also be of an array of plain values, each in
    a column named like the array.
    """
    schema = df.schema
    levels = array_levels(schema, resolve_array_path(schema, path, primitive))
    if keys and key_col not in schema.names:
        raise LayoutError(f"documents have no key column {key_col!r}; pass key_col or keys=False")

    outer = [top_column(key_col).alias(_ROOT)] if keys else []
    if origin_col:
        outer.append(top_column(origin_col).alias(_ORIGIN))
    item = None
    for depth, level in enumerate(levels):
        array = dig(item, level.hops)
        df = opened(df, outer, array, f"__pos{depth}", _ITEM, stored)
        outer = [F.col(name) for name in df.columns if name != _ITEM and (keys or not name.startswith("__pos"))]
        item = F.col(_ITEM)

    last = levels[-1]
    head = [Cell(ROOT_KEY, F.col(_ROOT), schema[key_col].dataType, (key_col,))] if keys else []
    if isinstance(last.element, T.StructType):
        body = [Cell(f.name, item.getField(f.name), f.dataType, last.path + (f.name,)) for f in last.element.fields]
    else:
        body = [Cell(last.name, item, last.element, last.path)]
    tail = [Cell(origin_col, F.col(_ORIGIN), schema[origin_col].dataType, (origin_col,))] if origin_col else []
    positions = []
    if keys:
        taken = {cell.name: dotted(cell.path) for cell in without_arrays(open_structs(head + body)) + tail}
        names = _position_names(levels, taken, is_case_sensitive(df.sparkSession))
        positions = [
            Cell(name, F.col(f"__pos{depth}"), T.IntegerType(), levels[depth].path) for depth, name in enumerate(names)
        ]
    return select_cells(df, without_arrays(open_structs(head + positions + body)) + tail)


def child_tables(
    df: DataFrame, key_col: str = DOCUMENT_KEY, keys: bool = True, origin_col: str | None = None, stored: bool = False,
    primitive_arrays: bool = False,
) -> dict[str, DataFrame]:
    """Every child table of the documents, by table name. Nothing runs until a table is used.

    ``primitive_arrays`` adds a table for each array of plain values.
    """
    tables: dict[str, DataFrame] = {}
    source: dict[str, str] = {}
    for path in array_paths(df.schema, primitive_arrays):
        name = child_table_name(dotted(path))
        if name in tables:
            raise NameClash(name, source[name], dotted(path))
        source[name] = dotted(path)
        tables[name] = child_table(df, path, key_col, keys, origin_col, stored, primitive_arrays)
    return tables


def batches(tables: dict[str, DataFrame], size: int = 5) -> Iterator[dict[str, DataFrame]]:
    """The tables in groups of ``size``, for callers that write a few tables per run."""
    names = list(tables)
    for start in range(0, len(names), size):
        yield {name: tables[name] for name in names[start:start + size]}


def tables_as_one(tables: dict[str, DataFrame], tag: str = "table_name") -> DataFrame:
    """All tables stacked by column name in a single plan, each row tagged with its table."""
    stacked = None
    for name, table in tables.items():
        tagged = table.select(F.lit(name).alias(tag), "*")
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    if stacked is None:
        raise LayoutError("no tables to stack")
    return stacked


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, including tables with none, in one job."""
    counted = {name: table.agg(F.count("*").alias("row_count")) for name, table in tables.items()}
    return tables_as_one(counted)
