"""Reading a nested schema: entries in document order, array paths, column access by segments.

A path is kept as a tuple of field names. The dotted text is for display only, because a field name
may itself contain a dot.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from docstrata.conventions import STRUCT_ARRAY_TEXT, STRUCT_TEXT, TOP_LEVEL
from docstrata.errors import LayoutError

Path = tuple[str, ...]


def dotted(path: Sequence[str]) -> str:
    return ".".join(path)


def underscored(path: Sequence[str]) -> str:
    return "_".join(path).replace(".", "_")


def top_column(name: str) -> Column:
    """The top-level column called exactly ``name``, whatever characters it contains."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_struct(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StructType)


def is_array(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.ArrayType)


def is_struct_array(data_type: T.DataType) -> bool:
    return is_array(data_type) and is_struct(data_type.elementType)


def record_type(data_type: T.DataType) -> T.StructType | None:
    """The record whose fields lie below this type, or None for a leaf."""
    if is_struct(data_type):
        return data_type
    return data_type.elementType if is_struct_array(data_type) else None


def type_text(data_type: T.DataType) -> str:
    if is_struct(data_type):
        return STRUCT_TEXT
    return STRUCT_ARRAY_TEXT if is_struct_array(data_type) else data_type.simpleString()


@dataclass(frozen=True)
class SchemaEntry:
    path: Path
    data_type: T.DataType

    @property
    def field(self) -> str:
        return dotted(self.path)

    @property
    def hierarchy(self) -> str:
        return dotted(self.path[:-1]) or TOP_LEVEL

    @property
    def text(self) -> str:
        return type_text(self.data_type)


def schema_entries(schema: T.StructType, above: Path = ()) -> Iterator[SchemaEntry]:
    """Every field of the schema, parents before their children."""
    for field in schema.fields:
        entry = SchemaEntry(above + (field.name,), field.dataType)
        yield entry
        record = record_type(field.dataType)
        if record is not None:
            yield from schema_entries(record, entry.path)


def array_paths(schema: T.StructType, primitive: bool = False) -> list[Path]:
    """Paths of all arrays of structs, with ``primitive`` of all arrays, outer arrays first."""
    wanted = is_array if primitive else is_struct_array
    return [entry.path for entry in schema_entries(schema) if wanted(entry.data_type)]


def resolve_array_path(schema: T.StructType, path: str | Sequence[str], primitive: bool = False) -> Path:
    """The array-of-struct path (with ``primitive`` any array) meant by a dotted text or by a sequence of segments."""
    known = array_paths(schema, primitive)
    wanted = path if isinstance(path, str) else dotted(path)
    matches = [p for p in known if (dotted(p) == path if isinstance(path, str) else p == tuple(path))]
    if len(matches) > 1:
        raise LayoutError(f"{wanted!r} fits several paths {matches}; pass a sequence of segments")
    if not matches:
        raise LayoutError(f"no array of structs at {wanted!r}; there are {[dotted(p) for p in known]}")
    return matches[0]


@dataclass(frozen=True)
class ArrayLevel:
    """One array on the way to a path: the field names leading to it from the level above."""

    hops: Path
    path: Path
    element: T.DataType

    @property
    def name(self) -> str:
        return self.path[-1]


def array_levels(schema: T.StructType, path: Path) -> list[ArrayLevel]:
    levels: list[ArrayLevel] = []
    record, start = schema, 0
    for end, segment in enumerate(path, start=1):
        data_type = record[segment].dataType
        record = record_type(data_type)
        if is_array(data_type):
            levels.append(ArrayLevel(path[start:end], path[:end], data_type.elementType))
            start = end
    return levels


def dig(base: Column | None, hops: Sequence[str]) -> Column:
    """Follow field names below ``base`` (or from the top of the row)."""
    column = top_column(hops[0]) if base is None else base.getField(hops[0])
    for name in hops[1:]:
        column = column.getField(name)
    return column
