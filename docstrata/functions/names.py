"""Names derived from paths and file names, as column expressions or plain text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def child_table_name(dotted_path: str) -> str:
    """Table name of an array path: dots become underscores, dashes vanish."""
    return dotted_path.replace(".", "_").replace("-", "")


def object_name(text: Column) -> Column:
    """A name that is safe for files and objects: ``.`` and ``[`` become ``_``, ``]`` vanishes."""
    return F.translate(text, ".[]", "__")


def base_name(path: Column) -> Column:
    """The part after the last slash."""
    return F.substring_index(path, "/", -1)


def table_stem(file_name: Column) -> Column:
    """Lower-case text before the first dot."""
    return F.lower(F.substring_index(file_name, ".", 1))


def routed_table(file_name: Column, target_schema: str | None = None) -> Column:
    """Target table of a file: ``schema.stem``, or only the stem."""
    stem = table_stem(file_name)
    return F.concat(F.lit(f"{target_schema}."), stem) if target_schema else stem


def parent_path(field: Column, top: str) -> Column:
    """Dotted path without its last segment; ``top`` for a single segment."""
    parts = F.split(field, r"\.")
    above = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), ".")
    return F.when(F.contains(field, F.lit(".")), above).otherwise(F.lit(top))


def free_name(taken: Iterable[str], stem: str) -> str:
    """``stem``, lengthened by underscores until no name in ``taken`` equals it in any case."""
    lowered = {name.lower() for name in taken}
    while stem.lower() in lowered:
        stem += "_"
    return stem


def visible_name(table: str) -> str:
    """The file name of a table: listings pass over names that start with an underscore or a dot."""
    return f"t{table}" if table[:1] in ("_", ".") else table
