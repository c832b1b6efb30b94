"""Writing tables and reports. Every write is distributed: one file per partition, none through the driver."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F

from docstrata.conventions import NULL_MARKER
from docstrata.errors import NameClash
from docstrata.functions.names import visible_name
from docstrata.functions.schema_walk import top_column
from docstrata.functions.values import NESTED_TYPES, as_text
from docstrata.operators.catalog import schema_catalog, schema_tree_rows
from docstrata.operators.drift import as_delimited_report
from docstrata.operators.nulls import mark_nulls
from docstrata.operators.profile import profile_reports


def _flat(df: DataFrame) -> DataFrame:
    """Maps and other nested values as JSON text; delimited files hold plain values only."""
    if not any(isinstance(f.dataType, NESTED_TYPES) for f in df.schema.fields):
        return df
    return df.select(*[
        as_text(top_column(f.name), f.dataType).alias(f.name) if isinstance(f.dataType, NESTED_TYPES) else top_column(f.name)
        for f in df.schema.fields
    ])


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = "") -> None:
    """A table as delimited files with a header. Null and empty text both show as nothing.

    In a table of one column they show as a quoted nothing, since readers pass over blank lines.
    """
    flat, empty = _flat(df), ""
    if len(flat.columns) == 1:
        empty, column = '""', top_column(flat.columns[0])
        flat = flat.select(F.coalesce(column.cast("string"), F.lit(null_value)).alias(flat.columns[0]))
    (
        flat.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", empty).option("nullValue", null_value).csv(path)
    )


def write_marked(df: DataFrame, path: str, marker: str = NULL_MARKER) -> None:
    """A table as delimited text in which null shows as a marker."""
    write_delimited(mark_nulls(df, marker), path)


def write_tables(
    tables: Mapping[str, DataFrame],
    folder: str,
    file_format: str = "csv",
    concurrent: int = 3,
    skip_empty: bool = False,
    rebalance: bool = False,
) -> list[str]:
    """Each table into ``folder/<name>.<format>``; returns the names written.

    A name that starts with an underscore or dot gets a letter in front, as ``visible_name`` has it: Spark and its file
    listings take such files for hidden ones. Two tables of one file name are a ``NameClash``.

    ``concurrent`` tables are written at a time, so that small tables do not leave a large cluster
    idle. ``rebalance`` adds a shuffle that evens out file sizes, for tables much smaller than the
    documents they come from. ``skip_empty`` leaves out tables without rows, at the cost of a short
    extra job per table.
    """
    files: dict[str, str] = {}
    for name in tables:
        other = files.setdefault(visible_name(name), name)
        if other != name:
            raise NameClash(visible_name(name), other, name)

    def write(item: tuple[str, DataFrame]) -> str | None:
        name, table = visible_name(item[0]), item[1]
        if skip_empty and table.isEmpty():
            return None
        if rebalance:
            table = table.hint("rebalance")
        path = f"{folder.rstrip('/')}/{name}.{file_format}"
        if file_format == "csv":
            write_delimited(table, path)
        else:
            table.write.mode("overwrite").format(file_format).save(path)
        return name

    with ThreadPoolExecutor(max_workers=max(1, concurrent)) as pool:
        return [name for name in pool.map(write, tables.items()) if name]


def save_table(df: DataFrame, name: str, mode: str = "append", location: str | None = None, file_format: str = "parquet") -> None:
    """Add the rows to a catalogue table, created on first use; ``location`` keeps its files elsewhere."""
    writer = df.write.mode(mode).format(file_format)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def save_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict[str, str] | None = None) -> None:
    """Add the rows to a table of an external warehouse."""
    df.write.jdbc(url, table, mode=mode, properties=properties or {})


def write_catalog(df: DataFrame, path: str) -> None:
    """The schema catalogue of ``df`` as a delimited file."""
    write_delimited(schema_catalog(df), path)


def write_schema_tree(df: DataFrame, path: str) -> None:
    """The printed schema tree as a text file."""
    schema_tree_rows(df).coalesce(1).sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)


def write_schema(df: DataFrame, path: str) -> None:
    """The schema as JSON text, for ``read_schema`` to pass to the next delivery."""
    df.sparkSession.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_profile(tables: Mapping[str, DataFrame], path: str, strict: bool = True) -> None:
    """Profile reports of the tables as one JSON list, one row per table and so small enough for one file."""
    reports = profile_reports(tables, strict)
    last = F.lit(len(tables) - 1)
    place = F.array_position(F.array(*[F.lit(name) for name in tables]), F.get_json_object("report", "$.DataFrame_name")) - 1
    text = F.concat(F.when(place == 0, "[").otherwise(""), "report", F.when(place == last, "]").otherwise(","))
    reports.select(place.alias("place"), text.alias("value")).coalesce(1).sortWithinPartitions("place").select("value").write.mode(
        "overwrite"
    ).text(path)


def write_drift_report(conflicts: DataFrame, path: str) -> None:
    write_delimited(as_delimited_report(conflicts), path)
