"""Documents to their whole set of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from docstrata.conventions import CATALOG_FILE_NAME, DOCUMENT_KEY, ORIGIN_COLUMN, RESCUED, RESCUED_COLUMN, ROOT_KEY
from docstrata.errors import NameClash
from docstrata.functions.schema_walk import top_column
from docstrata.operators.extract import child_tables, main_table
from docstrata.session import scratch_path
from docstrata.sinks.tables import write_catalog, write_schema, write_schema_tree, write_tables
from docstrata.sources.documents import land_as_parquet, read_documents


def flatten_documents(
    df: DataFrame, name: str, key_col: str = DOCUMENT_KEY, origin_col: str | None = None, stored: bool = False,
    rescued_col: str | None = None, primitive_arrays: bool = False,
) -> dict[str, DataFrame]:
    """Main table ``<name>_main`` and every child table, as plans that have not run yet.

    ``rescued_col`` names the column of what did not fit the schema (see ``read_documents``): it gets a table of its own,
    ``<name>_rescued``, and lines that were no document at all are in that table only.
    """
    main, tables = f"{name}_main", {}
    if rescued_col:
        tail = [top_column(origin_col)] if origin_col else []
        lost = df.where(top_column(rescued_col).isNotNull())
        tables[f"{name}_rescued"] = lost.select(top_column(key_col).alias(ROOT_KEY), top_column(rescued_col).alias(RESCUED), *tail)
        df = df.where(top_column(rescued_col).isNull() | top_column(key_col).isNotNull()).drop(rescued_col)
    children = child_tables(df, key_col, origin_col=origin_col, stored=stored, primitive_arrays=primitive_arrays)
    for table in (main, *tables):
        if table in children:
            raise NameClash(table, "table of the documents", "child table")
    return {main: main_table(df), **children, **tables}


def json_to_tables(
    spark: SparkSession,
    source: str,
    target: str,
    name: str,
    schema: T.StructType | None = None,
    key_col: str = DOCUMENT_KEY,
    file_format: str = "csv",
    landing: str | None = None,
    concurrent: int = 3,
    multiline: bool = False,
    rebalance: bool = False,
    origin_col: str = ORIGIN_COLUMN,
    strict: bool = False,
) -> list[str]:
    """JSON files to a schema catalogue, a schema tree and a table set under ``target``.

    The schema is kept there as ``schema.json`` too; given back as ``schema`` for a later delivery it saves
    the scan that infers it, and keeps the tables of arrays that happen to be empty then.

    The documents are first written to Parquet, in ``landing`` or else a scratch folder, so that the JSON
    is parsed once and each table reads only the columns of its own array. ``rebalance`` evens out the size
    of the table files at the cost of a shuffle per table. ``origin_col`` is the column of the source file's name; one that
    the documents have themselves is a ``NameClash``. What does not fit a given schema goes, as text, to the table ``<name>_rescued``;
    with ``strict`` it stops the job instead.
    """
    rescued = None if schema is None or strict else RESCUED_COLUMN
    documents = read_documents(spark, source, schema, multiline, origin_col, rescued_col=rescued, strict=strict)
    described = documents.drop(origin_col, *([rescued] if rescued else []))
    root = target.rstrip("/")
    write_catalog(described, f"{root}/{CATALOG_FILE_NAME}")
    write_schema_tree(described, f"{root}/schema_tree.txt")
    write_schema(described, f"{root}/schema.json")
    landed = land_as_parquet(documents, landing or scratch_path(spark, f"{name}-landing"))
    tables = flatten_documents(landed, name, key_col, origin_col, stored=True, rescued_col=rescued)
    return write_tables(tables, root, file_format, concurrent, rebalance=rebalance)
