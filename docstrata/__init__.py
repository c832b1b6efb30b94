"""Nested documents to flat, keyed tables, as Spark plans."""

from docstrata.errors import LayoutError, NameClash
from docstrata.operators.catalog import ancestors, array_fields, schema_catalog, schema_tree
from docstrata.operators.drift import (
    melt_types,
    pivot_types,
    type_conflicts,
    type_conflicts_with_absence,
    types_by_file,
    union_by_name,
)
from docstrata.operators.expand import drop_arrays, expand_structs
from docstrata.operators.extract import child_table, child_tables, main_table, row_counts, tables_as_one
from docstrata.operators.file_catalogs import file_catalogs
from docstrata.operators.labels import flatten_labeled, labeled_tables
from docstrata.operators.nulls import empty_to_null, fill_missing, mark_nulls
from docstrata.operators.profile import profile_columns, profile_reports, profile_tables
from docstrata.plans.incremental import load_new_files, loaded_table
from docstrata.plans.load import load_folder, two_level_rows
from docstrata.plans.schema_growth import conformed, replayed, widened_schema
from docstrata.plans.table_sets import flatten_documents, json_to_tables
from docstrata.session import build_session

__all__ = [
    "LayoutError", "NameClash", "ancestors", "array_fields", "build_session", "child_table", "child_tables", "conformed",
    "drop_arrays", "empty_to_null", "expand_structs", "file_catalogs", "fill_missing", "flatten_documents", "flatten_labeled",
    "json_to_tables", "labeled_tables", "load_folder", "load_new_files", "loaded_table", "main_table", "mark_nulls", "melt_types", "pivot_types",
    "profile_columns", "profile_reports", "profile_tables", "replayed", "row_counts", "schema_catalog", "schema_tree",
    "tables_as_one", "two_level_rows", "type_conflicts", "type_conflicts_with_absence", "types_by_file",
    "union_by_name", "widened_schema",
]
