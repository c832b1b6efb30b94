"""Loads of delimited folders that can be repeated: each file once, and a retry replaces its own rows.

Rows of a load lie in a folder of its own (``load_id=...``) below each table. The ledger, one row per file, is written last and says which
loads count, so a load that broke off shows nowhere, and one that runs again under the same id overwrites what it left.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from docstrata.conventions import CATALOG_FILE_NAME
from docstrata.errors import LayoutError
from docstrata.functions.names import base_name, routed_table, visible_name
from docstrata.operators.nulls import empty_to_null
from docstrata.session import scratch_path
from docstrata.sources.delimited import file_headers, read_alike
from docstrata.sources.files import list_files

LOAD = "load_id"
_LEDGER = "path string, table_name string, header string, length bigint, modified timestamp, load_id string"


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """Every file that counts as loaded, with its size and time then, and the load it came with."""
    try:
        return spark.read.schema(_LEDGER).parquet(f"{target.rstrip('/')}/_loads")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


@dataclass(frozen=True)
class Load:
    """What a load did: files taken in, by table, and files that changed since they were loaded, which are left as they were."""

    load_id: str
    files: dict[str, list[str]]
    changed: list[str]


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    listed = list_files(spark, folder, missing_ok=False)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def load_new_files(spark: SparkSession, folder: str, target: str, load_id: str, separator: str = ",", multiline: bool = True) -> Load:
    """Load every delimited file below ``folder`` that no other load has taken in, empty text as null, into tables below ``target``.

    Files route to tables by name, as in ``load_folder``; the list of new files, never rows, comes to the driver. Run again with the
    same ``load_id`` after it ended, it loads the files it loaded then; after it broke off, all that are still new. A
    file whose size or time changed since its load is reported and not loaded again.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load_id):
        raise LayoutError(f"no load id: {load_id!r}")
    root, ledger = target.rstrip("/"), read_ledger(spark, target)
    listed = _listed(spark, folder)
    known = ledger.select("path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"), LOAD)
    met = listed.join(known, "path")
    differs = (F.col("length") != F.col("old_length")) | (F.col("modified") != F.col("old_modified"))
    changed = [r["path"] for r in met.where(differs).select("path").orderBy("path").toLocalIterator()]
    mine = ledger.where(F.col(LOAD) == load_id)
    if mine.isEmpty():
        headers = file_headers(spark, folder, known=ledger).where(base_name(F.col("dataset")) != CATALOG_FILE_NAME)
        new = headers.join(listed, "path")
        rows = new.select("path", routed_table(base_name(F.col("dataset"))).alias("table_name"), "header", "length", "modified", F.lit(load_id).alias(LOAD))
    else:
        rows = mine
    # The ledger's new rows are fixed before any data is written, so both speak of the same files.
    kept = scratch_path(spark, "load-plan")
    rows.write.parquet(kept)
    plan = spark.read.schema(_LEDGER).parquet(kept)
    tables: dict[str, dict[str, list[str]]] = {}
    for row in plan.select("path", "header", "table_name").orderBy("path").toLocalIterator():
        tables.setdefault(row.table_name, {}).setdefault(row.header, []).append(row.path)
    for name, headers in tables.items():
        found = empty_to_null(read_alike(spark, headers, separator, multiline))
        found.write.mode("overwrite").parquet(f"{root}/{visible_name(name)}/{LOAD}={load_id}")
    if tables:
        plan.write.mode("overwrite").parquet(f"{root}/_loads/part={load_id}")
    return Load(load_id, {name: sorted(p for paths in headers.values() for p in paths) for name, headers in tables.items()}, changed)


def loaded_table(spark: SparkSession, target: str, table: str, with_load: bool = False) -> DataFrame:
    """The rows of a table that finished loads have brought, columns by name; ``with_load`` keeps the load's id."""
    root = target.rstrip("/")
    ended = read_ledger(spark, target).where(F.col("table_name") == table).select(LOAD).distinct()
    # One path per load: their columns may differ, and loads that broke off are not even listed.
    paths = [f"{root}/{visible_name(table)}/{LOAD}={row[LOAD]}" for row in ended.orderBy(LOAD).toLocalIterator()]
    if not paths:
        raise LayoutError(f"no finished load of {table!r}")
    rows = spark.read.option("basePath", f"{root}/{visible_name(table)}").option("mergeSchema", True).parquet(*paths)
    rows = rows.withColumn(LOAD, F.col(LOAD).cast("string"))
    return rows if with_load else rows.drop(LOAD)
