"""The library's jobs from the command line: ``spark-submit docstrata/__main__.py <job> ...`` or ``python -m docstrata``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from docstrata.conventions import DOCUMENT_KEY
from docstrata.operators.drift import type_conflicts, type_conflicts_with_absence
from docstrata.plans.load import folder_tables, load_folder
from docstrata.plans.table_sets import json_to_tables
from docstrata.session import build_session, settle
from docstrata.sinks.tables import write_delimited, write_drift_report, write_profile
from docstrata.sources.delimited import read_catalogs
from docstrata.sources.documents import read_schema
from docstrata.sources.files import file_inventory, folder_inventory
from docstrata.streaming.ingest import ingest_documents


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="docstrata", description="Nested documents to flat, keyed tables.")
    jobs = parser.add_subparsers(dest="job", required=True)

    flatten = jobs.add_parser("flatten", help="JSON documents to a main table, child tables and a schema catalogue")
    flatten.add_argument("source")
    flatten.add_argument("target")
    flatten.add_argument("name", help="document type; the main table is <name>_main")
    flatten.add_argument("--key", default=DOCUMENT_KEY)
    flatten.add_argument("--format", default="csv")
    flatten.add_argument("--landing", help="folder for the documents as Parquet")
    flatten.add_argument("--multiline", action="store_true")
    flatten.add_argument("--rebalance", action="store_true", help="even out file sizes")
    flatten.add_argument("--schema", help="schema.json of an earlier delivery, instead of inferring one")

    ingest = jobs.add_parser("ingest", help="take in new JSON files, each once, as rows of the table set")
    ingest.add_argument("source")
    ingest.add_argument("target")
    ingest.add_argument("name")
    ingest.add_argument("--schema", required=True, help="schema.json of an earlier delivery")
    ingest.add_argument("--checkpoint", required=True, help="folder that remembers the files taken in")
    ingest.add_argument("--key", default=DOCUMENT_KEY)
    ingest.add_argument("--files-per-batch", type=int)

    load = jobs.add_parser("load", help="a folder of delimited files to warehouse tables")
    load.add_argument("source")
    load.add_argument("--schema", help="target schema of the tables")
    load.add_argument("--mode", default="append")
    load.add_argument("--location", help="folder for the table files")
    load.add_argument("--split-files", action="store_true", help="no value holds a line break; split large files")

    profile = jobs.add_parser("profile", help="profile the delimited tables below a folder")
    profile.add_argument("source")
    profile.add_argument("target")
    profile.add_argument("--loose", action="store_true", help="report text columns holding some numbers as mixed")

    drift = jobs.add_parser("drift", help="type conflicts over a folder of schema catalogues")
    drift.add_argument("source")
    drift.add_argument("target")
    drift.add_argument("--absence", action="store_true", help="count a missing field as a type of its own")

    listing = jobs.add_parser("list", help="inventory of files, or of sub-folders")
    listing.add_argument("source")
    listing.add_argument("target")
    listing.add_argument("--folders", action="store_true")
    return parser


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    options = _parser().parse_args(arguments)
    spark = spark or build_session(f"docstrata-{options.job}")
    if options.job == "flatten":
        schema = read_schema(spark, options.schema) if options.schema else None
        json_to_tables(
            spark, options.source, options.target, options.name, schema, options.key, options.format, options.landing,
            multiline=options.multiline, rebalance=options.rebalance,
        )
    elif options.job == "ingest":
        ingest_documents(
            spark, options.source, read_schema(spark, options.schema), options.target, options.checkpoint, options.name,
            options.key, options.files_per_batch,
        ).awaitTermination()
    elif options.job == "load":
        load_folder(
            spark, options.source, options.schema, options.mode, options.location, multiline=not options.split_files
        )
    elif options.job == "profile":
        write_profile(folder_tables(spark, options.source), options.target, strict=not options.loose)
    elif options.job == "drift":
        catalog = settle(read_catalogs(spark, options.source), "catalogs")
        report = type_conflicts_with_absence(catalog) if options.absence else type_conflicts(catalog)
        write_drift_report(report, options.target)
    else:
        inventory = folder_inventory if options.folders else file_inventory
        write_delimited(inventory(spark, options.source), options.target)


if __name__ == "__main__":
    main()
