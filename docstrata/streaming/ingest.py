"""Incremental ingestion: new JSON files become rows of the table set, each file once.

Extraction works document by document, so the stream needs neither watermark nor state. A micro-batch is
written under its own ``batch=<id>`` folder, which a retry of that batch overwrites; together with the
checkpoint every file counts exactly once however often an attempt fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from docstrata.conventions import DOCUMENT_KEY, RESCUED_COLUMN
from docstrata.functions.names import visible_name
from docstrata.plans.table_sets import flatten_documents
from docstrata.session import scratch_path
from docstrata.sources.documents import land_as_parquet, reject_column, with_rescued

#: The folder of a micro-batch, read back as a column; no field may have this name.
BATCH = "ingest_batch"


def ingest_documents(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    name: str,
    key_col: str = DOCUMENT_KEY,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start a run that takes in all files not seen before and then stops.

    A batch is landed as Parquet in the scratch folder first: its JSON is parsed once, each table then reads its own columns,
    and no batch has to fit into memory. What does not fit the schema goes, as text, to the table ``<name>_rescued``.
    """
    root = target.rstrip("/")
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    documents = with_rescued(reader.text(source), "value", schema, RESCUED_COLUMN)
    for table, rows in flatten_documents(documents, name, key_col, rescued_col=RESCUED_COLUMN).items():
        reject_column(rows, BATCH, f"batch of {table}")

    def write(batch: DataFrame, batch_id: int) -> None:
        landed = land_as_parquet(batch, scratch_path(spark, f"{name}-batch"))
        for table, rows in flatten_documents(landed, name, key_col, stored=True, rescued_col=RESCUED_COLUMN).items():
            rows.write.mode("overwrite").parquet(f"{root}/{visible_name(table)}/{BATCH}={batch_id}")

    return (
        documents.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def ingested_table(spark: SparkSession, target: str, table: str) -> DataFrame:
    """All rows taken in so far for one table."""
    return spark.read.parquet(f"{target.rstrip('/')}/{visible_name(table)}").drop(BATCH)
