"""Schemas that grow with deliveries: what did not fit is looked at, the schema widened, and the kept texts read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from docstrata.functions.schema_walk import top_column
from docstrata.functions.shapes import merged_type, settled, shape_type
from docstrata.operators.file_catalogs import shapes_of
from docstrata.sources.documents import with_rescued


def widened_schema(schema: T.StructType, texts: DataFrame, value: str) -> T.StructType:
    """The least schema that holds ``schema`` and every JSON object among the texts.

    One row, the merged shape, comes to the driver. Texts that are no single object widen nothing and stay rescued.
    """
    row = shapes_of(texts, value).first()
    if row is None or row["shape"] is None:
        return schema
    return settled(merged_type(schema, shape_type(row["shape"])))


def replayed(rescued: DataFrame, value: str, schema: T.StructType, rescued_col: str) -> DataFrame:
    """The rescued texts read with a wider schema, each once; what still does not fit keeps its text in ``rescued_col``.

    Other columns of ``rescued`` follow the document's. A widened schema (see ``widened_schema``) leaves only texts that are no single object.
    """
    texts = rescued.where(top_column(value).isNotNull())
    found = with_rescued(texts, value, schema, rescued_col)
    return found


def conformed(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """Documents of an earlier schema in a wider one: fields that they lack are null, values of changed types are carried over as JSON.

    Columns that kept their type are taken as they are.
    """
    changed = [f for f in schema.fields if f.name in docs.columns and docs.schema[f.name].dataType != f.dataType]
    if not changed:
        return docs.select(*[top_column(f.name) if f.name in docs.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    again = T.StructType(changed)
    wide = docs.withColumn("__wide", F.from_json(F.to_json(F.struct(*[top_column(f.name) for f in changed])), again))
    names = {f.name for f in changed}
    return wide.select(*[
        F.col("__wide").getField(f.name).alias(f.name) if f.name in names
        else top_column(f.name) if f.name in docs.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
