"""Nested documents from JSON files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docstrata.conventions import ORIGIN_COLUMN
from docstrata.errors import NameClash
from docstrata.functions.names import base_name, free_name
from docstrata.functions.schema_walk import top_column
from docstrata.session import is_case_sensitive
from docstrata.sources.files import decoded_path


def with_origin(scanned: DataFrame, origin_col: str = ORIGIN_COLUMN) -> DataFrame:
    """Add the plain name of the source file to a frame just read from files. A field of that name is a ``NameClash``."""
    reject_column(scanned, origin_col, "source file name")
    uri = scanned.metadataColumn("_metadata").getField("file_path")
    return scanned.withColumn(origin_col, base_name(decoded_path(uri)))


def reject_column(df: DataFrame, name: str, purpose: str) -> None:
    same = (lambda a: a == name) if is_case_sensitive(df.sparkSession) else (lambda a: a.lower() == name.lower())
    if any(same(column) for column in df.columns):
        raise NameClash(name, purpose, "field of the documents")


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    multiline: bool = False,
    origin: bool | str = False,
    rescued_col: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Documents from JSON files, one per line, or one object or list per file with ``multiline``.

    Without ``schema`` the files are scanned once more to infer it, and nothing is lost. With the schema of an earlier
    delivery that scan is saved, and arrays that happen to be empty keep their type, but texts may hold what it
    does not know. ``rescued_col`` names a column for the whole text of a document (a line, or with ``multiline`` an item of a
    file) wherever something of it did not fit: broken text, text after the document, a key that stands twice, a field the schema
    lacks at any depth of objects, lists and maps, or a value of another type. ``strict`` stops the job there instead.
    ``origin`` adds the name of the source file, as ``Filename`` or the name given.
    """
    origin_col = ORIGIN_COLUMN if origin is True else origin
    if schema is not None and (rescued_col or strict):
        texts = spark.read.text(path, wholetext=multiline)
        scanned = with_origin(texts, origin_col) if origin_col else texts
        if multiline:
            scanned = list_items(scanned, "value").drop(ITEM_PLACE)
        return with_rescued(scanned, "value", schema, rescued_col, strict)
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    if strict:
        reader = reader.option("mode", "FAILFAST")
    scanned = reader.json(path)
    return with_origin(scanned, origin_col) if origin_col else scanned


def with_rescued(lines: DataFrame, value: str, schema: T.StructType, rescued_col: str | None, strict: bool = False) -> DataFrame:
    """The documents in a column of JSON texts; beside them the text of each that ``schema`` does not hold entirely.

    A text fits if it parses without a bad value, is one document to its end, names no key twice, and has no key the schema
    lacks. Each text is parsed once more, to VARIANT, for that. ``strict`` stops the job at a text that does not fit.
    """
    if rescued_col in schema.names:
        raise NameClash(rescued_col, "text that did not fit", "field of the documents")
    corrupt = free_name(schema.names, "__broken")
    text = top_column(value)
    other = [top_column(name) for name in lines.columns if name != value]
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = lines.where(F.trim(text) != "").withColumns({
        "__document": F.from_json(text, wide, {"columnNameOfCorruptRecord": corrupt}),
        "__variant": single_document(text),
    })
    document = F.col("__document")
    misfit = document.isNull() | document.getField(corrupt).isNotNull() | F.col("__variant").isNull() | has_unknown_keys(F.col("__variant"), schema)
    fields = [document.getField(name).alias(name) for name in schema.names]
    if strict:
        message = F.concat(F.lit("a document does not fit the given schema: "), F.substring(text, 1, 500))
        # The check stands in the documents themselves, so no projection can lose it.
        checked = parsed.where(F.when(misfit, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        return checked.select(*fields, *other)
    return parsed.select(*fields, *other, F.when(misfit, text).alias(rescued_col))


#: What stands behind a text while it is parsed, so that text after its document shows.
END_MARK = "docstrata: end of the document"


def single_document(text: Column) -> Column:
    """A JSON text as VARIANT; null if it is broken, goes on after its document, or names a key twice."""
    framed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f', "{END_MARK}"]')))
    parts = F.try_variant_get(framed, "$", "array<variant>")
    whole = (F.size(parts) == 2) & (F.try_variant_get(framed, "$[1]", "string") == END_MARK)
    return F.when(whole, F.get(parts, F.lit(0)))


def has_unknown_keys(found: Column, data_type: T.DataType) -> Column:
    """Whether a VARIANT has a key, at any depth of objects, lists and maps, that ``data_type`` lacks."""

    def deep(inner: T.DataType) -> bool:
        if isinstance(inner, T.ArrayType):
            return deep(inner.elementType)
        return deep(inner.valueType) if isinstance(inner, T.MapType) else isinstance(inner, T.StructType)

    if not deep(data_type):
        return F.lit(False)
    if isinstance(data_type, T.ArrayType):
        items = F.try_variant_get(found, "$", "array<variant>")
        return F.coalesce(F.exists(items, lambda item: has_unknown_keys(item, data_type.elementType)), F.lit(False))
    members = F.try_variant_get(found, "$", "map<string,variant>")
    if isinstance(data_type, T.MapType):
        values = F.map_values(members)
        return F.coalesce(F.exists(values, lambda value: has_unknown_keys(value, data_type.valueType)), F.lit(False))
    known = F.array(*[F.lit(name) for name in data_type.names]) if data_type.names else F.array().cast("array<string>")
    unknown = F.size(F.array_except(F.map_keys(members), known)) > 0
    for field in data_type.fields:
        if deep(field.dataType):
            unknown = unknown | has_unknown_keys(F.try_element_at(members, F.lit(field.name)), field.dataType)
    return F.coalesce(unknown, F.lit(False))


#: Where an item stood in its list, as a column of ``list_items``.
ITEM_PLACE = "__item_place"


def list_items(texts: DataFrame, value: str) -> DataFrame:
    """A row for each item of the JSON lists in column ``value``, with its text there and its place from 0 in ``ITEM_PLACE``.

    A single object is a list of one. A text that is neither to its end is one row without a place, its text as it is; an item that
    is null is passed over, as by Spark's own reader.
    """
    text, other = top_column(value), [top_column(name) for name in texts.columns if name != value]
    # Only wholeness is asked of the list here; keys that stand twice are found item by item.
    framed = F.from_json(F.concat(F.lit("["), text, F.lit(f', "{END_MARK}"]')), "array<string>")
    whole = F.coalesce((F.size("__framed") == 2) & (F.get("__framed", F.lit(1)) == END_MARK), F.lit(False))
    listed = F.when(whole & F.trim(text).startswith("["), F.from_json(text, "array<string>"))
    parsed = texts.where(F.trim(text) != "").select(*other, text, framed.alias("__framed")).select(*other, text, listed.alias("__listed"))
    # Each text is parsed once, below the generator: what stands above it is computed again for every item, and an inner one's filter parses anew.
    ready = parsed.select(*other, F.col("__listed").isNotNull().alias("__list"), F.coalesce("__listed", F.array(text)).alias("__items"))
    opened = ready.select(*other, "__list", F.posexplode_outer("__items").alias(ITEM_PLACE, value))
    is_object = F.trim(top_column(value)).startswith("{")
    place = F.when(F.col("__list") | is_object, F.col(ITEM_PLACE))
    return opened.where(top_column(value).isNotNull()).select(*other, place.alias(ITEM_PLACE), top_column(value))


def read_schema(spark: SparkSession, path: str) -> T.StructType:
    """A schema kept by ``write_schema``. Metadata only: one short text."""
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()["value"]))


def read_document_lists(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    position_col: str = "list_position",
    rescued_col: str | None = None,
) -> DataFrame:
    """Items of files that hold one JSON list each, with their place in the list.

    A file is parsed whole by one task, as a list in a file has no other unit; a single object counts
    as a list of one. A file that does not parse stops the job. With ``rescued_col``, such a file is one row without a place whose text is in
    that column, and so is the text of every item that ``schema`` does not hold entirely, beside what it does hold.
    """
    if schema is None:
        schema = spark.read.option("multiLine", True).json(path).schema
    if position_col in schema.names:
        raise NameClash(position_col, "place in the list", "field of the items")
    whole = spark.read.text(path, wholetext=True).where(F.trim("value") != "")
    if rescued_col:
        items = list_items(whole, "value").withColumnRenamed(ITEM_PLACE, position_col)
        found = with_rescued(items, "value", schema, rescued_col)
        return found.select(position_col, *map(top_column, schema.names), rescued_col)
    parsed = whole.withColumn("items", F.from_json("value", T.ArrayType(schema), {"mode": "FAILFAST"}))
    opened = parsed.select(F.posexplode("items").alias(position_col, "document"))
    return opened.select(position_col, *[F.col("document").getField(name).alias(name) for name in schema.names])


def parse_json_column(df: DataFrame, column: str, schema: T.StructType | str, into: str | None = None) -> DataFrame:
    """Replace (or add) a column by the parsed JSON text of ``column``."""
    return df.withColumn(into or column, F.from_json(F.col(column), schema))


def land_as_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write documents to Parquet and read them back from there.

    JSON is parsed in full for every table taken from it, and documents computed in the plan, such as
    parsed text columns, even twice: once to skip empty arrays, once to open them. From Parquet each table
    reads only its own array's columns, so many tables off one delivery start from here.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
