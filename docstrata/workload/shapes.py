"""Nested documents and catalogues made from the given flat tables.

Every document is built from one row of its table: structs from its columns, arrays from its text. That
keeps the shapes narrow. Grouping child rows under a parent key instead would gather however many rows
that key has in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docstrata.conventions import CATALOG_FILE, DATA_TYPE, FIELD, HIERARCHY
from docstrata.operators.drift import catalog_entries
from docstrata.session import scratch_path, settle

CATALOG_FILES = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_id, header struct<status, price, meta struct<priority, codes array, placed>>, tags array``."""
    meta = F.struct(
        F.col("o_orderpriority").alias("priority"),
        F.split("o_orderpriority", "-").alias("codes"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("placed"),
    )
    header = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), meta.alias("meta"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_id"), header.alias("header"), F.col("o_custkey").alias("customer"),
        F.split("o_orderpriority", " ").alias("tags"),
    )


def line_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_id struct, body struct<shipped, charges array<struct>>, marks array<struct>``.

    ``charges`` lists only the rates that are not zero, so it may be empty.
    """
    base = F.struct(F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("units"))

    def charge(kind: str, rate: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(rate).alias("rate"), base.alias("base"))

    charges = F.filter(F.array(charge("discount", "l_discount"), charge("tax", "l_tax")), lambda c: c["rate"] > 0)
    marks = F.filter(
        F.array(F.struct(F.col("l_returnflag").alias("code")), F.struct(F.col("l_linestatus").alias("code"))),
        lambda m: m["code"] != "N",
    )
    return table(spark, sf_dir, "lineitem").select(
        F.struct(
            F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
        ).alias("_id"),
        F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"), charges.alias("charges")).alias("body"),
        marks.alias("marks"),
    )


LINE_FIELDS = ("text", "n_chars", "words")


def text_docs(spark: SparkSession, sf_dir: str, line_fields: Sequence[str] = LINE_FIELDS) -> DataFrame:
    """``_id, about struct<lang, source>, lines array<struct<text, n_chars, words array<struct<...>>>>``.

    Blank lines have no words. ``line_fields`` leaves out fields a query has no use for, since nothing
    prunes the fields of a computed array.
    """
    def word(w: Column) -> Column:
        mark = F.when(F.endswith(w, F.lit(".")), ".").when(F.endswith(w, F.lit(",")), ",").otherwise("")
        return F.struct(w.alias("word"), F.length(w).alias("size"), mark.alias("mark"))

    def line(text: Column) -> Column:
        fields = {
            "text": lambda: text,
            "n_chars": lambda: F.length(text),
            "words": lambda: F.transform(F.array_remove(F.split(text, " "), ""), word),
        }
        return F.struct(*[fields[name]().alias(name) for name in line_fields])

    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("_id"), F.struct("lang", "source").alias("about"),
        F.transform(F.split("text", "\n"), line).alias("lines"),
    )


def page_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_id struct<$oid>, page struct<url, links array<struct<href, steps array>>, heads array<struct>>``."""
    links = F.transform(
        F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1),
        lambda href: F.struct(href.alias("href"), F.split(href, "/").alias("steps")),
    )
    heads = F.transform(
        F.regexp_extract_all("html", F.lit("<h[1-3]>([^<]*)<"), 1), lambda title: F.struct(title.alias("title"))
    )
    return table(spark, sf_dir, "pages").select(
        F.struct(F.col("page_id").cast("string").alias("$oid")).alias("_id"),
        F.struct(F.col("url"), links.alias("links"), heads.alias("heads")).alias("page"),
    )


def vector_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("_id"), "embedding", "label")


def patchy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with empty and missing texts, and numbers held as text."""
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal").cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey",
        F.when(segment == "BUILDING", "").when(segment != "MACHINERY", segment).alias("segment"),
        F.when(segment != "HOUSEHOLD", balance).otherwise("").alias("balance"),
        F.when(F.col("c_nationkey") < 5, "").otherwise(F.col("c_nationkey").cast("string")).alias("nation_text"),
        F.when(segment == "FURNITURE", "none").otherwise(F.abs("c_acctbal").cast("string")).alias("price_text"),
        F.when(segment == "NO SUCH SEGMENT", "").alias("nothing"),
    )


def event_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue set whose rows come from the events: a type per field, taken from the value seen."""
    events = table(spark, sf_dir, "events")
    value = F.col("value")
    field = F.concat(F.col("event_type"), F.lit(".k"), F.get_json_object("props", "$.k"))
    return events.select(
        field.alias(FIELD), F.col("event_type").alias(HIERARCHY),
        F.when(value < 20, "bigint").when(value < 80, "double").otherwise("string").alias(DATA_TYPE),
        F.concat(F.lit("file_"), F.lpad((F.col("user_id") % CATALOG_FILES).cast("string"), 2, "0")).alias(CATALOG_FILE),
    )


def event_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue set of the events, counted in one pass over them and written to a small table."""
    return settle(catalog_entries(event_catalog(spark, sf_dir)), "event-entries")


def written_json(df: DataFrame, label: str) -> str:
    """The frame as JSON Lines files in a fresh scratch folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("ignoreNullFields", False).json(path)
    return path


def written_json_lists(df: DataFrame, label: str) -> str:
    """The frame as JSON files in a fresh scratch folder, each one list of at most one Arrow batch of rows."""
    path = scratch_path(df.sparkSession, label)

    def as_lists(batches):
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"value": ["[" + ",\n".join(batch["value"]) + "]"]})

    lines = df.select(F.to_json(F.struct("*")).alias("value"))
    lines.mapInPandas(as_lists, "value string").write.option("maxRecordsPerFile", 1).text(path)
    return path
