"""Listing files as DataFrames: discovery of loadable files, inventories of files and folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docstrata.conventions import CATALOG_FILE_NAME
from docstrata.functions.names import base_name, routed_table
from docstrata.functions.values import listing_time

_LISTING = "path string, modificationTime timestamp, length bigint"


def list_files(spark: SparkSession, folder: str, missing_ok: bool = True) -> DataFrame:
    """Every file below a folder; file contents are not read. With ``missing_ok`` a missing folder lists nothing, else it is an error."""
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(qualified(spark, folder))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or not missing_ok:
            raise
        return spark.createDataFrame([], _LISTING)
    return listing.drop("content").withColumn("path", plain_path(F.col("path")))


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as the file system names it: with scheme, absolute, without ``.`` and ``..`` steps."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


def plain_path(path: Column) -> Column:
    """A path as listed: one slash after ``file:``."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def decoded_path(uri: Column) -> Column:
    """The plain path of an encoded one, as the metadata of a scan gives it; a plus sign stays."""
    return plain_path(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))


def below(root: str, path: Column) -> Column:
    """The part of a plain path below a ``qualified`` folder."""
    prefix = f"file:/{root[5:].strip('/')}/" if root.startswith("file:") else root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(prefix)), F.substring(path, F.lit(len(prefix) + 1), F.length(path)))


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """``FilePath, LastModified, Size`` of every file below a folder."""
    return list_files(spark, folder).select(
        F.col("path").alias("FilePath"),
        listing_time(F.col("modificationTime")).alias("LastModified"),
        F.col("length").alias("Size"),
    )


def file_count(spark: SparkSession, folder: str) -> DataFrame:
    return list_files(spark, folder).agg(F.count("*").alias("FileCount"))


def folder_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the direct sub-folders that hold files at any depth."""
    steps = F.split(below(qualified(spark, folder), F.col("path")), "/")
    return list_files(spark, folder).filter(F.size(steps) > 1).select(F.get(steps, F.lit(0)).alias("Folder")).distinct()


def folder_count(spark: SparkSession, folder: str) -> DataFrame:
    return folder_inventory(spark, folder).agg(F.count("*").alias("FolderCount"))


def dataset_below(root: str, path: Column, suffix: str = ".csv") -> Column:
    """The part of ``path`` below a ``qualified`` folder up to its first step ending in ``suffix``; null if none does.

    A table is a file so named, or a folder so named holding the part files of one distributed write.
    """
    steps = F.split(below(root, path), "/")
    depth = F.array_position(F.transform(steps, lambda step: F.endswith(step, F.lit(suffix))), True).cast("int")
    return F.when(depth > 0, F.array_join(F.slice(steps, F.lit(1), depth), "/"))


def discover_tables(
    spark: SparkSession,
    folder: str,
    target_schema: str | None = None,
    suffix: str = ".csv",
    exclude: Iterable[str] = (CATALOG_FILE_NAME,),
) -> DataFrame:
    """``path, table_name`` of every loadable table below a folder. Names in ``exclude`` are skipped.

    A missing folder is an error: loading nothing must not look like success.
    """
    path, folder = F.col("path"), qualified(spark, folder)
    above = F.left(path, F.length(path) - F.length(below(folder, path)))
    datasets = (
        list_files(spark, folder, missing_ok=False)
        .select(above.alias("above"), dataset_below(folder, path, suffix).alias("dataset"))
        .filter(F.col("dataset").isNotNull())
        .distinct()
    )
    name = base_name(F.col("dataset"))
    return datasets.filter(~name.isin(list(exclude))).select(
        F.concat("above", "dataset").alias("path"), routed_table(name, target_schema).alias("table_name")
    )
