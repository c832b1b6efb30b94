"""First lines of many files, without reading the files beyond them.

A scan of lines has to read a file to its end, whatever is kept of it. Here the files are listed by Spark, with no content, and the tasks
that hold the listing open each file and read blocks of ``BLOCK`` bytes up to the first line break.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docstrata.sources.files import decoded_path, list_files, qualified

#: Bytes read at once. A header longer than that takes further blocks.
BLOCK = 1 << 16
#: Endings of compressed files that only Spark's own readers open.
SPARK_ONLY = (".deflate", ".snappy", ".lz4")


def first_line(stream) -> str | None:
    """The text before the first line break of a binary stream, which is not read beyond the block it stands in. None if there is nothing."""
    parts = []
    while block := stream.read(BLOCK):
        ends = [at for at in (block.find(b"\n"), block.find(b"\r")) if at >= 0]
        if ends:
            parts.append(block[: min(ends)])
            break
        parts.append(block)
    return b"".join(parts).decode("utf-8", "replace") if parts else None


def _store(root: str):
    """The file system of a ``qualified`` folder, and the folder's path there."""
    from pyarrow import fs

    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[5:].strip("/")
    return fs.FileSystem.from_uri(quote(root, safe=":/@"))


def _lines(root: str):
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(root)
        base = base.rstrip("/")
        above = len(f"file:{base}" if root.startswith("file:") else root.rstrip("/"))
        for batch in batches:
            found = []
            for path in batch["path"]:
                with store.open_input_stream(base + path[above:], compression="detect") as stream:
                    found.append(first_line(stream))
            yield pd.DataFrame({"path": batch["path"].array, "header": found})

    return lines


def _scanned(spark: SparkSession, root: str, names: str | None = None) -> DataFrame:
    """``path, header`` by a scan of all lines, of the files whose names match."""
    reader = spark.read.option("recursiveFileLookup", True)
    scanned = (reader.option("pathGlobFilter", names) if names else reader).text(root)
    source = scanned.metadataColumn("_metadata")
    lines = scanned.select(
        F.col("value"), source.getField("file_path").alias("uri"), source.getField("file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).where("block = 0")
    first = lines.groupBy("uri").agg(F.min_by("value", "line").alias("header"))
    return first.select(decoded_path(F.col("uri")).alias("path"), "header")


def first_lines(spark: SparkSession, folder: str, wanted: Column | None = None, known: DataFrame | None = None) -> DataFrame:
    """``path, header``: every file below a folder that has a line, with its first one.

    Files whose ``path`` is not ``wanted``, or is one of ``known``, are not opened. Stores that only Spark can open, and files compressed in
    a way that only Spark reads, are scanned whole.
    """
    root, path = qualified(spark, folder), F.col("path")
    asked = F.lit(True) if wanted is None else wanted

    def of_interest(files: DataFrame) -> DataFrame:
        files = files.where(asked)
        return files if known is None else files.join(known.select("path"), "path", "left_anti")

    try:
        _store(root)
    except Exception:  # whatever a store's client raises: without one, the scan is the way
        return of_interest(_scanned(spark, root))
    spark_only = reduce(or_, (F.endswith(path, F.lit(ending)) for ending in SPARK_ONLY))
    listed = list_files(spark, folder, missing_ok=False).where((F.col("length") > 0) & ~spark_only).select("path")
    opened = of_interest(listed).mapInPandas(_lines(root), "path string, header string").where("header IS NOT NULL")
    rest = _scanned(spark, root, "*{" + ",".join(SPARK_ONLY) + "}")
    return opened.unionByName(of_interest(rest))
