"""Names, batches and scratch tables shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docstrata.session import settle

__all__ = ["LAST_ID", "bounded_batches", "documents", "doc_order", "free_name", "held_out", "numbered", "settle", "whole_groups", "with_result"]

#: Documents without an id come after all others wherever an order is needed.
LAST_ID = (1 << 63) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(taken: Iterable[str], stem: str) -> str:
    """``stem``, with underscores until it clashes with no column of the caller, in either case."""
    lowered = {name.lower() for name in taken}
    while stem.lower() in lowered:
        stem += "_"
    return stem


#: Rows that a Python task is handed at once, at most. Whole texts are handed over, so this bounds what a worker holds.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Have the session hand at most ``BATCH_ROWS`` rows at once to Python tasks; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def with_result(df: DataFrame, text: str, function, returns: str, stem: str = "found") -> tuple[DataFrame, str]:
    """``df`` with what ``function`` makes of each batch of column ``text`` as a column, and that column's name.

    The function counts as non-deterministic so that no filter or field access runs it a second time.
    """
    bounded_batches(df.sparkSession)
    name = free_name(df.columns, stem)
    if returns.count(" ") and not returns.startswith(("array", "struct")):
        def typed(texts: pd.Series) -> pd.DataFrame:
            return function(texts)
    else:
        def typed(texts: pd.Series) -> pd.Series:
            return function(texts)
    return df.withColumn(name, F.pandas_udf(typed, returns).asNondeterministic()(F.col(f"`{text}`"))), name


def held_out(doc_id: Column) -> Column:
    """The fold that no model sees: a quarter of the ids, by the checksum of the id's text. Null ids are learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def doc_order(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST_ID))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows with a number of their own. Write the result before reading it twice: a second run may number differently."""
    return df.withColumn(name, F.monotonically_increasing_id())


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows that come sorted by ``keys``, each whole, whatever the batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if held and a == 0 and (held[0][keys].iloc[0].to_numpy() != values[0]).any():
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            elif held and a > 0:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(batch.iloc[a:b])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]
