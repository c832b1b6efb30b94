"""Profiles that grow with deliveries: each delivery is counted once, and its counts are kept.

The state table has a folder per delivery, of a row per table, column and kind of value. A new delivery reads itself only; a retry
under the same id replaces what it wrote before.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from docstrata.errors import LayoutError
from docstrata.operators.profile import merged_profile, profile_state

DELIVERY = "delivery"
_STATE = f"DataFrame_name string, ordinal int, column_name string, data_type string, code int, count bigint, {DELIVERY} string"


def add_delivery(tables: Mapping[str, DataFrame], target: str, delivery: str) -> None:
    """Count the rows of one delivery's tables and keep the counts below ``target``."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", delivery):
        raise LayoutError(f"no delivery id: {delivery!r}")
    profile_state(tables).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{DELIVERY}={delivery}")


def grown_profile(spark: SparkSession, target: str, strict: bool = True) -> DataFrame:
    """The profile of all deliveries kept below ``target``, from their counts alone; without any it has no rows."""
    try:
        states = spark.read.schema(_STATE).parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        states = spark.createDataFrame([], _STATE)
    return merged_profile(states, strict)
