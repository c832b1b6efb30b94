"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    app_name: str = "docstrata", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with case-sensitive names (JSON may hold both ``a`` and ``A``), UTC and AQE.

    Nothing here sizes the cluster: shuffle partitions, executor memory and split size are left to
    the deployment unless given in ``conf``.
    """
    settings = {
        "spark.sql.caseSensitive": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="docstrata-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    That folder is shared by all executors, so what is written there survives the loss of any of them. A cluster without the
    setting is an error. Only a local session, where driver and executors are one process, falls back to a folder of its own, one
    for the process and removed when it ends.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        base = _own_folder().name
    return f"{base.rstrip('/')}/docstrata/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the scratch folder and go on from the written table.

    What follows may read it often, and neither recomputes it nor depends on any executor still being
    there.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Remove tables that ``settle`` wrote and that no later job reads, so that a job of many rounds does not fill its scratch folder."""
    for table in tables:
        files = table.inputFiles()
        folder = files[0].rsplit("/", 1)[0] if files else ""
        if "/docstrata/" in folder:
            jvm = table.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def is_case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
