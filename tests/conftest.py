import glob
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from compare import SF_DIR  # noqa: E402
from docstrata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "docstrata-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "scratch"),
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture
def json_docs(spark, tmp_path):
    """Documents read from JSON lines, their schema inferred."""
    from docstrata.sources.documents import read_documents

    def read(*lines, **options):
        path = tmp_path / f"docs-{len(list(tmp_path.iterdir()))}.json"
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return read_documents(spark, str(path), **options)

    return read
