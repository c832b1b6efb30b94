"""Headline queries, timed end to end. Prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Every query is run to completion by
a sink that discards rows, so the times include all columns but no collection to the driver.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from docstrata.session import build_session
from docstrata.workload.queries import QUERIES

HEADLINE = (
    "q_child_one_level",
    "q_child_two_levels",
    "q_child_through_struct",
    "q_main_table",
    "q_all_children_counts",
    "q_document_table_set",
    "q_nested_extract",
    "q_labels_v2",
    "q_labels_tables",
    "q_sibling_product",
    "q_primitive_array",
    "q_null_marker",
    "q_profile",
    "q_profile_many",
    "q_type_conflicts",
    "q_type_conflicts_missing",
    "q_json_scan",
    "q_csv_load",
    "q_stream_ingest",
    "q_delimited_by_name",
    "q_rescued",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("docstrata-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="docstrata-bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE

    spark.range(1000).selectExpr("sum(id)").collect()  # start executors and code generation
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
