"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from docfold.plans.table_queries import QUERIES
from docfold.session import local_session

HEADLINE = [
    "raw_load_orders",
    "flatten_dim_orders",
    "bridge_order_parts",
    "bridge_page_links",
    "json_by_name_load",
    "upsert_orders",
    "upsert_orders_partial",
    "insert_only_pairs",
    "upsert_bucketed_table",
    "upsert_sliced_table",
    "landed_events",
    "retained_snapshots",
    "page_totals",
    "pk_violations_lineitem",
    "fk_orphan_rows",
    "duplicate_documents",
    "not_null_suite",
    "quality_suite",
    "quality_summary",
    "model_quality",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8, **{"spark.ui.showConsoleProgress": "false"})
    QUERIES[HEADLINE[0]](spark, folder).write.format("noop").mode("overwrite").save()  # starts the session
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    sf = folder.rstrip("/").rsplit("sf", 1)[-1]
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, total time", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
