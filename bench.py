"""Time the headline queries and print one JSON line.

Every query is run to its last row and column into Spark's discard sink. Each
is timed on its best of ``BENCH_RUNS`` runs after one run that warms the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rowferry.checks.registry import all_queries  # noqa: E402
from rowferry.session import build_session  # noqa: E402
from rowferry.sinks.files import discard  # noqa: E402

HEADLINE = [
    "src_ndjson_lines",
    "src_kafka_envelope",
    "src_new_files",
    "pages_explode",
    "fmt_json_parse",
    "fmt_to_ndjson",
    "fmt_custom_parser",
    "schema_validate",
    "schema_infer",
    "schema_drift_rows",
    "events_end_to_end",
    "stream_end_to_end",
    "dlq_partitions",
    "dlq_replay",
    "map_cast",
    "chain_map_filter_mask",
    "mask_documents",
    "enc_roundtrip",
    "udf_row",
    "idempotency_key",
    "pull_keyset",
    "pull_page_numbers",
    "cdc_latest",
    "cdc_apply",
    "merge_upsert",
    "merge_few_changes",
    "dedup_replay",
    "sink_hive_partitions",
    "sink_stage_parquet",
    "compact_rows",
    "fanout_counts",
    "bulk_chunks",
    "bulk_payload_items",
    "pre_aggregate",
    "offset_cursor",
    "alert_rows",
    "status_list",
    "usage_metering",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "rowferry-bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, times = all_queries(), {}
    for name in HEADLINE:
        best = float("inf")
        for attempt in range(runs + 1):
            started = time.perf_counter()
            discard(known[name](spark, sf))
            if attempt:
                best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
