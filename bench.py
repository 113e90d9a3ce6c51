"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from certweave.plans import catalog
from certweave.session import local_session

HEADLINES = [
    "clean_text", "parse_date", "conversion_report", "neighbor_backfill", "converted_projection", "check_keys", "reject_record",
    "edges_counts", "nodes_org", "search_certificates", "expand_node", "audit_status", "identity_counters", "status_vocab",
    "programs_dictionary", "scan_placeholders", "sample_per_level", "normalize_names_in_record", "merge_dictionary", "diff_triple",
    "extract_links", "latest_snapshot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries = catalog.all_queries()
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    times = {}
    for key in HEADLINES:
        started = time.perf_counter()
        queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "total_seconds_of_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
