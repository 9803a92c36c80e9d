"""Time the registered queries: prints one JSON line with seconds per query.

Each query is built and run to the end with its result discarded, after one small
query has started the session. Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_QUERIES,
BENCH_SCRATCH (folder of intermediate tables).
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from starmill.catalog import QUERIES
from starmill.session import local_session

HEADLINE = [
    "pad_parse_date",
    "first_code_in_chain",
    "business_key",
    "read_delimited",
    "dense_keys",
    "append_new_members",
    "lookup_unknown",
    "inner_lookup",
    "heavy_key_join",
    "merge_insert_update",
    "hierarchy_build",
    "role_play",
    "event_movement",
    "event_fact",
    "snapshot_load",
    "snapshot_with_counts",
    "incremental_replay",
    "pk_violations",
    "fk_orphans",
    "mart_by_region",
    "mart_by_group",
    "mart_rollup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cores, "bench", scratch)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["copy_dimension"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
