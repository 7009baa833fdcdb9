"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) as the
driver sets them. Every row of each result is produced (``noop`` sink).
BENCH_ONLY limits the run to names that contain one of its words.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import QUERIES  # noqa: E402
from tapflow.session import local_session  # noqa: E402

HEADLINE = [
    "q_s4_ingest_days",
    "q_s7_overwrite_partitions",
    "q_a1_purpose_trips",
    "q_a1_order_trips",
    "q_a4_candidate_stops",
    "q_j5_purpose_trips_by_leg",
    "q_j8_join_audit_by",
    "q_j13_within_radius",
    "q_j14_nearest_site",
    "q_a8_anchor_cells",
    "q_a12_od_hourly",
    "q_a17_column_profile",
    "q_a29_describe_numeric",
    "q_w1_with_next_trip",
    "q_w7_round_trip_commuters",
    "q_g1_build_stops",
    "q_g5_anchors",
    "q_e1_monthly_commute_od",
    "q_e2_cell_commute_od",
    "q_e3_dwell_job",
    "q_e4_publish_od",
    "q_e5_quality_report",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY", "").split()
    spark = local_session(cpus, "tapflow-bench")
    # The JVM's first plans pay for class loading; that is not the queries' time.
    QUERIES["q_a1_purpose_trips"](spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        if only and not any(word in name for word in only):
            continue
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
