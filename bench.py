"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores.
Each query runs over its whole tables into the noop sink; the second of two runs counts, so the numbers
show the query and not the start of the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigilake.catalog import registry  # noqa: E402
from vigilake.session import build_session  # noqa: E402

HEADLINE = (
    "entity_daily_activity", "first_seens", "feed_coverage", "identity_events", "iam_changes",
    "query_events", "criteria_builder", "record_match", "count_by_key",
    "multi_rule_one_scan", "claimed_alerts", "deadman_alerts", "rolling_count", "sliding_window_alerts",
    "new_events_anti", "create_then_grant", "correlated_chains", "technique_checks", "score_hunt",
    "normalize_gcp_audit", "normalize_generic",
    "alert_lifecycle", "incident_items",
)
# timed as well; the total stays that of the queries above, so that rounds compare
MORE = ("rule_index", "first_seens_kept", "ordered_sequence", "rolling_count_long", "absence_per_group", "sort_any_whole")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registry()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in (*HEADLINE, *MORE):
        try:
            for _ in range(2):
                begun = time.perf_counter()
                known[name][0](spark, sf).write.format("noop").mode("overwrite").save()
                times[name] = round(time.perf_counter() - begun, 3)
                print(name, times[name], file=sys.stderr, flush=True)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others
            times.pop(name, None)
            failed[name] = str(e).splitlines()[0][:200]
    out = {
        "metric": "headline_queries_total", "value": round(sum(times[n] for n in HEADLINE if n in times), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")),
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
