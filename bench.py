"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the cores. Each
query is planned and run whole into the ``noop`` sink, twice; ``queries`` has the second
run, ``first_run`` the first, which includes class loading and code generation.
"""

from __future__ import annotations

import json
import os
import time

from loginwatch.plans.queries import registered
from loginwatch.plans.session import local_session

HEADLINE = [
    "login_events", "ip_enrichment", "classify_source", "user_country_baseline_display",
    "hour_windows", "patch_status", "detect_unfamiliar_country", "travel_transitions",
    "detect_impossible_travel", "detect_after_hours", "detect_brute_force", "detect_password_spray",
    "detect_bruteforce_failed", "detect_inactive_account", "triage_queue", "inventory_mismatch",
    "users_without_devices", "hunt_impossible_travel", "hunt_failures_since_success",
    "correlate_event_count", "correlate_value_count", "stream_event_count", "rule_scores",
    "findings_by_user", "incident_events", "incident_signals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "loginwatch-bench")
    queries = registered()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    first = {name: run(name) for name in HEADLINE}
    second = {name: run(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_wall", "value": round(sum(second.values()), 3), "unit": "sec",
        "queries": second, "first_run": first,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
