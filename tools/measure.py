"""Wall time, shuffled bytes and join kinds of every query: ``measure.py [sf_dir] [names...]``.

Prints a Markdown table. Each query runs whole into the ``noop`` sink, after one query
that warms the session up; bytes come from Spark's event log.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from collections import Counter, defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loginwatch.plans.queries import registered  # noqa: E402
from loginwatch.plans.session import local_session  # noqa: E402

JOINS = r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="measure-")
    options = {"enabled": "true", "dir": f"file://{logs}", "compress": "false", "rolling.enabled": "false"}
    os.environ["PYSPARK_SUBMIT_ARGS"] = " ".join(f"--conf spark.eventLog.{k}={v}" for k, v in options.items()) + " pyspark-shell"
    spark = local_session()
    queries = registered()
    names = argv[1:] or list(queries)
    queries[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    walls, kinds = {}, {}
    for name in names:
        spark.sparkContext.setLocalProperty("spark.job.description", name)
        start = time.perf_counter()
        frame = queries[name](spark, sf_dir)
        frame.write.format("noop").mode("overwrite").save()
        walls[name] = time.perf_counter() - start
        kinds[name] = Counter(re.findall(JOINS, frame._jdf.queryExecution().executedPlan().toString()))
    spark.stop()
    stage_of, shuffled = {}, defaultdict(int)
    for line in next(Path(logs).iterdir()).open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            for s in event["Stage IDs"]:
                stage_of[s] = event["Properties"].get("spark.job.description")
        elif event["Event"] == "SparkListenerTaskEnd":
            written = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            shuffled[stage_of.get(event["Stage ID"])] += written
    print("| query | seconds | shuffled MB | joins of the final plan |\n|---|---|---|---|")
    for name in names:
        joins = ", ".join(f"{n} {k}" for k, n in sorted(kinds[name].items())) or "none"
        print(f"| {name} | {walls[name]:.2f} | {shuffled[name] / 1e6:.2f} | {joins} |")
    print(f"\nTotal {sum(walls.values()):.1f} s, {sum(shuffled.values()) / 1e6:.1f} MB shuffled.")


if __name__ == "__main__":
    main(sys.argv[1:])
