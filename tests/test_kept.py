"""Tables kept from run to run: daily sketches and the stored queue."""

from __future__ import annotations

import re
from datetime import date, timedelta

import pytest
from conftest import START, day
from pyspark.sql import functions as F

from loginwatch.operators import breadth
from loginwatch.sources.finding_store import finding_day, replace_days, stored_findings

QUEUE = (
    "detection_type string, event_id long, campaign_key string, username string, timestamp string, severity string, "
    "reason string, intel_source string"
)


def finding(number, at, kind="AFTER_HOURS", campaign=None, severity="LOW", intel=None, reason="r"):
    return (kind, number, campaign, "u", at, severity, reason, intel)


def days(*offsets):
    return [START + timedelta(days=o) for o in offsets]


# ---------------------------------------------------------------- daily sketches

def failing(tables, rows):
    return tables.events([(i, u, day(d), "US", s, ip) for i, (d, u, s, ip) in enumerate(rows)])


def test_spans_are_united_from_days(spark, tables, tmp_path):
    events = failing(tables, [
        (0, "a", 0, "1.1.1.1"), (0, "a", 0, "1.1.1.1"), (0, "b", 1, "1.1.1.1"), (1, "a", 0, "1.1.1.1"), (1, "c", 0, "1.1.1.1"),
        (2, None, 0, "1.1.1.1"), (2, "d", 0, None), (3, "e", 0, "1.1.1.1"),
    ])
    path = str(tmp_path / "kept")
    breadth.keep_breadth(events, path, days(0, 1, 2, 3))
    kept = breadth.kept_breadth(spark, path)

    def over(first, last):
        rows = breadth.breadth_over(kept, *days(first, last)).collect()
        return sorted(((r.source_ip, r.days, r.failures, r.accounts) for r in rows), key=str)

    assert over(0, 1) == [("1.1.1.1", 2, 4, 2)]
    assert over(0, 2) == [("1.1.1.1", 3, 5, 2), (None, 1, 1, 1)]
    assert over(3, 9) == [("1.1.1.1", 1, 1, 1)] and over(7, 9) == []
    check = breadth.breadth_check(events, kept, *days(0, 3)).collect()
    assert len(check) == 2 and all(r.within and r.same_failures for r in check)


def test_days_are_sketched_again_and_emptied(spark, tables, tmp_path):
    rows = [(0, "a", 0, "1.1.1.1"), (1, "b", 0, "1.1.1.1"), (2, "c", 0, "1.1.1.1")]
    path = str(tmp_path / "kept")
    breadth.keep_breadth(failing(tables, rows), path, days(0, 1, 2))
    later = failing(tables, [(0, "z", 0, "9.9.9.9"), rows[2], (2, "d", 0, "1.1.1.1")])
    breadth.keep_breadth(later, path, days(1, 2))
    breadth.keep_breadth(later, path, [])
    got = {(r.login_date, r.source_ip): r.failures for r in breadth.kept_breadth(spark, path).collect()}
    assert got == {(START, "1.1.1.1"): 1, (days(2)[0], "1.1.1.1"): 2}


def test_estimates_of_broad_sources(spark, tmp_path):
    rows = spark.range(120_000).selectExpr(
        "0 AS success", "if(id % 3 = 0, NULL, concat('1.1.1.', id % 2)) AS source_ip",
        "concat('u', id % 50000) AS username", "date_add(date'2024-05-10', cast(id % 7 AS int)) AS login_date",
    )
    path = str(tmp_path / "kept")
    breadth.keep_breadth(rows, path, days(*range(7)))
    kept = breadth.kept_breadth(spark, path)
    assert max(r[0] for r in kept.select(F.octet_length("accounts")).collect()) < 20_000
    check = breadth.breadth_check(rows, kept, *days(0, 6)).collect()
    assert len(check) == 3 and all(r.within and r.same_failures and r.accounts > 10_000 for r in check)
    other = breadth.breadth_check(rows, kept.where("source_ip IS NOT NULL"), *days(0, 6)).where("source_ip IS NULL").first()
    assert not other.within


def test_only_named_days_are_read(spark, tables, tmp_path):
    events = tables.events([(1, "a", day(0), "US", 0, "1.1.1.1"), (2, "a", day(5), "US", 0, "1.1.1.1")])
    log = str(tmp_path / "log")
    events.drop("ts", "login_hour").write.partitionBy("login_date").parquet(log)
    plan = breadth.daily_breadth(breadth.on_days(spark.read.parquet(log), days(5)))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*login_date#\d+ = (2024-05-15|\d+)", plan)


# ---------------------------------------------------------------- the stored queue

def kept(spark, path, frame):
    rows = stored_findings(spark, path, frame.schema).collect()
    return sorted((r.detection_day, r.detection_type, r.event_id or 0, r.campaign_key or "", r.reason) for r in rows)


def test_a_day_run_again_replaces_that_day_alone(spark, tmp_path):
    path = str(tmp_path / "findings")
    first = spark.createDataFrame([
        finding(1, day(0)), finding(2, day(0)), finding(3, day(1)),
        finding(None, f"{START} 10:00:00", "PASSWORD_SPRAY", f"9.9.9.9|{START}"),
    ], QUEUE)
    replace_days(first, path, days(0, 1, 2))
    once = kept(spark, path, first)
    assert len(once) == 4
    replace_days(first, path, days(0, 1, 2))
    assert kept(spark, path, first) == once
    # A new run over the window knows other findings; only the day named is taken from it.
    second = spark.createDataFrame([finding(2, day(0), reason="new"), finding(4, day(1))], QUEUE)
    replace_days(second, path, days(0))
    assert [r[2:] for r in kept(spark, path, first)] == [(2, "", "new"), (3, "", "r")]
    replace_days(second, path, days(1))
    assert [r[2] for r in kept(spark, path, first)] == [2, 4]


def test_a_day_that_finds_nothing_is_emptied(spark, tmp_path):
    path = str(tmp_path / "findings")
    frame = spark.createDataFrame([finding(1, day(0)), finding(2, day(1))], QUEUE)
    replace_days(frame, path, days(0, 1))
    replace_days(frame.where("false"), path, days(0))
    replace_days(frame, path, [])
    assert [r[2] for r in kept(spark, path, frame)] == [2]


def test_repeated_rows_and_feed_entries(spark, tmp_path):
    path = str(tmp_path / "findings")
    frame = spark.createDataFrame([
        finding(1, day(0), intel="x"), finding(1, day(0), intel="x"), finding(1, day(0), intel="y"), finding(1, day(0), "IMPOSSIBLE_TRAVEL"),
    ], QUEUE)
    replace_days(frame, path, days(0))
    rows = stored_findings(spark, path, frame.schema).collect()
    assert sorted((r.detection_type, r.intel_source or "") for r in rows) == [
        ("AFTER_HOURS", "x"), ("AFTER_HOURS", "y"), ("IMPOSSIBLE_TRAVEL", "")]
    assert len({r.finding_id for r in rows}) == 2
    assert {r.finding_id for r in finding_day(frame).collect()} == {r.finding_id for r in rows}


def test_a_finding_without_a_day_is_refused(spark, tmp_path):
    frame = spark.createDataFrame([finding(1, None)], QUEUE)
    with pytest.raises(Exception, match="finding without a day"):
        replace_days(frame, str(tmp_path / "findings"), [date(2024, 5, 10)])


def test_a_bound_on_the_day_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "findings")
    frame = spark.createDataFrame([finding(1, day(0)), finding(2, day(1))], QUEUE)
    replace_days(frame, path, days(0, 1))
    found = stored_findings(spark, path, frame.schema).where(f"detection_day = date'{START}'")
    assert [r.event_id for r in found.collect()] == [1] and len(found.inputFiles()) <= 3
    assert "PartitionFilters: [isnotnull(detection_day" in found._jdf.queryExecution().executedPlan().toString()
