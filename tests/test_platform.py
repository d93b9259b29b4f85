"""Sources and sinks, physical plans, streaming, and agreement with DuckDB."""

import io
from contextlib import redirect_stdout
from datetime import date, timedelta

import compare
import pytest
from conftest import at, config, day

import __spark_entry__ as spark_entry
from loginwatch import schemas
from loginwatch.operators import correlate
from loginwatch.operators.normalize import failures, login_events, since_day
from loginwatch.plans import report
from loginwatch.plans.hunt import demo_hunt, stored_hunt
from loginwatch.plans.queries import REPORT_SECTIONS, registered
from loginwatch.sources import reference
from loginwatch.sources import tables as store
from loginwatch.streaming import correlate as stream

SMALL = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_agrees_with_duckdb(spark, con, name):
    assert compare.compare(spark, con, SMALL, name) is None


def test_registry_is_complete():
    queries, oracle = spark_entry.queries(), spark_entry.oracle_sql()
    assert set(oracle) <= set(queries)
    assert not set(registered()) - set(oracle)
    assert {f"report_{s}" for s in REPORT_SECTIONS} <= set(queries)


UNSTORED = [n for n in registered() if not n.startswith("stream_")]


@pytest.mark.parametrize("name", [n for n in UNSTORED if n not in {"risk_band", "signal_summary"}])
def test_no_query_pairs_everything_with_everything(spark, name):
    plan = plan_of(registered()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_day_bound_and_columns_reach_the_scan(spark, tmp_path, tables):
    path = str(tmp_path / "log")
    store.write_login_log(
        tables.attempts([(i, "u", day(i), "US", 1, "1.1.1.1") for i in range(-5, 5)]), path
    )
    log = store.read_login_log(spark, path)
    assert log.count() == 10
    plan = plan_of(since_day(login_events(log), config().detection_start).select("username"))
    assert "PartitionFilters: [isnotnull(login_date" in plan and "ReadSchema: struct<username:string>" in plan


def test_demo_filters_reach_the_parquet_scan(spark):
    hunt = demo_hunt(spark, SMALL)
    plan = plan_of(since_day(hunt.events, hunt.cfg.detection_start).select("username"))
    assert "GreaterThanOrEqual(ts,2024-01-16T00:00)" in plan and "value" not in plan.split("ReadSchema")[1][:80]


def test_stored_tables_and_sinks(spark, tmp_path):
    demo, home = demo_hunt(spark, SMALL), str(tmp_path / "hunt")
    for name, frame in {
        "employees": demo.employees, "machines": demo.machines, "machines_backup": demo.machines_backup,
        "ip_enrichment": demo.table("ip_enrichment"), "country_distance": demo.country_distance,
        "travel_exceptions": demo.travel_exceptions, "ground_truth": demo.labels,
        "ground_truth_assets": demo.asset_labels,
        "hunt_config": reference.hunt_config_table(spark, {
            "baseline_end": "2024-01-16", "detection_start": "2024-01-16", "bf_min_failures": "2",
            "bf_window_minutes": "1440", "spray_min_accounts": "3", "bf_failed_min_failures": "2",
        }),
    }.items():
        frame.write.parquet(f"{home}/{name}")
    store.write_login_log(demo.attempts, f"{home}/log_in_attempts")
    hunt = stored_hunt(spark, home)
    queue = hunt.queue()
    assert queue.count() == demo.queue().count()
    store.write_findings(queue, f"{home}/queue")
    assert spark.read.parquet(f"{home}/queue").where("severity = 'HIGH'").count() > 0
    report.write_report(demo, f"{home}/report")
    assert spark.read.parquet(f"{home}/report/password_spray").count() == demo.password_spray().count()
    shown = report.in_display_order(demo, "critical_patch").limit(2).collect()
    assert shown[0]["days_since_patch"] >= shown[1]["days_since_patch"]
    store.write_json(queue.limit(3), f"{home}/json")
    assert spark.read.json(f"{home}/json").count() == 3


def test_distance_csv(spark, tmp_path):
    (tmp_path / "km.csv").write_text("country_a,country_b,distance_km\nDE,US,7800\n")
    frame = store.read_distance_csv(spark, str(tmp_path / "km.csv"))
    assert frame.dtypes[2] == ("distance_km", "bigint") and frame.first()["distance_km"] == 7800
    for fmt in ("parquet", "orc", "json", "csv"):
        path = str(tmp_path / fmt)
        frame.write.format(fmt).option("header", True).save(path)
        schema = schemas.COUNTRY_DISTANCE if fmt in ("csv", "json") else "country_a STRING, country_b STRING, distance_km BIGINT"
        assert store.read_table(spark, path, schema, fmt).first()["country_b"] == "US"


def test_stream_drops_late_events_and_counts_like_the_batch(spark, tmp_path, tables):
    inbox = str(tmp_path / "inbox")

    def deliver(rows):
        tables.attempts(rows).coalesce(1).write.mode("append").parquet(inbox)

    base = day(1, "10:00:00")
    on_time = [(i, f"u{i}", at(base, i * 60), "US", 0, "1.1.1.1") for i in range(5)]
    later = [(50, "u9", at(base, 4 * 3600), "US", 0, "2.2.2.2")]
    deliver(on_time + later)

    def run():
        raw = spark.readStream.schema(schemas.LOG_IN_ATTEMPTS).parquet(inbox)
        base_events = stream.with_lateness(failures(login_events(raw)))
        counted = stream.hopping_value_count(base_events, gte=2)
        query = (
            counted.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return spark.read.schema(counted.schema).parquet(str(tmp_path / "out"))

    first = {tuple(r) for r in run().collect()}
    want = {tuple(r) for r in stream.hopping_value_count(failures(tables.events(on_time)), gte=2).collect()}
    assert first == want and {r[3] for r in first} == {5}
    deliver([(60 + i, f"w{i}", at(base, 30 + i), "US", 0, "3.3.3.3") for i in range(4)])  # beyond the watermark
    assert {tuple(r) for r in run().collect()} == first
    merged = correlate.merge_windows(run(), "source_ip", "value_count").collect()
    assert len(merged) == 1 and merged[0]["windows"] == 3


def _rolling(spark, inbox, home, gte=5):
    raw = spark.readStream.schema(schemas.LOG_IN_ATTEMPTS).parquet(inbox)
    found = stream.rolling_event_count(spark, stream.with_lateness(failures(login_events(raw))), gte=gte, home=home)
    return sorted(tuple(r) for r in found.collect())


def test_rolling_stream_finds_bursts_at_every_offset_of_the_hour(spark, tmp_path, tables):
    """Five failures over 59 minutes, one account per offset: every one is found."""
    rows = [
        (100 * k + i, f"u{k}", at(day(1, "08:00:00"), 300 * k + i * 885), "US", 0, "1.1.1.1")
        for k in range(13) for i in range(5)
    ]
    tables.attempts(rows + [(9999, "late", day(2), "US", 0, "x")]).coalesce(1).write.parquet(str(tmp_path / "in"))
    got = _rolling(spark, str(tmp_path / "in"), str(tmp_path / "home"))
    assert [r[0] for r in got] == sorted(f"u{k}" for k in range(13)) and {r[2] for r in got} == {5}


def test_rolling_stream_goes_on_in_the_same_folder(spark, tmp_path, tables):
    inbox, home = str(tmp_path / "in"), str(tmp_path / "home")
    rows = [(i, f"u{i % 2}", at(day(1, "08:00:00"), i * 240), "US", 0, "1.1.1.1") for i in range(60)]
    rows += [(100 + i, "u1", at(day(1, "09:00:00"), i // 2), "US", 0, "1.1.1.1") for i in range(9)]
    rows.sort(key=lambda r: r[2])
    for start in range(0, len(rows), 23):
        tables.attempts(rows[start: start + 23]).coalesce(1).write.mode("append").parquet(inbox)
        _rolling(spark, inbox, home, 8)
    tables.attempts([(9999, "late", day(2), "US", 0, "x")]).coalesce(1).write.mode("append").parquet(inbox)
    got = _rolling(spark, inbox, home, 8)
    want = correlate.correlate_event_count(failures(tables.events(rows)), gte=8)
    assert got == sorted(tuple(r) for r in want.collect()) and len(got) > 20
    assert _rolling(spark, inbox, home, 8) == got


def log_scans(frame) -> int:
    return plan_of(frame).count("/events.parquet]")


@pytest.mark.parametrize("name, most", [("triage_queue", 1), ("rule_scores", 1), ("findings_by_user", 1), ("dataset_summary", 2)])
def test_rules_start_from_two_stored_folds(spark, name, most):
    """Beside the two reads that make the folds, the log is read for inactive accounts (and
    for the number of events in the summary)."""
    assert log_scans(registered()[name](spark, SMALL)) <= most


def test_scores_and_hand_off_name_nobody(spark):
    """Counts need no display columns, so no directory is joined below them."""
    assert log_scans(registered()["assemble_incidents"](spark, SMALL)) == 0


def test_history_goes_forward_without_the_old_days(spark, tmp_path):
    from dataclasses import replace

    from loginwatch.operators import history as old

    hunt, path = demo_hunt(spark, SMALL), str(tmp_path / "history")
    days = [hunt.cfg.detection_start - timedelta(days=n) for n in (9, 4, 0)]
    for d in days:
        step = old.update_history(hunt.events, replace(hunt.cfg, detection_start=d, baseline_end=d), path)
        assert "events.parquet" not in plan_of(step)
    with pytest.raises(ValueError, match="update it"):
        replaced = replace(hunt.cfg, detection_start=date(2033, 1, 1))
        type(hunt)(hunt._tables, replaced).with_history(path)
    ready = hunt.with_history(path)
    whole = {tuple(map(str, r)) for r in old.account_history(hunt.events, hunt.cfg).collect()}
    assert {tuple(map(str, r)) for r in ready.history.collect()} == whole
    plan = plan_of(ready.history)
    assert "events.parquet" not in plan
    again = plan_of(old.update_history(hunt.events, hunt.cfg, path))
    assert "events.parquet" not in again


def test_every_signal_has_both_outcomes(spark):
    rows = registered()["incident_signals"](spark, "/root/testdata/sf0.01").collect()
    for c in ("impossible_travel", "mfa_fatigue", "ip_reputation"):
        fired = sum(r[c] > 0 for r in rows)
        assert 10 < fired < len(rows) - 10, c
    bands = registered()["risk_band"](spark, "/root/testdata/sf0.01").groupBy("verdict").count().collect()
    assert len(bands) >= 2


def test_nested_records_as_json_lines(spark, tmp_path):
    records = registered()["handoff_records"](spark, SMALL)
    parsed = spark.read.json(records.select("record").rdd.map(lambda r: r[0]))
    assert parsed.count() == records.count() and {"lab", "risk", "principal"} <= set(parsed.columns)
    store.write_json(parsed, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == parsed.count() and back.select("risk.rationale.score").first()[0]
