"""Labels, scores, integrity checks and incidents on small fixtures."""

from datetime import date

import pytest
from conftest import at, by, config, day

from loginwatch import HuntConfig, MissingConfigKey
from loginwatch.operators import baselines, brute_force, hunts, incidents, integrity, labels, metrics
from loginwatch.operators import password_spray, triage
from loginwatch.operators.enrich import ThreatFeed
from loginwatch.operators.normalize import login_events
from loginwatch.schemas import COUNTRY_DISTANCE, GROUND_TRUTH, GROUND_TRUTH_ASSETS, HUNT_CONFIG, IP_ENRICHMENT
from loginwatch.schemas import MACHINES, MACHINES_BACKUP
from loginwatch.sources.reference import CENTROIDS, DEFAULT_CONFIG, IP_RANGES


def test_config_reads_and_fails_fast(tables):
    rows = sorted(DEFAULT_CONFIG.items())
    cfg = HuntConfig.from_table(tables.table(rows + [("other", "1")], HUNT_CONFIG))
    assert cfg.bf_window_minutes == 60 and cfg.detection_start == date(2025, 1, 13)
    with pytest.raises(MissingConfigKey, match="hour_tolerance"):
        HuntConfig.from_table(tables.table([r for r in rows if r[0] != "hour_tolerance"], HUNT_CONFIG))


def mark(event_id, bad, name, anchor=0, campaign=None):
    return (event_id, bad, name, anchor, campaign, None)


def test_event_scores(tables):
    found = tables.table(
        [("brute_force", 1), ("brute_force", 1), ("brute_force", 2), ("brute_force", 9), ("after_hours", 1)],
        "rule STRING, event_id BIGINT",
    )
    truth = tables.table([
        mark(1, 1, "brute_force_success", 1), mark(1, 0, "benign"),   # flagged twice: two rows, one anchor
        mark(2, 1, "impossible_travel", 1),                           # incidental catch; travel missed it
        mark(3, 1, "brute_force_success", 1),                         # missed
        mark(4, 1, "brute_force_success", 0),                         # a member, not an anchor
        mark(5, 0, "benign"),
    ], GROUND_TRUTH)
    got = by(metrics.event_metrics(found, truth), "rule")
    assert len(got) == 5                                              # rules without findings are listed
    assert got["brute_force"] == {"rule": "brute_force", "flagged": 4, "tp": 3, "fp": 1, "tp_designed": 1, "fn": 1}
    assert got["after_hours"]["tp"] == 1 and got["after_hours"]["fn"] == 0
    assert got["impossible_travel"] == {
        "rule": "impossible_travel", "flagged": 0, "tp": 0, "fp": 0, "tp_designed": 0, "fn": 1
    }
    errors = {tuple(r) for r in metrics.event_errors(found, truth).collect()}
    assert errors == {("brute_force", "FP", 9), ("brute_force", "FN", 3), ("impossible_travel", "FN", 2)}
    scores = by(metrics.rule_scores(metrics.event_metrics(found, truth)), "rule")
    assert scores["inactive_account"]["precision"] == 1.0 and scores["inactive_account"]["recall"] == 1.0
    assert scores["brute_force"]["precision"] == 0.75 and scores["brute_force"]["recall"] == 0.5
    micro = metrics.micro_average(metrics.rule_scores(metrics.event_metrics(found, truth))).first()
    assert (micro["flagged"], micro["tp"], micro["fn"]) == (5, 4, 2) and micro["precision"] == 0.8


def test_campaign_scores(tables):
    cfg = config(spray_min_accounts=2, bf_failed_min_failures=2)
    rows = []

    def fail(user, ip, d):
        rows.append((len(rows) + 1, user, day(d), "US", 0, ip))
        return len(rows)

    a = [fail(f"u{i}", "1.1.1.1", 1) for i in range(2)]     # campaign s1, covered by two keys
    b = [fail(f"u{i}", "1.1.1.1", 2) for i in range(2)]
    [fail(f"u{i}", "2.2.2.2", 1) for i in range(2)]         # benign spray
    c = [fail("ann", "3.3.3.3", 1) for _ in range(2)]       # guessing campaign g1
    [fail("bob", None, 1) for _ in range(2)]                # unknown source: flagged under no key
    truth = tables.table(
        [mark(i, 1, "password_spray", 0, "s1") for i in (*a, *b)]
        + [mark(i, 1, "brute_force_failed", 0, "g1") for i in c]
        + [mark(99, 1, "password_spray", 0, "s2")], GROUND_TRUTH,
    )
    events, nobody = tables.events(rows), tables.employees([])
    found = {
        "password_spray": password_spray.spray_findings(events, cfg),
        "bruteforce_failed": brute_force.detect_bruteforce_failed(events, nobody, cfg),
    }
    got = by(metrics.campaign_metrics(found, events, truth), "rule")
    assert got["password_spray"] == {
        "rule": "password_spray", "flagged": 3, "tp": 2, "fp": 1, "tp_designed": 1, "fn": 1
    }
    assert got["bruteforce_failed"] == {
        "rule": "bruteforce_failed", "flagged": 2, "tp": 1, "fp": 1, "tp_designed": 1, "fn": 0
    }
    errors = {tuple(r)[:3] for r in metrics.campaign_errors(found, events, truth).collect()}
    assert errors == {
        ("password_spray", "FP", f"2.2.2.2|{day(1)[:10]}"), ("password_spray", "FN", "s2"),
        ("bruteforce_failed", "FP", None),
    }


def test_labels(tables):
    attempts = tables.attempts([(i, "u", day(1), "US", i % 2, "1.1.1.1") for i in range(1, 5)])
    truth = tables.table([mark(1, 1, "x"), mark(1, 1, "y")], GROUND_TRUTH)
    full = labels.complete_labels(attempts, truth)
    assert full.count() == 5 and full.where("anomaly_class = 'benign' AND is_malicious = 0").count() == 3
    campaign = labels.label_campaign(attempts, attempts["success"] == 0, "password_spray", "s1", "n").collect()
    assert {(r["event_id"], r["campaign_id"]) for r in campaign} == {(2, "s1"), (4, "s1")}


@pytest.fixture(scope="module")
def assets(tables):
    staff = tables.employees([
        ("ann", "Sales", "Active"), ("ben", "Sales", "Active"), ("gone", "Sales", "Terminated"),
        ("svc_x", "IT", "Active"),
    ])
    patched = [date(2024, 2, 20), date(2024, 2, 19), date(2023, 11, 22), date(2023, 11, 21)]
    owners = [("d1", "ann"), ("d2", "nobody"), ("d3", None), ("d4", "ann")]
    devices = tables.table([(d, o, "os", p, "pc") for (d, o), p in zip(owners, patched)], MACHINES)
    backup = tables.table([("d1", "ben"), ("d2", "nobody"), ("d9", "ann")], MACHINES_BACKUP)
    return staff, devices, backup


def test_integrity(tables, assets, cfg):
    staff, devices, backup = assets
    assert sorted(r["device_id"] for r in integrity.orphan_devices(devices, staff).collect()) == ["d2", "d3"]
    wrong = integrity.inventory_mismatch(devices, backup, staff)
    assert [(r["device_id"], r["backup_owner_name"]) for r in wrong.collect()] == [("d1", "Firstben Lastben")]
    assert [r["employee_id"] for r in integrity.users_without_devices(staff, devices).collect()] == ["ben"]
    risk = {r["device_id"]: (r["days_since_patch"], r["patch_risk"])
            for r in baselines.patch_status(devices, staff, cfg).collect()}
    assert risk == {"d1": (90, "OK"), "d2": (91, "WARNING"), "d3": (180, "WARNING"), "d4": (181, "CRITICAL")}
    targets = tables.table([("d1", "ann"), ("d4", "ann"), ("d2", "ann"), ("d4", "who")], "device_id STRING, username STRING")
    checks = {(r["device_id"], r["username"]): r["stop"] for r in
              integrity.containment_preflight(targets, devices, backup, staff).collect()}
    assert checks == {("d1", "ann"): True, ("d4", "ann"): False, ("d2", "ann"): True, ("d4", "who"): True}
    travel = tables.table([("ben",)], "username STRING")
    assert integrity.mismatch_live_subjects(wrong, travel).count() == 1
    known = tables.table([("d2", "orphan_device", None), ("d1", "inventory_mismatch", None),
                          ("gone", "user_without_device", None)], GROUND_TRUTH_ASSETS)
    found = metrics.asset_findings(
        integrity.orphan_devices(devices, staff), wrong, integrity.users_without_devices(staff, devices),
        baselines.patch_status(devices, staff, cfg),
    )
    scores = by(metrics.asset_metrics(found, known), "anomaly_class")
    assert scores["orphan_device"]["precision"] == 0.5 and scores["orphan_device"]["recall"] == 1.0
    assert scores["user_without_device"]["recall"] == 0.0 and scores["critical_patch_age"]["recall"] == 1.0


def test_dataset_invariants(tables):
    attempts = tables.attempts([(i, "u", day(1), "US", 1, None) for i in (1, 2, 2, 5)])
    got = {r["check"]: r["value"] for r in integrity.dataset_invariants(
        attempts, tables.table([mark(1, 1, "x"), mark(2, 0, "y")], GROUND_TRUTH),
        tables.table([r for r in sorted(DEFAULT_CONFIG.items()) if r[0] != "asof_date"], HUNT_CONFIG),
        {"pairs": tables.table([("US", "CA", 1), ("CA", "US", 1), ("CA", "US", 1)], COUNTRY_DISTANCE)},
    ).collect()}
    assert got == {
        "non_contiguous_ids": 2, "duplicate_event_ids": 1, "total_events": 4, "malformed_times": 0, "unlabelled_events": 1,
        "malicious_events": 1, "missing_config_keys": 1, "pairs_unordered_pairs": 1, "pairs_duplicate_pairs": 1,
    }


def test_queue_and_incidents(tables, cfg):
    feed = ThreatFeed.load(tables.table(IP_RANGES, IP_ENRICHMENT))
    rows = [(1, "ann", day(-1), "US", 1, "10.0.0.1")]
    rows += [(2 + i, "ann", at(day(1, "03:00:00"), i * 5), "US", 0, "185.220.101.7") for i in range(6)]
    rows += [(10, "ann", day(1, "03:10:00"), "RU", 1, "185.220.101.7"), (11, "ann", day(1, "12:00:00"), "RU", 1, "10.0.0.1"),
             (12, "ben", day(1, "12:00:00"), "US", 1, "95.1.1.1"), (13, "idle", day(1, "12:00:00"), "US", 1, "10.0.0.2")]
    events = tables.events(rows)
    findings = tables.table([
        ("AFTER_HOURS", 10, None, "ann", None, None, day(1, "03:10:00"), "185.220.101.7", "MEDIUM", "T1078", "r"),
        ("BRUTE_FORCE", 10, None, "ann", None, None, day(1, "03:10:00"), "185.220.101.7", "HIGH", "T1110.001", "r"),
        ("UNFAMILIAR_COUNTRY", 10, None, "ann", None, None, day(1, "03:10:00"), "185.220.101.7", "HIGH", "T1078", "r"),
        ("UNFAMILIAR_COUNTRY", 12, None, "ben", None, None, day(1, "12:00:00"), "95.1.1.1", "MEDIUM", "T1078", "r"),
        ("PASSWORD_SPRAY", None, "k", None, None, None, day(1), "1.1.1.1", "HIGH", "T1110.003", "r"),
    ], """detection_type STRING, event_id BIGINT, campaign_key STRING, username STRING, user_name STRING,
          department STRING, timestamp STRING, source_ip STRING, severity STRING, mitre_technique STRING, reason STRING""")
    users = by(incidents.findings_by_user(findings), "username")
    assert sorted(users) == ["ann", "ben"]
    assert users["ann"]["detections"] == ["UNFAMILIAR_COUNTRY", "BRUTE_FORCE", "AFTER_HOURS"]
    assert users["ann"]["techniques"] == ["T1078", "T1110.001"] and users["ann"]["severity"] == "HIGH"
    summary = triage.triage_summary(findings).first()
    assert (summary["total"], summary["high"], summary["medium"], summary["low"]) == (5, 3, 2, 0)
    order = [r["detection_type"] for r in triage.in_queue_order(
        findings.selectExpr("*", "'' AS intel_source")).collect()]
    assert order == ["PASSWORD_SPRAY", "BRUTE_FORCE", "UNFAMILIAR_COUNTRY", "UNFAMILIAR_COUNTRY", "AFTER_HOURS"]

    by_user = incidents.findings_by_user(findings)
    heads = by(incidents.assemble_incidents(events, by_user, cfg, "CASE-", "@corp.test"), "username")
    assert heads["ann"]["incident_id"] == "CASE-ann" and heads["ann"]["principal"] == "ann@corp.test"
    assert heads["ann"]["event_count"] == 8 and heads["ann"]["failure_count"] == 6
    records = incidents.incident_events(events, by_user, cfg, CENTROIDS)
    assert [r["event_id"] for r in records.where("incident_id = 'INC-ann'").orderBy("seq").collect()] == [
        2, 3, 4, 5, 6, 7, 10, 11
    ]
    pages = incidents.incident_pages(records, page_rows=3).where("incident_id = 'INC-ann'").orderBy("page").collect()
    assert [[e["seq"] for e in p["events"]] for p in pages] == [[1, 2, 3], [4, 5, 6], [7, 8]]

    for hot_rows in (0, 10**6):
        signals = incidents.incident_signals(events, by_user, feed, cfg, CENTROIDS, hot_rows=hot_rows)
        risk = by(incidents.risk_band(signals), "username")
        assert [risk["ann"][s] for s in incidents.SIGNALS] == [30.0, 25.0, 20.0, 7.5, 8.8]
        assert risk["ann"]["risk_score"] == 91 and risk["ann"]["verdict"] == "high_risk"
        assert risk["ben"]["risk_score"] == 8 and risk["ben"]["verdict"] == "low_risk"   # 7.5 to even
    text = by(incidents.signal_summary(signals), "username")
    assert text["ann"]["firing_signals"] == (
        "impossible_travel 30; mfa_fatigue 25; ip_reputation 20; login_hour_anomaly 8.8; device_novelty 7.5"
    )
    nested = incidents.handoff_records(
        incidents.assemble_incidents(events, by_user, cfg), incidents.risk_band(signals),
        incidents.signal_summary(signals),
    ).where("username = 'ann'").first()
    assert nested["risk"]["rationale"][0]["signal"] == "impossible_travel" and nested["lab"]["severity"] == "HIGH"


def test_totals_round_half_to_even(tables):
    rows = [("a", 45.0, 0.0, 0.0, 7.5, 0.0), ("b", 30.0, 0.0, 0.0, 7.5, 0.0), ("c", 70.0, 0.0, 0.0, 0.0, 0.4)]
    frame = tables.table(rows, "username STRING, " + ", ".join(f"{s} DOUBLE" for s in incidents.SIGNALS))
    got = by(incidents.risk_band(frame), "username")
    assert [got[u]["risk_score"] for u in "abc"] == [52, 38, 70]
    assert got["c"]["verdict"] == "medium_risk"


def test_hunt_edges(tables):
    from datetime import datetime, timedelta

    asof = datetime(2024, 5, 20)
    rows = [
        (1, "ann", "2024-05-13 00:00:00", "US", 1, "1.1.1.1"),   # exactly seven days ago: outside
        (2, "ann", "2024-05-14 10:00:00", "US", 1, "1.1.1.1"),
        (3, "ann", "2024-05-18 00:00:00", "DE", 1, "1.1.1.1"),   # exactly at the split: detect phase
        (4, "ann", "2024-05-19 13:00:00", "US", 1, "1.1.1.1"),
        (5, "new", "2024-05-19 13:00:00", "KP", 1, "1.1.1.2"),
        (6, "svcold", "2024-05-19 13:00:00", "US", 1, "1.1.1.3"),
    ]
    events = tables.events(rows)
    late = hunts.hunt_after_hours(events, asof)
    assert sorted(r["event_id"] for r in late.collect()) == [3, 4]     # no baseline never fires
    latest = by(hunts.hunt_unfamiliar_country(events, asof), "event_id")
    assert sorted(latest) == [5, 6] and latest[5]["severity"] == "HIGH" and latest[5]["baseline"] == ""
    assert sorted(by(hunts.hunt_unfamiliar_country(events, asof, mode="all"), "event_id")) == [3, 5, 6]
    km = tables.table([("DE", "US", 7800)], COUNTRY_DISTANCE)
    trips = tables.events([
        (1, "a", "2024-05-19 10:00:00", "US", 1, "x"), (2, "a", "2024-05-19 10:00:00", "DE", 1, "x"),
        (3, "a", "2024-05-19 18:40:00", "US", 1, "x"),                 # rounds to exactly 900: not over
    ])
    got = by(hunts.hunt_impossible_travel(trips, km, asof), "event_id")
    assert sorted(got) == [2] and got[2]["required_kmh"] is None
    run = [(i, "a", at("2024-05-18 01:00:00", i * 3600), "US", 0, "x") for i in range(5)]
    run += [(8, "a", "2024-05-19 10:00:00", "US", 1, "y"), (9, "a", "2024-05-19 10:00:00", "US", 0, "z"),
            (10, "a", "2024-05-19 11:00:00", "US", 1, "y")]
    ends = by(hunts.hunt_failures_since_success(tables.events(run), asof), "event_id")
    assert sorted(ends) == [8] and ends[8]["failures_since_success"] == 6
    assert hunts.hunt_failures_since_success(tables.events(run), asof, timedelta(hours=30), 5).count() == 0
    many = tables.events([(i, f"u{i % 50}", "2024-05-19 10:00:00", "US", 0, "s") for i in range(100)])
    assert hunts.hunt_password_spray(many, asof).first()["accounts_targeted"] == 50
    assert hunts.hunt_password_spray_estimate(many, asof).first()["close"]
    pages = hunts.hunt_password_spray(many, asof, page=7).collect()
    names = [n for r in pages for n in r["usernames"].split(",")]
    assert sorted(names) == sorted(f"u{i}" for i in range(50)) and len(pages) > 4 and max(len(r["usernames"].split(",")) for r in pages) < 20


def test_campaigns_of_unknown_sources_are_scored_one_by_one(tables, cfg):
    rows, eid = [], 0
    for d in (1, 2, 3):
        for u in range(6):
            eid += 1
            rows.append((eid, f"u{u}", day(d, f"10:00:{u:02d}"), "US", 0, None))
    events = tables.events(rows)
    found = {
        "password_spray": password_spray.spray_findings(events, cfg),
        "bruteforce_failed": brute_force.detect_bruteforce_failed(events, tables.employees([]), cfg),
    }
    truth = tables.table([mark(i, 1, "password_spray", 0, "s1") for i in range(1, 7)], GROUND_TRUTH)
    got = by(metrics.campaign_metrics(found, events, truth), "rule")["password_spray"]
    assert got == {"rule": "password_spray", "flagged": 3, "tp": 1, "fp": 2, "tp_designed": 1, "fn": 0}
    errors = metrics.campaign_errors(found, events, truth).where("rule = 'password_spray'").collect()
    assert sorted(str(r["login_date"]) for r in errors) == [day(2)[:10], day(3)[:10]]
    same = by(metrics.campaign_findings_counted(found, events, truth), "rule")
    assert same["password_spray"]["findings"] == same["password_spray"]["flagged"] == 3


def test_times_of_day_that_are_none(tables):
    rows = {1: "25:00:00", 2: "09:30", 3: "09:60:00", 4: "9:30:00", 5: "", 6: "23:59:59.5", 7: "12:00:61", 8: "00:00:00"}
    frame = tables.attempts([(i, "u", f"2024-05-11 {t}", "US", 1, "x") for i, t in rows.items()])
    got = {r["event_id"]: (r["ts"], r["login_hour"]) for r in login_events(frame).selectExpr(
        "event_id", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS ts", "login_hour").collect()}
    good = {2: ("2024-05-11 09:30:00", 9), 6: ("2024-05-11 23:59:59", 23), 8: ("2024-05-11 00:00:00", 0)}
    assert got == {i: good.get(i, (None, None)) for i in rows}
