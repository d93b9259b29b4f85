"""Registered queries: every operator over the whole demo tables of a scale factor."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loginwatch.config import HuntConfig
from loginwatch.operators import baselines, breadth, brute_force, correlate, geography, hunts, impossible_travel
from loginwatch.operators import incidents, inactive_account, integrity, labels, metrics
from loginwatch.operators import password_spray, triage
from loginwatch.operators.enrich import ThreatFeed, account_status, classify_source, ip_enrichment
from loginwatch.operators.history import account_history, merge_history, update_history
from loginwatch.operators.membership import Membership
from loginwatch.operators.normalize import failures, login_events
from loginwatch.plans.hunt import Hunt, demo_hunt
from loginwatch.plans.report import detection_report
from loginwatch.plans.session import shared_dir, stored, use_utc
from loginwatch.sources import demo, reference
from loginwatch.sources.account_log import AccountLog, read_account_log, write_account_log
from loginwatch.sources.finding_store import replace_days, stored_findings
from loginwatch.sources.tables import read_distance_csv
from loginwatch.streaming import correlate as stream
from loginwatch.streaming import early

ASOF = datetime(2024, 1, 31)
LOOKBACK = timedelta(days=30)
SPLIT_AGE = timedelta(days=15)
BREADTH_SPAN = timedelta(days=6)

# Thresholds for the hunts and correlations, loosened to the sparse demo log.
HUNT_RUN = 3
HUNT_FAILED = 2
HUNT_ACCOUNTS = 3
BURST = 2

# Gates of the risk signals, and the part of the feed they use, such that each fires for some accounts.
SIGNAL_WEIGHTS = incidents.SignalWeights(travel_kmh=10_000.0, burst_window=timedelta(hours=6), burst_failures=2)
SIGNAL_FEED = "source LIKE 'demo-%'"
RECORDS_PER_PAGE = 20
ACCOUNT_BUCKETS = 16
BUSY_ROWS = 70  # low, so that the demo log has both kinds of accounts
QUEUE_HEAD = 100
ACCOUNT = "U000003"

REPORT_SECTIONS = [
    "triage_queue", "unfamiliar_country", "impossible_travel", "after_hours", "brute_force",
    "password_spray", "bruteforce_failed", "inactive_account", "orphan_devices",
    "inventory_mismatch", "users_without_devices", "critical_patch",
]

Query = Callable[[Hunt, SparkSession, str], DataFrame]


def as_text(frame: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, lists as comma text: comparable anywhere."""
    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.array_join(f.name, ",").alias(f.name)
        return F.col(f.name)

    return frame.select(*[plain(f) for f in frame.schema.fields])


def _stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demo log as a stream over the same file."""
    raw = spark.readStream.schema(demo.EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return login_events(demo.attempts_from(raw))


def _stream_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.with_lateness(failures(_stream_events(spark, sf_dir)))


def _closed(spark: SparkSession, sf_dir: str, alerts: DataFrame) -> DataFrame:
    """Alerts at instants that the stream's watermark has passed at its end."""
    newest = failures(login_events(demo.log_in_attempts(spark, sf_dir))).agg(F.max("ts")).scalar()
    closed = newest - F.expr(f"INTERVAL {stream.LATENESS // timedelta(seconds=1)} SECOND")
    return alerts.where(F.col("ts") + F.expr("INTERVAL 1 SECOND") <= closed)


def _signals(h: Hunt) -> DataFrame:
    feed = ThreatFeed.load(h.table("ip_enrichment").where(SIGNAL_FEED))
    return incidents.incident_signals(
        h.prepared.recent, h.by_user.select("username"), feed, h.cfg, reference.CENTROIDS, SIGNAL_WEIGHTS,
        hot=h.prepared.hot,
    )


def _incident_events(h: Hunt) -> DataFrame:
    return incidents.incident_events(
        h.prepared.recent, h.by_user.select("username"), h.cfg, reference.CENTROIDS, hot=h.prepared.hot
    )


def _prefilter(h: Hunt) -> DataFrame:
    """How many accounts of the window are flagged, and whether those let through besides
    are about as few as the bit table promises."""
    seen = h.window_events.where("username IS NOT NULL")
    parts = [seen, h.flagged.thin(seen), h.flagged.only(seen)]
    every, passed, exact = (p.groupBy("username").agg(F.count(F.lit(1)).alias("n"), F.lit(i).alias("part")) for i, p in enumerate(parts))
    return every.unionByName(passed).unionByName(exact).selectExpr(
        "count_if(part = 0) AS accounts", "coalesce(sum(n) FILTER (WHERE part = 0), 0L) AS attempts",
        "count_if(part = 1) AS passed", "count_if(part = 2) AS flagged",
        "coalesce(sum(n) FILTER (WHERE part = 2), 0L) AS flagged_rows",
    ).selectExpr(
        "accounts", "attempts", "flagged", "flagged_rows",
        f"passed - flagged <= 3 + 3 * {h.flagged.share!r}D * (accounts - flagged) AS within_share",
    )


def _incident_pages(h: Hunt) -> DataFrame:
    """Nested records as JSON text, a page per row."""
    records = _incident_events(h).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    pages = incidents.incident_pages(records, RECORDS_PER_PAGE)
    return pages.select("incident_id", "page", F.to_json("events", {"ignoreNullFields": "false"}).alias("events"))


def _handoff(h: Hunt) -> DataFrame:
    """The nested hand-off record of each account as JSON text."""
    headers = incidents.assemble_incidents(h.prepared.recent, h.by_user, h.cfg, hot=h.prepared.hot).withColumn(
        "created_time", F.date_format("created_time", "yyyy-MM-dd HH:mm:ss")
    )
    signals = stored(_signals(h), "signals")
    records = incidents.handoff_records(headers, incidents.risk_band(signals), incidents.signal_summary(signals))
    return records.select("username", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def _merged_history(h: Hunt) -> DataFrame:
    """The history folded in two slices of days and merged, as nightly runs do."""
    cut = ASOF.date() - timedelta(days=20)
    parts = [account_history(h.events.where(c), h.cfg) for c in (f"login_date < date'{cut}'", f"login_date >= date'{cut}'")]
    return _history_columns(merge_history(*parts))


def _history_columns(history: DataFrame) -> DataFrame:
    return history.select(
        "username", "country", "first_ts", "baseline_logins", "min_hour", "max_hour",
        F.col("last_success.event_id").alias("last_event_id"),
    )


def _nightly(h: Hunt, spark: SparkSession) -> DataFrame:
    """The queue over a history kept in a folder, brought forward in two steps."""
    path = shared_dir(spark, "kept_history")
    start = h.cfg.detection_start - timedelta(days=5)
    update_history(h.events, replace(h.cfg, detection_start=start, baseline_end=min(start, h.cfg.baseline_end)), path)
    h.update_history(path)
    return h.with_history(path).queue()


def _late_days(h: Hunt, spark: SparkSession) -> DataFrame:
    """The kept history after half of the events of all days came in late."""
    path = shared_dir(spark, "late_history")
    update_history(h.events.where("event_id % 2 = 0"), h.cfg, path)
    return _history_columns(h.update_history(path))


def _kept_breadth(h: Hunt, spark: SparkSession) -> DataFrame:
    """Sketches of all days, half of whose events came in late: their days are sketched again."""
    path = shared_dir(spark, "breadth")
    days = [r[0] for r in h.events.select("login_date").distinct().collect()]
    breadth.keep_breadth(h.events.where("event_id % 2 = 0"), path, days)
    breadth.keep_breadth(h.events, path, days)
    return breadth.kept_breadth(spark, path)


def _stored_queue(h: Hunt, spark: SparkSession) -> DataFrame:
    """The queue as read back after all days were written and some of them again."""
    path, queue = shared_dir(spark, "finding_store"), stored(h.queue(), "queue")
    days = [r[0] for r in queue.select(F.expr("cast(substring(timestamp, 1, 10) AS date)")).distinct().collect()]
    replace_days(queue.where("event_id IS NULL OR event_id % 2 = 0"), path, days)
    for part in (days, days[::2]):
        replace_days(queue, path, part)
    return stored_findings(spark, path, queue.schema).drop("finding_id")


def _account_log(h: Hunt, spark: SparkSession) -> AccountLog:
    """The log written by account, with the busiest accounts apart."""
    path = shared_dir(spark, "account_log")
    name = f"account_log_{path.rsplit('/', 1)[-1]}"
    write_account_log(h.attempts, name, path, ACCOUNT_BUCKETS, BUSY_ROWS)
    return read_account_log(spark, name)


def _from_config_table(h: Hunt, spark: SparkSession) -> DataFrame:
    """The brute-force rule under tunables read from a key-value table."""
    values = {k: str(v) for k, v in asdict(h.cfg).items()}
    table = stored(reference.hunt_config_table(spark, values), "hunt_config")
    return brute_force.detect_brute_force(h.events, h.employees, HuntConfig.from_table(table))


def _travel_from_csv(h: Hunt, spark: SparkSession) -> DataFrame:
    """The travel hunt with distances from a CSV file."""
    path = shared_dir(spark, "distances")
    h.country_distance.write.option("header", True).csv(path)
    return hunts.hunt_impossible_travel(h.events, read_distance_csv(spark, path), ASOF, LOOKBACK)


QUERIES: dict[str, Query] = {
    # Normalisation and enrichment
    "login_events": lambda h, s, d: h.events,
    "ip_enrichment": lambda h, s, d: ip_enrichment(h.events, h.feed),
    "ip_enrichment_by_prefix": lambda h, s, d: ip_enrichment(
        h.events, ThreatFeed.load(reference.ip_enrichment_table(s), "prefix")
    ),
    "classify_source": lambda h, s, d: classify_source(h.events, h.feed),
    "classify_source_shuffled": lambda h, s, d: classify_source(
        h.events, ThreatFeed.load(h.table("ip_enrichment"), broadcast_rows=0)
    ),
    "classify_source_swept": lambda h, s, d: classify_source(
        h.events, ThreatFeed.load(h.table("ip_enrichment"), sweep=True)
    ),
    "rejected_feed_ranges": lambda h, s, d: h.feed.rejected.select("cidr", "source", "tags"),
    "account_status": lambda h, s, d: account_status(h.events, h.employees),
    # Baselines and posture
    "user_country_baseline": lambda h, s, d: baselines.user_country_baseline(h.events, h.cfg),
    "user_country_baseline_display": lambda h, s, d: baselines.user_country_baseline_display(h.events, h.cfg),
    "hourly_distribution": lambda h, s, d: baselines.hourly_distribution(h.events),
    "user_hour_baseline": lambda h, s, d: baselines.user_hour_baseline(h.events, h.cfg),
    "dept_hour_baseline": lambda h, s, d: baselines.dept_hour_baseline(h.events, h.employees, h.cfg),
    "hour_windows": lambda h, s, d: baselines.hour_windows(h.events, h.employees, h.cfg),
    "patch_status": lambda h, s, d: h.patches(),
    "account_history": lambda h, s, d: _history_columns(account_history(h.events, h.cfg)),
    "account_history_merged": lambda h, s, d: _merged_history(h),
    "account_history_late_days": lambda h, s, d: _late_days(h, s),
    # Detections
    "detect_unfamiliar_country": lambda h, s, d: h.unfamiliar_country(),
    "travel_transitions": lambda h, s, d: impossible_travel.travel_transitions(h.events),
    "travel_transitions_settled": lambda h, s, d: _account_log(h, s).per_account(impossible_travel.travel_transitions),
    "detect_brute_force_settled": lambda h, s, d: _account_log(h, s).per_account(
        lambda events: brute_force.detect_brute_force(events, h.employees, h.cfg)
    ),
    "detect_impossible_travel": lambda h, s, d: h.impossible_travel(),
    "detect_after_hours": lambda h, s, d: h.after_hours(),
    "detect_brute_force": lambda h, s, d: h.brute_force(),
    "detect_password_spray": lambda h, s, d: h.password_spray_named(),
    "spray_accounts": lambda h, s, d: password_spray.spray_accounts(h.events, h.cfg),
    "detect_bruteforce_failed": lambda h, s, d: h.bruteforce_failed(),
    "detect_inactive_account": lambda h, s, d: h.inactive_account(),
    # Triage and integrity
    "triage_queue": lambda h, s, d: h.queue(),
    "triage_queue_from_history": lambda h, s, d: h.with_stored_history().queue(),
    "triage_queue_nightly": lambda h, s, d: _nightly(h, s),
    "queue_head": lambda h, s, d: triage.queue_head(h.queue(), QUEUE_HEAD),
    "queue_places": lambda h, s, d: triage.queue_places(stored(h.queue(), "queue")).select(
        "place", "detection_type", "event_id", "campaign_key", "username", "severity", "timestamp", "intel_source"
    ),
    "stored_queue": lambda h, s, d: _stored_queue(h, s),
    "account_timeline": lambda h, s, d: triage.account_timeline(h.events, ACCOUNT, h.cfg),
    "detect_brute_force_from_config": lambda h, s, d: _from_config_table(h, s),
    "triage_summary": lambda h, s, d: triage.triage_summary(h.queue()),
    "high_severity_findings": lambda h, s, d: triage.high_severity_findings(h.queue()),
    "user_timeline": lambda h, s, d: triage.user_timeline(h.events, h.brute_force(), h.cfg, h.hot),
    "user_timeline_thinned": lambda h, s, d: triage.user_timeline(
        h.events, Membership.of(h.brute_force(), "username"), h.cfg, h.hot
    ),
    "spray_campaigns": lambda h, s, d: triage.spray_campaigns(h.password_spray_named()),
    "live_compromise_sprays": lambda h, s, d: triage.live_compromise_sprays(h.password_spray_named()),
    "orphan_devices": lambda h, s, d: h.orphans(),
    "inventory_mismatch": lambda h, s, d: h.mismatches(),
    "users_without_devices": lambda h, s, d: h.deviceless(),
    "containment_preflight": lambda h, s, d: integrity.containment_preflight(
        h.machines.select("device_id", F.col("employee_id").alias("username")),
        h.machines, h.machines_backup, h.employees,
    ),
    "mismatch_live_subjects": lambda h, s, d: integrity.mismatch_live_subjects(
        h.mismatched(), h.unnamed.impossible_travel()
    ),
    "dataset_invariants": lambda h, s, d: integrity.dataset_invariants(
        demo.flawed_attempts(s, d), h.labels, demo.flawed_config(s, d),
        {"country_distance": demo.flawed_pairs(s, d), "travel_exceptions": h.travel_exceptions}, first_id=0,
        rejected_ranges=h.feed.rejected,
    ),
    # Hunts
    "hunt_after_hours": lambda h, s, d: hunts.hunt_after_hours(h.events, ASOF, LOOKBACK, SPLIT_AGE),
    "hunt_unfamiliar_country": lambda h, s, d: hunts.hunt_unfamiliar_country(
        h.events, ASOF, LOOKBACK, SPLIT_AGE
    ),
    "hunt_unfamiliar_country_all": lambda h, s, d: hunts.hunt_unfamiliar_country(
        h.events, ASOF, LOOKBACK, SPLIT_AGE, "all"
    ),
    "hunt_impossible_travel": lambda h, s, d: hunts.hunt_impossible_travel(
        h.events, h.country_distance, ASOF, LOOKBACK
    ),
    "hunt_impossible_travel_csv": lambda h, s, d: _travel_from_csv(h, s),
    "hunt_failures_since_success": lambda h, s, d: hunts.hunt_failures_since_success(
        h.events, ASOF, LOOKBACK, HUNT_RUN
    ),
    "hunt_failed_bruteforce": lambda h, s, d: hunts.hunt_failed_bruteforce(
        h.events, ASOF, LOOKBACK, HUNT_FAILED
    ),
    "hunt_password_spray": lambda h, s, d: hunts.hunt_password_spray(h.events, ASOF, LOOKBACK, HUNT_ACCOUNTS),
    "hunt_password_spray_names": lambda h, s, d: hunts.hunt_password_spray(
        h.events, ASOF, LOOKBACK, HUNT_ACCOUNTS, password_spray.NAMES_PER_PAGE
    ),
    "hunt_password_spray_estimate": lambda h, s, d: hunts.hunt_password_spray_estimate(
        h.events, ASOF, LOOKBACK, HUNT_ACCOUNTS
    ),
    "source_breadth": lambda h, s, d: breadth.breadth_check(
        h.events, _kept_breadth(h, s), (ASOF - BREADTH_SPAN).date(), ASOF.date()
    ),
    "hunt_inactive_account": lambda h, s, d: hunts.hunt_inactive_account(
        h.events, demo.identity_feed(s, d), ASOF, LOOKBACK
    ),
    # Rule correlations, batch and stream
    "correlate_event_count": lambda h, s, d: correlate.correlate_event_count(failures(h.events), gte=BURST),
    "correlate_value_count": lambda h, s, d: correlate.correlate_value_count(failures(h.events), gte=BURST),
    "merge_event_count_alerts": lambda h, s, d: correlate.merge_alerts(
        correlate.correlate_event_count(failures(h.events), gte=BURST), "username", "event_count"
    ),
    "select_terminated": lambda h, s, d: inactive_account.select_terminated(
        account_status(h.events, h.employees)
    ),
    "hopping_event_count": lambda h, s, d: stream.hopping_event_count(failures(h.events), gte=BURST),
    "hopping_value_count": lambda h, s, d: stream.hopping_value_count(failures(h.events), gte=BURST),
    "merge_hopping_alerts": lambda h, s, d: correlate.merge_windows(
        stream.hopping_value_count(failures(h.events), gte=BURST), "source_ip", "value_count"
    ),
    "stream_event_count": lambda h, s, d: stream.rolling_event_count(s, _stream_failures(s, d), gte=BURST),
    "stream_value_count": lambda h, s, d: stream.rolling_value_count(s, _stream_failures(s, d), gte=BURST),
    "stream_early_event_count": lambda h, s, d: early.confirmed(
        early.early_event_count(s, failures(_stream_events(s, d)), gte=BURST)
    ),
    "stream_missed_events": lambda h, s, d: _closed(s, d, correlate.correlate_event_count(failures(h.events), gte=BURST)).join(
        stream.rolling_event_count(s, _stream_failures(s, d), gte=BURST), ["username", "ts"], "left_anti"
    ),
    "stream_hopping_event_count": lambda h, s, d: stream.run_available(
        s, stream.hopping_event_count(_stream_failures(s, d), gte=BURST), "event_count"
    ),
    "stream_hopping_value_count": lambda h, s, d: stream.run_available(
        s, stream.hopping_value_count(_stream_failures(s, d), gte=BURST), "value_count"
    ),
    "stream_terminated": lambda h, s, d: stream.run_available(
        s, stream.terminated_activity(_stream_events(s, d), h.employees), "terminated"
    ),
    # Detection quality
    "complete_labels": lambda h, s, d: labels.complete_labels(h.attempts, h.labels),
    "label_campaign": lambda h, s, d: labels.label_campaign(
        h.attempts, (F.col("success") == 0) & F.col("source_ip").startswith("45.33.32."),
        "password_spray", F.concat(F.lit("spray-"), F.col("login_date").cast("string")), "scanner failures",
    ),
    "event_metrics": lambda h, s, d: metrics.event_metrics(h.prepared.event_findings(), h.labels),
    "event_errors": lambda h, s, d: metrics.event_errors(h.prepared.event_findings(), h.labels),
    "campaign_metrics": lambda h, s, d: metrics.campaign_metrics(
        h.prepared.campaign_findings(), h.prepared.window_events, h.labels
    ),
    "campaign_errors": lambda h, s, d: metrics.campaign_errors(
        h.prepared.campaign_findings(), h.prepared.window_events, h.labels
    ),
    "campaign_findings_counted": lambda h, s, d: metrics.campaign_findings_counted(
        h.prepared.campaign_findings(), h.prepared.window_events, h.labels
    ),
    "rule_scores": lambda h, s, d: h.scores(),
    "micro_average": lambda h, s, d: metrics.micro_average(h.scores()),
    "dataset_summary": lambda h, s, d: h.summary(),
    "asset_metrics": lambda h, s, d: metrics.asset_metrics(
        metrics.asset_findings(h.orphans(), h.mismatched(), h.deviceless(), h.patches()), h.asset_labels
    ),
    # Hand-off
    "findings_by_user": lambda h, s, d: h.findings_by_user(),
    "assemble_incidents": lambda h, s, d: incidents.assemble_incidents(h.prepared.recent, h.by_user, h.cfg, hot=h.prepared.hot),
    "incident_events": lambda h, s, d: _incident_events(h),
    "incident_events_thinned": lambda h, s, d: incidents.incident_events(
        h.prepared.recent, h.flagged, h.cfg, reference.CENTROIDS, hot=h.prepared.hot
    ),
    "flagged_prefilter": lambda h, s, d: _prefilter(h),
    "incident_pages": lambda h, s, d: _incident_pages(h),
    "handoff_records": lambda h, s, d: _handoff(h),
    "incident_signals": lambda h, s, d: _signals(h),
    "risk_band": lambda h, s, d: incidents.risk_band(_signals(h)),
    "signal_summary": lambda h, s, d: incidents.signal_summary(_signals(h)),
    "country_distances": lambda h, s, d: geography.country_distances(
        geography.observed_pairs(impossible_travel.travel_transitions(h.events)), reference.CENTROIDS
    ),
}


def _report_query(section: str) -> Query:
    return lambda h, s, d: detection_report(h)[section]()


QUERIES.update({f"report_{section}": _report_query(section) for section in REPORT_SECTIONS})


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: as_text(query(demo_hunt(use_utc(spark), sf_dir), spark, sf_dir))

    return {name: bind(query) for name, query in QUERIES.items()}
