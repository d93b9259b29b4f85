"""Per-account incidents for hand-off, and the risk signals they carry.

An incident has no bound on its events, so they are kept as numbered rows; nested
records are cut into pages of fixed size. Headers and signals are aggregates that
combine map-side.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.config import HuntConfig
from loginwatch.functions import clock, messages
from loginwatch.functions.accounts import SEVERITY_RANK
from loginwatch.functions.geo import Centroids, centroid, country_km
from loginwatch.functions.text import short_number
from loginwatch.operators.enrich import ThreatFeed, with_intel
from loginwatch.operators.impossible_travel import CHANGED_COUNTRY
from loginwatch.operators.membership import Membership
from loginwatch.operators.normalize import since_day
from loginwatch.operators.skew import HotKeys, split_join
from loginwatch.operators.timeline import HOT_ROWS, trailing_total, with_previous
from loginwatch.operators.triage import RULE_TAGS


@dataclass(frozen=True)
class SignalWeights:
    """Scores and gates of the visible signals. Only published outputs inform them."""

    # Fixed values.
    travel: float = 30.0
    travel_kmh: float = 800.0
    burst: float = 25.0
    burst_window: timedelta = timedelta(minutes=10)
    burst_failures: int = 5
    reputation: float = 20.0
    unmanaged_device: float = 7.5
    off_hours: float = 10.0
    day_start: int = 7
    day_end: int = 19


SIGNALS = messages.SIGNALS


def findings_by_user(queue: DataFrame) -> DataFrame:
    """Distinct detections in queue order, techniques and top severity per account.

    Folded to one row per account and rule first; lists hold at most seven entries.
    """
    # The largest place is the earliest in the queue: severity, newest, rule order.
    per_rule = queue.where("username IS NOT NULL").groupBy(
        "username", "detection_type", "mitre_technique"
    ).agg(F.expr(f"max(struct(-({SEVERITY_RANK}) AS r, timestamp AS t)) AS best"))
    order = " ".join(f"WHEN '{tag}' THEN {-i}" for i, (tag, _) in enumerate(RULE_TAGS.values()))
    place = f"struct(best.r, best.t, CASE detection_type {order} END AS o, detection_type AS name)"
    return per_rule.groupBy("username").agg(
        F.expr(f"sort_array(collect_list({place}), false) AS places"),
        F.expr("array_sort(collect_set(mitre_technique)) AS techniques"),
        F.expr("max(best.r) AS top"),
    ).selectExpr(
        "username", "CASE top WHEN -1 THEN 'HIGH' WHEN -2 THEN 'MEDIUM' ELSE 'LOW' END AS severity",
        "places.name AS detections", "techniques",
    )


def incident_attempts(
    events: DataFrame, users: DataFrame | Membership, cfg: HuntConfig, hot: HotKeys | None = None
) -> DataFrame:
    """Detection-window attempts of flagged accounts; busy ones (``hot``) are not shuffled for it.

    ``users`` as a :class:`Membership` thins the log before the join.
    """
    rows = since_day(events, cfg.detection_start)
    if isinstance(users, Membership):
        return users.only(rows, hot)
    return split_join(rows, users.select("username"), ["username"], "left_semi", hot)


def assemble_incidents(
    events: DataFrame,
    findings: DataFrame,
    cfg: HuntConfig,
    id_prefix: str = "INC-",
    upn_suffix: str = "@example.org",
    hot: HotKeys | None = None,
) -> DataFrame:
    """One header per flagged account: ids, lab findings and event totals.

    ``findings`` is the output of :func:`findings_by_user`. ``created_time`` is the
    account's last attempt in the window.
    """
    totals = incident_attempts(events, findings, cfg, hot).groupBy("username").agg(
        F.expr("count(1) AS event_n"), F.expr("count_if(success = 0) AS failure_n"),
        F.expr("max(ts) AS created_time"),
    )
    return findings.join(totals, "username", "left").selectExpr(
        f"concat('{id_prefix}', username) AS incident_id", "username",
        f"concat(lower(username), '{upn_suffix}') AS principal", "severity", "detections",
        "techniques AS technique_ids", "coalesce(event_n, 0L) AS event_count",
        "coalesce(failure_n, 0L) AS failure_count", "created_time",
    )


def incident_events(
    events: DataFrame,
    findings: DataFrame | Membership,
    cfg: HuntConfig,
    centroids: Centroids,
    id_prefix: str = "INC-",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sign-in records of every incident, numbered in time order.

    The number is the count of attempts in earlier seconds, a bounded running sum, plus
    the place within the second; no account is sorted as a whole.
    """
    attempts = incident_attempts(events, findings, cfg, hot)
    seconds = attempts.groupBy("username", "ts").agg(F.expr("count(1) AS n"))
    offsets = seconds.selectExpr(
        "username", "ts",
        """coalesce(sum(n) OVER (PARTITION BY username ORDER BY ts
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS earlier""",
    )
    place = "row_number() OVER (PARTITION BY username, ts ORDER BY event_id)"
    return attempts.join(offsets, ["username", "ts"]).selectExpr(
        f"concat('{id_prefix}', username) AS incident_id", f"earlier + {place} AS seq", "event_id", "ts",
        "source_ip AS ip_address", f"{centroid('country', centroids, 0)} AS lat",
        f"{centroid('country', centroids, 1)} AS lon", "country",
        "if(success = 1, 'success', 'failure') AS auth_status",
    )


def incident_pages(records: DataFrame, page_rows: int = 10_000) -> DataFrame:
    """Nested sign-in records, at most ``page_rows`` to a page; every record is in one."""
    record = "struct(seq, ts, ip_address, lat, lon, country, auth_status)"
    return records.groupBy("incident_id", F.expr(f"(seq - 1) div {page_rows} AS page")).agg(
        F.expr(f"array_sort(collect_list({record})) AS events")
    )


def _travel_speed(attempts: DataFrame, centroids: Centroids, hot_rows: int) -> DataFrame:
    """Fastest leg between consecutive attempts of each account, in km/h."""
    fields = ["event_id", "ts", "country"]
    legs = with_previous(attempts.select("username", *fields), fields, CHANGED_COUNTRY, hot_rows)
    km = country_km("prev.country", "country", centroids)
    kmh = f"{km} * 3600 / greatest(unix_seconds(ts) - unix_seconds(prev.ts), 60L)"
    return legs.groupBy("username").agg(F.expr(f"max({kmh}) AS max_kmh"))


def _burst(attempts: DataFrame, weights: SignalWeights) -> DataFrame:
    """First instant each account had enough failures within the trailing window."""
    span = weights.burst_window // timedelta(microseconds=1)
    totals = trailing_total(attempts.where("success = 0"), "username", "1L", span)
    return totals.where(f"trailing >= {weights.burst_failures}").groupBy("username").agg(
        F.expr("min(at) AS burst_at")
    )


def incident_signals(
    events: DataFrame,
    users: DataFrame | Membership,
    feed: ThreatFeed,
    cfg: HuntConfig,
    centroids: Centroids,
    weights: SignalWeights = SignalWeights(),
    hot_rows: int = HOT_ROWS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Five scores per flagged account over its detection-window attempts.

    ``users`` is read several times, so pass a stored table. The scoring engine these
    imitate is not part of the work; totals are not claimed to agree with it beyond its
    published examples.
    """
    attempts = incident_attempts(events, users, cfg, hot)
    totals = attempts.groupBy("username").agg(
        F.expr("count(1) AS n"),
        F.expr(f"count_if(login_hour < {weights.day_start} OR login_hour >= {weights.day_end}) AS off_n"),
        F.expr("max(if(success = 1, unix_micros(ts), NULL)) AS last_win"),
    )
    matched = with_intel(attempts.select("username", "source_ip"), feed, outer=False)
    hits = matched.where("intel.is_malicious = 1").select("username").distinct().selectExpr(
        "username", "true AS bad_source"
    )
    rows = (
        totals.join(_travel_speed(attempts, centroids, hot_rows), "username", "left")
        .join(_burst(attempts, weights), "username", "left")
        .join(hits, "username", "left")
    )
    share = clock.tenths(f"off_n * {int(weights.off_hours * 10)}", "n * 10")
    return rows.selectExpr(
        "username",
        f"if(max_kmh > {weights.travel_kmh!r}D, {weights.travel!r}D, 0D) AS impossible_travel",
        f"if(burst_at < last_win, {weights.burst!r}D, 0D) AS mfa_fatigue",
        f"if(bad_source, {weights.reputation!r}D, 0D) AS ip_reputation",
        f"{weights.unmanaged_device!r}D AS device_novelty",
        f"{share} AS login_hour_anomaly",
    )


def risk_band(signals: DataFrame) -> DataFrame:
    """Additive total, rounded half to even, and its band."""
    return signals.selectExpr("*", f"cast(bround({' + '.join(SIGNALS)}, 0) AS int) AS risk_score").selectExpr(
        "*",
        """CASE WHEN risk_score < 30 THEN 'low_risk' WHEN risk_score > 70 THEN 'high_risk'
                ELSE 'medium_risk' END AS verdict""",
    )


def signal_summary(signals: DataFrame) -> DataFrame:
    """Firing signals as text, strongest first; ties keep the signal order."""
    entries = ", ".join(
        f"struct(-{s} AS k, {i} AS i, '{s}' AS name, {s} AS score)" for i, s in enumerate(SIGNALS)
    )
    firing = f"array_sort(filter(array({entries}), e -> e.score > 0))"
    line = f"concat(e.name, ' ', {short_number('e.score')})"
    text = f"array_join(transform({firing}, e -> {line}), '; ')"
    return signals.selectExpr("username", f"coalesce(nullif({text}, ''), '—') AS firing_signals")


def handoff_records(incidents: DataFrame, scored: DataFrame, summaries: DataFrame) -> DataFrame:
    """The nested per-account record of the hand-off file."""
    rationale = ", ".join(f"struct('{s}' AS signal, {s} AS score)" for s in SIGNALS)
    return incidents.join(scored, "username").join(summaries, "username").selectExpr(
        "username", "incident_id", "principal", "created_time",
        "struct(severity, detections, technique_ids AS techniques) AS lab",
        f"struct(risk_score, verdict, firing_signals, array({rationale}) AS rationale) AS risk",
    )
