"""One prioritised queue over all seven detections."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loginwatch.config import HuntConfig
from loginwatch.functions.accounts import SEVERITY_RANK
from loginwatch.operators.enrich import ThreatFeed, with_intel
from loginwatch.operators.membership import Membership
from loginwatch.operators.normalize import since_day
from loginwatch.operators.ranking import placed
from loginwatch.operators.skew import HotKeys, split_join
from loginwatch.schemas import FINDING_COLUMNS

# Queue tag and ATT&CK technique per rule, in queue order.
RULE_TAGS = {
    "unfamiliar_country": ("UNFAMILIAR_COUNTRY", "T1078"),
    "impossible_travel": ("IMPOSSIBLE_TRAVEL", "T1078"),
    "after_hours": ("AFTER_HOURS", "T1078"),
    "brute_force": ("BRUTE_FORCE", "T1110.001"),
    "password_spray": ("PASSWORD_SPRAY", "T1110.003"),
    "bruteforce_failed": ("BRUTEFORCE_FAILED", "T1110.001"),
    "inactive_account": ("INACTIVE_ACCOUNT", "T1078.002"),
}


_STARTED = {"event_id": "cast(NULL AS bigint)", "campaign_key": "campaign_key",
            "timestamp": "concat(login_date, ' ', first_attempt)"}
_NO_TEXT = "cast(NULL AS string)"

# Where a rule's output differs from the finding's own column names.
_BRANCH_COLUMNS = {
    "impossible_travel": {"timestamp": "timestamp_2", "source_ip": "ip_2"},
    "brute_force": {"timestamp": "success_time", "source_ip": "success_ip"},
    "password_spray": {**_STARTED, "username": _NO_TEXT, "user_name": _NO_TEXT, "department": _NO_TEXT},
    "bruteforce_failed": _STARTED,
}


def as_findings(rule: str, detection: DataFrame) -> DataFrame:
    tag, technique = RULE_TAGS[rule]
    source = {
        "detection_type": f"'{tag}'", "mitre_technique": f"'{technique}'", "campaign_key": _NO_TEXT,
        **_BRANCH_COLUMNS.get(rule, {}),
    }
    return detection.selectExpr(*[f"{source.get(c, c)} AS {c}" for c in FINDING_COLUMNS])


def all_findings(detections: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, [as_findings(rule, detections[rule]) for rule in RULE_TAGS])


def triage_queue(detections: Mapping[str, DataFrame], feed: ThreatFeed) -> DataFrame:
    """All findings with the feed's view of their source; unordered.

    Write it with :func:`loginwatch.sources.tables.write_findings`; only reports sort it.
    """
    return with_intel(all_findings(detections), feed, outer=True).selectExpr(
        *FINDING_COLUMNS, "intel.source AS intel_source", "intel.tags AS intel_tags",
        "intel.confidence AS intel_confidence",
    )


def _queue_order() -> list[Column]:
    return [F.expr(SEVERITY_RANK), F.desc("timestamp"), *map(F.col, ("detection_type", "event_id", "campaign_key", "intel_source"))]


def in_queue_order(queue: DataFrame) -> DataFrame:
    return queue.orderBy(*_queue_order())


def queue_places(queue: DataFrame) -> DataFrame:
    """Every finding with its ``place`` in the queue; pass a stored queue, it is read twice."""
    return placed(queue, _queue_order(), "queue_places")


def queue_head(queue: DataFrame, n: int) -> DataFrame:
    """The first ``n`` findings with their ``place``: the top of the list an analyst works on."""
    head = in_queue_order(queue).limit(n)
    order = f"{SEVERITY_RANK}, timestamp DESC, detection_type, event_id, campaign_key, intel_source"
    return head.selectExpr(f"cast(row_number() OVER (ORDER BY {order}) AS bigint) AS place", "detection_type", "event_id", "campaign_key",
                           "username", "severity", "timestamp", "intel_source")


def triage_summary(queue: DataFrame) -> DataFrame:
    """Findings in total and by severity, one row."""
    return queue.agg(
        F.expr("count(1) AS total"),
        *[F.expr(f"count_if(severity = '{s}') AS {s.lower()}") for s in ("HIGH", "MEDIUM", "LOW")],
    )


def high_severity_findings(queue: DataFrame) -> DataFrame:
    return queue.where("severity = 'HIGH'").selectExpr(
        "detection_type", "mitre_technique", "coalesce(username, source_ip) AS subject", "timestamp",
        "coalesce(intel_tags, '-') AS intel", "substring(reason, 1, 60) AS summary",
    )


def user_timeline(
    events: DataFrame, users: DataFrame | Membership, cfg: HuntConfig, hot: HotKeys | None = None
) -> DataFrame:
    """Detection-window attempts of the given accounts (``username``), unordered.

    ``users`` as a :class:`Membership` thins the log before the join.
    """
    rows = since_day(events, cfg.detection_start)
    if isinstance(users, Membership):
        found = users.only(rows, hot)
    else:
        found = split_join(rows, users.select("username").distinct(), ["username"], "left_semi", hot)
    return found.select("username", "event_id", "login_date", "login_time", "success", "source_ip")


def one_user_timeline(events: DataFrame, username: str, cfg: HuntConfig) -> DataFrame:
    """The same for a single account under investigation, in time order."""
    rows = since_day(events, cfg.detection_start).where(F.col("username") == username)
    return rows.select("login_date", "login_time", "success", "source_ip").orderBy(
        "login_date", "login_time"
    )


def account_timeline(events: DataFrame, username: str, cfg: HuntConfig) -> DataFrame:
    """One account's attempts with their ``place`` in time, event ids breaking ties. The
    account may hold a third of the log: places are counted range by range."""
    rows = since_day(events, cfg.detection_start).where(F.col("username") == username)
    narrow = rows.select("ts", "event_id", "login_date", "login_time", "success", "source_ip")
    return placed(narrow, ["ts", "event_id"], "account_timeline").drop("ts")


def spray_campaigns(sprays: DataFrame) -> DataFrame:
    return sprays.select(
        "source_ip", "login_date", "accounts_targeted", "total_failures", "successes", "page", "usernames"
    )


def live_compromise_sprays(sprays: DataFrame) -> DataFrame:
    return sprays.where("successes > 0")


def flagged_users(queue: DataFrame) -> DataFrame:
    return queue.where("username IS NOT NULL").select("username").distinct()
