"""The detection report: twelve named projections, each of them a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.operators.triage import in_queue_order
from loginwatch.plans.hunt import Hunt


def _queue_rows(queue: DataFrame) -> DataFrame:
    return queue.selectExpr(
        "detection_type", "mitre_technique", "severity", "coalesce(username, source_ip) AS subject",
        "timestamp", "coalesce(intel_tags, '-') AS intel",
    )


def detection_report(hunt: Hunt) -> dict[str, Callable[[], DataFrame]]:
    """Report tables in their fixed order, each built when called; rows are unordered."""
    return {
        "triage_queue": lambda: _queue_rows(hunt.queue()),
        "unfamiliar_country": lambda: hunt.unfamiliar_country().select(
            "event_id", "username", "anomaly_country", "baseline_state", "severity"
        ),
        "impossible_travel": lambda: hunt.impossible_travel().select(
            "event_id", "username", "country_1", "country_2", "hours_apart", "required_kmh", "severity"
        ),
        "after_hours": lambda: hunt.after_hours().select(
            "event_id", "username", "login_hour", "baseline_source", "window_start", "window_end"
        ),
        "brute_force": lambda: hunt.brute_force().select(
            "event_id", "username", "failure_count", "success_ip"
        ),
        "password_spray": lambda: hunt.password_spray().select(
            "source_ip", "login_date", "accounts_targeted", "total_failures", "severity"
        ),
        "bruteforce_failed": lambda: hunt.bruteforce_failed().select("username", "source_ip", "failure_count"),
        "inactive_account": lambda: hunt.inactive_account().select(
            "event_id", "username", "outcome", "country"
        ),
        "orphan_devices": lambda: hunt.orphans().select("device_id", "listed_owner", "issue"),
        "inventory_mismatch": lambda: hunt.mismatched().select("device_id", "primary_owner", "backup_owner"),
        "users_without_devices": lambda: hunt.deviceless().select(
            "employee_id", "employee_name", "department"
        ),
        "critical_patch": lambda: hunt.patches().where(F.col("patch_risk") == "CRITICAL").select(
            "device_id", "owner_name", "days_since_patch", "patch_risk"
        ),
    }


# Sections not shown by their first column.
_WIDEST_FIRST = {"password_spray": "accounts_targeted", "critical_patch": "days_since_patch"}


def in_display_order(hunt: Hunt, section: str) -> DataFrame:
    """One section sorted for showing; stored tables stay unsorted."""
    if section == "triage_queue":
        return _queue_rows(in_queue_order(hunt.queue()))
    table = detection_report(hunt)[section]()
    widest = _WIDEST_FIRST.get(section)
    return table.orderBy(F.desc(widest)) if widest else table.orderBy(table.columns[0])


def write_report(hunt: Hunt, path: str, mode: str = "overwrite") -> None:
    """One Parquet table per report section."""
    for name, table in detection_report(hunt).items():
        table().write.mode(mode).parquet(f"{path}/{name}")
